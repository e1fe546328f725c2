"""JSON and plain-text renderings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.functions import body_text, rfc3339
from runledger.operators.pages import Page


def record_json() -> Column:
    """One record as JSON; a missing body is shown as null."""
    record = F.struct("id", "phase", rfc3339(F.col("timestamp")).alias("timestamp"), "event", "body")
    return F.to_json(record, {"ignoreNullFields": "false"})


def record_line() -> Column:
    """One record as text.  Line breaks in the body are kept."""
    return F.concat_ws(": ", rfc3339(F.col("timestamp")), body_text(F.col("body")))


def records_json(logs: DataFrame) -> DataFrame:
    """One JSON text per row, for any number of rows."""
    return logs.select(record_json().alias("value"))


def _quoted(text: Column) -> Column:
    return F.to_json(text.cast("variant"))


def _page_json(run: Column, phase: str | None, records: Column, has_more: Column) -> Column:
    parts = [F.lit('{"agentic_run_id":'), _quoted(run)]
    if phase:
        parts += [F.lit(',"phase":'), _quoted(F.lit(phase))]
    parts += [F.lit(',"records":['), F.array_join(records, ","), F.lit('],"has_more":'), has_more.cast("string"), F.lit("}")]
    return F.concat(*parts)


def _gather(value: Column) -> Column:
    """Values of one page in id order.  A page has 1000 records at most."""
    return F.transform(F.array_sort(F.collect_list(F.struct("id", value.alias("v")))), lambda x: x["v"])


def render_json(page: Page) -> DataFrame:
    """The page as one JSON object; ``phase`` is there only if it was asked for."""
    return page.fetched.agg(_gather(record_json()).alias("r")).select(
        _page_json(
            F.lit(page.run_id), page.phase, F.slice("r", 1, page.limit), F.size("r") > page.limit
        ).alias("value")
    )


def _text_lines(run: Column, lines: Column, has_more: Column) -> Column:
    return F.concat(
        F.array(
            F.concat(F.lit("agentic_run_id: "), run),
            F.concat(F.lit("records: "), F.size(lines).cast("string")),
            F.concat(F.lit("has_more: "), has_more.cast("string")),
            F.lit(""),
        ),
        lines,
    )


def render_text(page: Page) -> DataFrame:
    """The page as lines ``(line_no, line)``: a header of three, a blank, one per record."""
    lines = _text_lines(F.lit(page.run_id), F.slice("r", 1, page.limit), F.size("r") > page.limit)
    return (
        page.fetched.agg(_gather(record_line()).alias("r"))
        .select(F.posexplode(lines).alias("p", "line"))
        .select((F.col("p") + 1).alias("line_no"), "line")
    )


def render_page(page: Page) -> DataFrame:
    return render_text(page) if page.format == "text" else render_json(page)


def pages_json(pages: DataFrame, phase: str | None = None) -> DataFrame:
    """:func:`render_json` for all runs of :func:`~runledger.operators.pages.pages_for_runs`."""
    return (
        pages.groupBy("agentic_run_id")
        .agg(_gather(record_json()).alias("r"), F.bool_or("has_more").alias("m"))
        .select("agentic_run_id", _page_json(F.col("agentic_run_id"), phase, F.col("r"), F.col("m")).alias("value"))
    )


def pages_text(pages: DataFrame) -> DataFrame:
    """:func:`render_text` for all runs: ``(agentic_run_id, line_no, line)``."""
    return (
        pages.groupBy("agentic_run_id")
        .agg(_gather(record_line()).alias("r"), F.bool_or("has_more").alias("m"))
        .select("agentic_run_id", F.posexplode(_text_lines(F.col("agentic_run_id"), F.col("r"), F.col("m"))).alias("p", "line"))
        .select("agentic_run_id", (F.col("p") + 1).alias("line_no"), "line")
    )


def render_delete(counts: DataFrame) -> DataFrame:
    """``{"deleted": n, "agentic_run_id": run}`` per row of ``(deleted, agentic_run_id)``."""
    return counts.select(F.to_json(F.struct("deleted", "agentic_run_id")).alias("value"))
