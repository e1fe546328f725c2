"""Pages: one page of a run, the first page of all runs, page numbers of all rows.

A page is found by its ids first: a narrow scan of run and id tells where the
page ends, and only then are the wide columns read, for that id range.  On the
log table that scan goes through the eras from the cursor on, twice as many at
each step, and ends with the page.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.operators.extract import select_columns
from runledger.operators.filters import after_id, eras_of_run, for_phase, for_run, in_buckets_of, up_to_id
from runledger.operators.ids import SLICE_WIDTH, positions
from runledger.operators.rules import clamp_limit, parse_after, require_run_id
from runledger.session import write_through


@dataclass(frozen=True)
class Page:
    """A page that has been planned, not read.

    ``fetched`` has up to ``limit + 1`` rows; the row too many, if it is there,
    says there is more.  ``eras`` are those of the log table that were searched for ids.
    """

    run_id: str
    phase: str | None
    limit: int
    after: int
    format: str
    fetched: DataFrame
    eras: list[int] | None = None

    @property
    def rows(self) -> DataFrame:
        """The records of the page in id order."""
        return self.fetched.orderBy("id").limit(self.limit)

    @property
    def summary(self) -> DataFrame:
        """One row: records, has_more and the cursor of the next page (NULL on an empty page)."""
        ids = F.slice("ids", 1, self.limit)
        return self.fetched.agg(F.array_sort(F.collect_list("id")).alias("ids")).select(
            F.lit(self.run_id).alias("agentic_run_id"),
            F.size(ids).cast("bigint").alias("records"),
            (F.size("ids") > self.limit).alias("has_more"),
            F.array_max(ids).alias("next_after"),
        )

    def read(self) -> "PageRead":
        """Read the page, at most 1001 rows, in one job."""
        records = self.fetched.orderBy("id").collect()
        kept = records[: self.limit]
        return PageRead(kept, len(records) > self.limit, kept[-1]["id"] if kept else None)


@dataclass(frozen=True)
class PageRead:
    records: list
    has_more: bool
    next_after: int | None


def get_page(logs: DataFrame, run_id: str, phase=None, limit=None, after=None, format="json") -> Page:
    """The page of a run behind a cursor.

    Only ``format="text"`` selects text, anything else JSON; see
    :func:`runledger.operators.render.render_page`.
    """
    run_id, limit, after = require_run_id(run_id), clamp_limit(limit), parse_after(after)
    beyond = after_id(for_phase(for_run(logs, run_id), phase), after)
    eras = eras_of_run(logs, run_id, after)
    if eras is None:
        last = beyond.select("id").orderBy("id").limit(limit + 1).agg(F.max("id")).scalar()
    else:
        ids, eras = _first_ids(beyond, eras, limit + 1)
        last = F.lit(ids[-1] if ids else after)
    # The page's last id reaches the scan as a filter, so what lies past it is skipped.
    found = select_columns(up_to_id(beyond, last))
    return Page(run_id, phase or None, limit, after, format, found.orderBy("id").limit(limit + 1), eras)


def _first_ids(rows: DataFrame, eras: list[int], n: int) -> tuple[list[int], list[int]]:
    """The first ``n`` ids, a page's at most, and the eras searched for them: one, then two more, four more and so on."""
    ids, at, step = [], 0, 1
    while at < len(eras) and len(ids) < n:
        some = rows.filter(F.col("era").between(eras[at], eras[min(at + step, len(eras)) - 1]))
        ids += [r["id"] for r in some.select("id").orderBy("id").limit(n - len(ids)).collect()]
        at, step = at + step, 2 * step
    return ids, eras[:at]


def page_bounds(
    logs: DataFrame, limit=None, cursors: DataFrame | None = None, phase=None, slice_width: int = SLICE_WIDTH
) -> DataFrame:
    """Where the page of every run begins and ends: ``agentic_run_id, after, next_after,
    records, has_more``.  Reads run and id only.  Without ``cursors`` (``agentic_run_id,
    after``, one row per run) all runs start at 0; runs without a cursor are left out."""
    limit = clamp_limit(limit)
    rows = for_phase(logs, phase)
    if cursors is None:
        narrow = rows.select(*_narrow(rows), F.lit(0).cast("bigint").alias("after"))
    else:
        written = write_through(cursors.select("agentic_run_id", "after"), "cursors")
        rows = in_buckets_of(rows, written)
        narrow = rows.select(*_narrow(rows)).join(written, "agentic_run_id")
    numbered = positions(narrow.filter("id > after"), slice_width, first=limit + 1)
    on_page = F.col("position") <= limit
    return numbered.groupBy("agentic_run_id", "after").agg(
        F.max(F.when(on_page, F.col("id"))).alias("next_after"),
        F.count_if(on_page).alias("records"),
        F.bool_or(~on_page).alias("has_more"),
    )


def pages_for_runs(
    logs: DataFrame, limit=None, cursors: DataFrame | None = None, phase=None, slice_width: int = SLICE_WIDTH
) -> DataFrame:
    """The page of every run at once: records with their run and its ``has_more``.

    The bounds, one short row per run, are worked out and written first.  So
    Spark knows their size when it plans the join with the wide rows: it
    broadcasts them and leaves the rows where they are, or, beyond
    ``spark.sql.autoBroadcastJoinThreshold``, joins by run, where adaptive
    execution splits the rows of a hot run (its other side is a single row).
    """
    bounds = write_through(page_bounds(logs, limit, cursors, phase, slice_width), "bounds")
    least, most = bounds.agg(F.min("after"), F.max("next_after")).first()
    if most is None:
        least, most = 0, 0
    rows = up_to_id(after_id(for_phase(logs, phase), least), F.lit(most))
    if cursors is not None:
        rows = in_buckets_of(rows, bounds)
    return (
        rows.select("agentic_run_id", "id", "phase", "timestamp", "event", "body")
        .join(bounds, "agentic_run_id")
        .filter((F.col("id") > F.col("after")) & (F.col("id") <= F.col("next_after")))
        .drop("after", "next_after", "records")
    )


def _narrow(logs: DataFrame) -> list[str]:
    return [c for c in ("agentic_run_id", "id", "era") if c in logs.columns]


def paginate(logs: DataFrame, limit=None, slice_width: int = SLICE_WIDTH) -> DataFrame:
    """``agentic_run_id, id, page``: the page (0, 1, …) a row is on when its run is read to the end.

    Run and id are all that is read and shuffled.  A page's records come from :func:`get_page` behind the last id of the
    page before it.
    """
    n = clamp_limit(limit)
    page = F.call_function("div", F.col("position") - 1, F.lit(n)).alias("page")
    return positions(logs.select(*_narrow(logs)), slice_width).select("agentic_run_id", "id", page)
