"""From nested envelopes to log rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.functions import any_as_string, attr, body_value, resolve_time
from runledger.schema import EVENT_KEY, PHASE_KEY, RECORD_COLUMNS, REJECTED, RUN_ID_KEY


def accepted(envelopes: DataFrame) -> DataFrame:
    """The envelopes that were not refused when they were read, without the column that says so."""
    return envelopes.where(F.col(REJECTED).isNull()).drop(REJECTED) if REJECTED in envelopes.columns else envelopes


def flatten_logs(envelopes: DataFrame) -> DataFrame:
    """One row per log record: ``ri, resource, si, scope, li, record`` and whatever
    other columns the envelopes carry.  ``(ri, si, li)`` is the place in the envelope.
    Refused lines have no records."""
    envelopes = accepted(envelopes)
    keep = [c for c in envelopes.columns if c != "resourceLogs"]
    resources = envelopes.select(*keep, F.posexplode("resourceLogs").alias("ri", "r"))
    scopes = resources.select(
        *keep, "ri", F.col("r.resource").alias("resource"), F.posexplode("r.scopeLogs").alias("si", "s")
    )
    return scopes.select(
        *keep, "ri", "resource", "si", F.col("s.scope").alias("scope"), F.posexplode("s.logRecords").alias("li", "record")
    )


def extract_rows(flat: DataFrame, now: Column | None = None) -> DataFrame:
    """Turn ``record`` into run id, phase, timestamp, event and body.

    Resource, scope and the rest of the record are left behind; other columns
    stay.  Missing attributes become ''.  Rows without a run id are still here,
    so they can be counted; drop them with :func:`keep_identified`.
    """
    keep = [c for c in flat.columns if c not in ("ri", "resource", "si", "scope", "li", "record")]
    # Attributes are looked up in a step of their own, so that each is looked up once.
    found = flat.select(
        *keep,
        attr("record.attributes", RUN_ID_KEY).alias("_run"),
        attr("record.attributes", PHASE_KEY).alias("_phase"),
        attr("record.attributes", EVENT_KEY).alias("_event"),
        resolve_time(F.col("record.timeUnixNano"), F.col("record.observedTimeUnixNano"), now).alias("timestamp"),
        F.col("record.body").alias("_body"),
    )

    def text(column):
        return F.coalesce(any_as_string(column), F.lit(""))

    return found.select(
        *keep,
        text("_run").alias("agentic_run_id"),
        text("_phase").alias("phase"),
        "timestamp",
        text("_event").alias("event"),
        body_value("_body").alias("body"),
    )


def keep_identified(rows: DataFrame) -> DataFrame:
    """Drop rows whose run id is missing or empty: nobody could ask for them."""
    return rows.filter(F.col("agentic_run_id") != "")


def identified() -> Column:
    return F.coalesce(F.col("agentic_run_id") != "", F.lit(False))


def ingest_counters() -> list[Column]:
    """Counters over extracted rows; good for ``agg`` as well as for ``observe``."""
    return [
        F.count(F.lit(1)).alias("records"),
        F.count_if(identified()).alias("inserted"),
        F.count_if(~identified()).alias("skipped"),
    ]


def ingest_stats(rows: DataFrame) -> DataFrame:
    """One row: records seen, inserted and skipped for want of a run id."""
    return rows.agg(*ingest_counters())


def select_columns(logs: DataFrame) -> DataFrame:
    """The columns a reader gets."""
    return logs.select(*RECORD_COLUMNS)
