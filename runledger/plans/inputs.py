"""The given tables as log records.

``events`` become nested log records and, from them, a log table; so do the
turns of ``conversations``, whose bodies are text.  Tables are written once per
session and scale below the shared folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.functions import epoch_micros
from runledger.operators.extract import extract_rows, keep_identified
from runledger.schema import ANY_VALUE, ATTRIBUTES, ELEMENT, EVENT_KEY, LOG_RECORD, PHASE_KEY, RESOURCE, RUN_ID_KEY, SCOPE
from runledger.session import scratch_path
from runledger.sources.otlp import to_otlp_envelopes, write_otlp
from runledger.sources.table import append_logs, ensure_table, scan_logs

# The time taken as "now", 2026-01-01T00:00:00Z, so that results repeat.
NOW_MICROS = 1767225600000000

# Records per envelope.
ENVELOPE_SIZE = 100

# Where services and event types stand in an envelope.
SERVICES = ["audit-service", "other"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def now() -> Column:
    return F.timestamp_micros(F.lit(NOW_MICROS))


# An any-value has one field per kind, in this order.
KINDS = ["stringValue", "boolValue", "intValue", "doubleValue", "bytesValue", "arrayValue", "kvlistValue"]


def _struct(kind: str, value: str) -> str:
    return f"named_struct({', '.join(f"'{k}', {value if k == kind else 'NULL'}" for k in KINDS)})"


def value_of(kind: str, value: str) -> Column:
    """An OTLP any-value of the given kind from SQL text; NULL for a NULL."""
    return F.expr(f"CASE WHEN {value} IS NOT NULL THEN CAST({_struct(kind, value)} AS {ANY_VALUE}) END")


def string_value(text: str) -> Column:
    return value_of("stringValue", text)


def int_value(number: str) -> Column:
    return value_of("intValue", f"string({number})")


def array_value(*elements: tuple[str, str]) -> Column:
    """An array of ``(kind, value)`` elements."""
    listed = ", ".join(element(kind, value) for kind, value in elements)
    return value_of("arrayValue", f"named_struct('values', array({listed}))")


def kvlist_value(entries: str) -> Column:
    """A key/value list; ``entries`` is SQL text of an array of :func:`entry`."""
    return value_of("kvlistValue", f"named_struct('values', {entries})")


def element(kind: str, value: str) -> str:
    """SQL text of an element of an array or list."""
    return f"CAST({_struct(kind, value)} AS {ELEMENT})"


def entry(key: str, value: str) -> str:
    return f"named_struct('key', {key}, 'value', {value})"


def attributes(named: dict[str, str]) -> str:
    """SQL text of attributes, each text from SQL text, without the missing ones."""
    listed = ", ".join(
        f"CASE WHEN {text} IS NOT NULL THEN {entry(f"'{key}'", _struct('stringValue', text))} END"
        for key, text in named.items()
    )
    return f"CAST(filter(array({listed}), a -> a IS NOT NULL) AS {ATTRIBUTES})"


def log_record(time_nanos: str, observed_nanos: str, body: str, attrs: str) -> Column:
    """A log record from SQL text; ``body`` is a column."""
    return F.expr(f"""CAST(named_struct(
        'timeUnixNano', string({time_nanos}), 'observedTimeUnixNano', string({observed_nanos}),
        'severityNumber', 9, 'severityText', 'INFO', 'body', {body}, 'attributes', {attrs},
        'droppedAttributesCount', NULL, 'flags', NULL, 'traceId', NULL, 'spanId', NULL, 'eventName', NULL)
        AS {LOG_RECORD})""")


def event_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with the fields of a log record, some of them missing."""
    events = table(spark, sf_dir, "events").withColumn("micros", epoch_micros(F.col("ts")))
    return events.selectExpr(
        "*",
        "CASE WHEN event_id % 17 = 0 THEN '' WHEN event_id % 19 <> 0 THEN concat('run-', user_id) END AS uid",
        "CASE WHEN event_type IN ('view', 'click') THEN 'planning' "
        "WHEN event_type IN ('purchase', 'signup') THEN 'execution' END AS phase_name",
        "CASE WHEN event_id % 5 = 0 THEN 0 ELSE micros * 1000 END AS time_nanos",
        "CASE WHEN event_id % 55 = 0 THEN 0 ELSE (micros + 1000000) * 1000 END AS observed_nanos",
        f"CASE user_id % 3 WHEN 0 THEN '{SERVICES[0]}' WHEN 1 THEN '{SERVICES[1]}' END AS service",
    )


def props_value() -> Column:
    """``props`` as an OTLP key/value list."""
    each = entry("e.key", element("intValue", "e.value"))
    return kvlist_value(f"transform(map_entries(from_json(props, 'map<string,string>')), e -> {each})")


def place_in(values: list[str], column: str) -> Column:
    """Position of a value in a list; behind the list if it is missing or not in it."""
    cases = " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(values))
    return F.expr(f"CASE {column} {cases} ELSE {len(values)} END")


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as flattened log records: ``envelope, event_id, ri, resource, si, scope, li, record``.

    Written once: otherwise the optimizer would put the making of a record in the place of
    each use of one of its fields, which no log that is read from somewhere is like.
    """
    made = _made_records(spark, sf_dir)

    def write():
        path = scratch_path(spark, "records")
        made.write.parquet(path)
        return path

    return spark.read.schema(made.schema).parquet(_once(spark, sf_dir, "records", write))


def _made_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    attrs = attributes({RUN_ID_KEY: "uid", PHASE_KEY: "phase_name", EVENT_KEY: "event_type"})
    service = attributes({"service.name": "service"})
    return event_fields(spark, sf_dir).withColumn("body", props_value()).select(
        F.expr(f"event_id div {ENVELOPE_SIZE}").alias("envelope"),
        "event_id",
        place_in(SERVICES, "service").alias("ri"),
        F.expr(f"CAST(named_struct('attributes', {service}, 'droppedAttributesCount', NULL) AS {RESOURCE})").alias("resource"),
        place_in(EVENT_TYPES, "event_type").alias("si"),
        F.expr(
            f"CAST(named_struct('name', event_type, 'version', NULL, 'attributes', NULL, "
            f"'droppedAttributesCount', NULL) AS {SCOPE})"
        ).alias("scope"),
        F.col("event_id").alias("li"),
        log_record("time_nanos", "observed_nanos", "body", attrs).alias("record"),
    )


def event_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_otlp_envelopes(event_records(spark, sf_dir), ["envelope"])


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``events`` as extracted rows with ``id``, also those without a run id."""
    flat = event_records(spark, sf_dir).withColumn("id", F.col("event_id") + 1).drop("envelope", "event_id")
    return extract_rows(flat, now())


def turn_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of ``conversations`` as log rows without ids: text bodies, a turn every 1.5 seconds."""
    attrs = attributes({RUN_ID_KEY: "concat('conv-', conv_id)", PHASE_KEY: "role", EVENT_KEY: "'chat.turn'"})
    record = log_record(f"({NOW_MICROS} + turn * 1500000) * 1000", "0", "body", attrs)
    turns = table(spark, sf_dir, "conversations").withColumn("body", string_value("text"))
    return extract_rows(turns.select("conv_id", "turn", record.alias("record")))


# What was written for whom, by application, folder of the given tables, and name.
_built: dict[tuple, str] = {}


def new_table(spark: SparkSession, buckets: int = 8, **settings) -> str:
    """A table nobody else uses."""
    name = f"logs_{uuid.uuid4().hex}"
    return ensure_table(spark, "runledger_scratch", name, buckets, location=scratch_path(spark, "tables"), **settings)


def _once(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    """What ``build`` returns, which it does once per session and folder of tables."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def _filled(spark: SparkSession, rows: DataFrame, order_cols: list | None = None) -> str:
    name = new_table(spark)
    append_logs(rows, name, order_cols=order_cols)
    return name


def event_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log table made of ``events``."""
    name = _once(spark, sf_dir, "events", lambda: _filled(spark, keep_identified(event_rows(spark, sf_dir))))
    return scan_logs(spark, name)


def turn_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log table made of ``conversations``, with ids in the order of conversation and turn."""
    order = ["conv_id", "turn"]
    return scan_logs(spark, _once(spark, sf_dir, "turns", lambda: _filled(spark, turn_rows(spark, sf_dir), order)))


def event_envelope_files(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the envelopes of ``events``, as a source of streams."""

    def write():
        path = scratch_path(spark, "source")
        write_otlp(event_envelopes(spark, sf_dir), path)
        return path

    return _once(spark, sf_dir, "envelopes", write)
