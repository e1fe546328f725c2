"""The registered queries.  Each takes ``(spark, sf_dir)`` and returns a DataFrame.

Times are returned as microseconds or text and bodies as JSON text, so that
results compare without regard to time zone or JSON type.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.functions import any_as_string, body_text, body_value, json_text, rfc3339
from runledger.operators import counts, ids, pages, purge, render, routing
from runledger.operators.extract import extract_rows, flatten_logs, ingest_stats, keep_identified
from runledger.operators.filters import after_id, for_run
from runledger.plans import inputs
from runledger.session import scratch_path
from runledger.sources.jdbc import from_jdbc, to_jdbc
from runledger.sources.otlp import scan_otlp_logs, scan_otlp_traces, to_otlp_envelopes, write_otlp
from runledger.sources.sinks import nop_sink
from runledger.sources.directory import scan_runs
from runledger.sources.table import (
    append_batch, append_logs, compact_table, delete_run, ensure_table, purge_table, scan_logs, table_settings,
)
from runledger.streaming.ingest import drain, keep_rejected, log_rows, start_ingest, start_routed, start_traces, table_sink
from runledger.streaming.metrics import IngestMetrics, insert_durations, read_metrics
from runledger.streaming.retry import Permanent

RUN = "run-8"
CONVERSATION = "conv-8"
PREFIX = "run-1"

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(fn):
        REGISTRY[name] = fn
        return fn

    return register


def shown(rows: DataFrame, *extra: str) -> DataFrame:
    """Rows with comparable columns."""
    return rows.select(
        *extra,
        "phase",
        F.unix_micros("timestamp").alias("ts_us"),
        "event",
        json_text(F.col("body")).alias("body"),
    )


# --- extraction ---


@query("extract_rows")
def extracted_rows(spark, sf_dir):
    return shown(keep_identified(inputs.event_rows(spark, sf_dir)), "id", "agentic_run_id")


@query("event_time")
def event_time(spark, sf_dir):
    return inputs.event_rows(spark, sf_dir).select("id", rfc3339(F.col("timestamp")).alias("time"))


@query("skipped_inserted")
def skipped_inserted(spark, sf_dir):
    return ingest_stats(inputs.event_rows(spark, sf_dir))


def _any_values() -> Column:
    """One of six kinds per event: text, bool, int, double, array, nested list."""
    inner = "to_variant_object(named_struct('values', array(to_variant_object(named_struct('intValue', string(user_id))))))"
    listed = inputs.entry("'list'", inputs.element("arrayValue", inner))
    clicked = inputs.entry("'click'", inputs.element("boolValue", "event_type = 'click'"))
    kind = F.col("event_id") % 6
    return (
        F.when(kind == 0, inputs.string_value("event_type"))
        .when(kind == 1, inputs.value_of("boolValue", "value > 50"))
        .when(kind == 2, inputs.int_value("user_id"))
        .when(kind == 3, inputs.value_of("doubleValue", "value"))
        .when(kind == 4, inputs.array_value(("intValue", "string(user_id)"), ("stringValue", "event_type")))
        .otherwise(inputs.kvlist_value(f"array({listed}, {clicked})"))
    )


@query("any_value_decode")
def any_value_decode(spark, sf_dir):
    values = inputs.table(spark, sf_dir, "events").select("event_id", _any_values().alias("v"))
    return values.select(
        "event_id", json_text(body_value("v")).alias("body"), any_as_string("v").alias("text")
    )


@query("any_value_deep")
def any_value_deep(spark, sf_dir):
    """Lists in lists in lists, with a repeated key, in every other event; its text in an attribute, its JSON as a body."""
    number = inputs.entry("'n'", inputs.element("intValue", "string(user_id)"))
    name = inputs.entry("'n'", inputs.element("stringValue", "event_type"))
    pairs = f"to_variant_object(named_struct('values', array({number}, {name})))"
    listed = f"to_variant_object(named_struct('values', array({inputs.element('kvlistValue', pairs)}, {inputs.element('doubleValue', 'value')})))"
    deep = inputs.kvlist_value(f"array({inputs.entry("'deep'", inputs.element('arrayValue', listed))})")
    value = F.when(F.col("event_id") % 2 == 0, deep).otherwise(inputs.int_value("user_id"))
    values = inputs.table(spark, sf_dir, "events").select("event_id", value.alias("v"))
    return values.select("event_id", json_text(body_value("v")).alias("body"), any_as_string("v").alias("text"))


@query("body_raw")
def body_raw(spark, sf_dir):
    """Values above 99 become NaN, those below 1 an infinity: bodies without a JSON form are kept as text."""
    odd = "CASE WHEN value > 99 THEN double('NaN') WHEN value < 1 THEN double('-Infinity') ELSE value END"
    values = inputs.table(spark, sf_dir, "events").select("event_id", inputs.value_of("doubleValue", odd).alias("v"))
    return values.select("event_id", json_text(body_value("v")).alias("body"), any_as_string("v").alias("text"))


@query("body_json")
def body_json(spark, sf_dir):
    values = inputs.table(spark, sf_dir, "events").select("event_id", inputs.props_value().alias("v"))
    return values.select("event_id", json_text(body_value("v")).alias("body"))


@query("body_string_json")
def body_string_json(spark, sf_dir):
    values = inputs.table(spark, sf_dir, "conversations").select("conv_id", "turn", inputs.string_value("text").alias("v"))
    return values.select("conv_id", "turn", json_text(body_value("v")).alias("body"))


@query("document_body_text")
def document_bodies(spark, sf_dir):
    values = inputs.table(spark, sf_dir, "documents").select("doc_id", inputs.string_value("text").alias("v"))
    documents = values.select("doc_id", body_value("v").alias("body"))
    return documents.select("doc_id", json_text(F.col("body")).alias("body"), body_text(F.col("body")).alias("text"))


@query("event_body_text")
def body_display(spark, sf_dir):
    return inputs.event_rows(spark, sf_dir).select("id", body_text(F.col("body")).alias("text"))


@query("body_text")
def turn_display(spark, sf_dir):
    return inputs.turn_logs(spark, sf_dir).select("agentic_run_id", "id", body_text(F.col("body")).alias("text"))


@query("rfc3339")
def event_rfc3339(spark, sf_dir):
    ts = F.timestamp_micros(inputs.epoch_micros(F.col("ts")))
    return inputs.table(spark, sf_dir, "events").select("event_id", rfc3339(ts).alias("time"))


# --- pages ---


@query("page_first")
def page_first(spark, sf_dir):
    return shown(pages.get_page(inputs.event_logs(spark, sf_dir), RUN, limit=10).rows, "id")


@query("page_next")
def page_next(spark, sf_dir):
    logs = inputs.event_logs(spark, sf_dir)
    first = pages.get_page(logs, RUN, limit=10).read()
    return shown(pages.get_page(logs, RUN, limit=10, after=first.next_after).rows, "id")


@query("page_phase")
def page_phase(spark, sf_dir):
    return shown(pages.get_page(inputs.event_logs(spark, sf_dir), RUN, phase="execution", limit=5).rows, "id")


@query("page_capped")
def page_capped(spark, sf_dir):
    return shown(pages.get_page(inputs.event_logs(spark, sf_dir), RUN, limit=9999).rows, "id")


@query("next_cursor")
def page_summary(spark, sf_dir):
    return pages.get_page(inputs.event_logs(spark, sf_dir), RUN, limit=10).summary


@query("pages_for_runs")
def pages_all_runs(spark, sf_dir):
    return shown(pages.pages_for_runs(inputs.event_logs(spark, sf_dir), 10), "agentic_run_id", "id", "has_more")


@query("jdbc_columns")
def jdbc_columns(spark, sf_dir):
    """The columns for a database and back, without one."""
    return shown(from_jdbc(to_jdbc(inputs.event_logs(spark, sf_dir))), "agentic_run_id")


@query("pages_for_cursors")
def pages_from_cursors(spark, sf_dir):
    """Each run from behind its first error on, errors having no phase, in one phase."""
    logs = inputs.event_logs(spark, sf_dir)
    cursors = logs.filter(F.col("phase") == "").groupBy("agentic_run_id").agg(F.min("id").alias("after"))
    found = pages.pages_for_runs(logs, 5, cursors, "planning")
    return shown(found, "agentic_run_id", "id", "has_more")


@query("page_bounds")
def next_cursors(spark, sf_dir):
    bounds = pages.page_bounds(inputs.event_logs(spark, sf_dir), 10)
    return bounds.select("agentic_run_id", "records", "has_more", "next_after")


@query("page_walk")
def page_walk(spark, sf_dir):
    return pages.paginate(inputs.event_logs(spark, sf_dir), 10).select("agentic_run_id", "id", "page")


@query("page_walk_sliced")
def page_walk_sliced(spark, sf_dir):
    """The same with slices of 512 ids, so that every run spans many."""
    return pages.paginate(inputs.event_logs(spark, sf_dir), 10, slice_width=512).select("agentic_run_id", "id", "page")


# --- counts ---


@query("run_directory")
def run_directory(spark, sf_dir):
    """Counts by the run directory alone, after appends, a replay, a delete and a purge: by run, and of a prefix."""
    name = _in_batches(spark, sf_dir)
    delete_run(spark, name, RUN)
    purge_table(spark, name, _noisy_runs(scan_logs(spark, name)))
    runs = scan_runs(spark, name)
    prefix = counts.count_prefix(runs, PREFIX).select(F.lit(f"{PREFIX}*").alias("agentic_run_id"), "n")
    return counts.count_by_run(runs).unionByName(prefix)


@query("count_run")
def run_count(spark, sf_dir):
    return counts.count_run(inputs.event_logs(spark, sf_dir), RUN)


@query("count_by_run")
def run_counts(spark, sf_dir):
    return counts.count_by_run(inputs.event_logs(spark, sf_dir))


@query("count_prefix")
def prefix_count(spark, sf_dir):
    return counts.count_prefix(inputs.event_logs(spark, sf_dir), PREFIX)


def _numbered(spark, sf_dir) -> DataFrame:
    return ids.assign_ids(inputs.table(spark, sf_dir, "events"), ["event_type", "ts", "event_id"])


@query("assign_ids")
def assigned_ids(spark, sf_dir):
    return _numbered(spark, sf_dir).select("event_id", "id")


@query("assign_order_ids")
def assigned_order_ids(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return ids.assign_ids(orders, ["o_orderdate", "o_orderkey"], start=1000).select("o_orderkey", "id")


@query("batch_counts")
def batch_sizes(spark, sf_dir):
    return counts.batch_counts(ids.assign_batches(inputs.event_rows(spark, sf_dir), 100))


@query("batch_slots")
def batch_slots(spark, sf_dir):
    slots = ids.assign_slots(inputs.event_rows(spark, sf_dir), "timestamp", "1 second")
    sizes = counts.batch_counts(slots, "slot")
    return sizes.select(F.unix_micros("slot").alias("slot_us"), "records")


@query("batch_histogram")
def slot_histogram(spark, sf_dir):
    slots = ids.assign_slots(inputs.event_rows(spark, sf_dir), "timestamp", "1 hour")
    return counts.histogram(counts.batch_counts(slots, "slot"), "records")


@query("value_histogram")
def value_histogram(spark, sf_dir):
    """Buckets include their upper bound, which rounded values often meet."""
    found = counts.histogram(inputs.table(spark, sf_dir, "events"), "value")
    return found.select("bucket", "le", "n", "count", F.round("sum", 2).alias("sum"))


# --- routing ---


def _routes() -> list[routing.Route]:
    return [
        routing.Route(routing.resource_attr("service.name") == inputs.SERVICES[0], ("store",)),
        routing.Route(F.col("scope.name") == "error", ("store", "alerts")),
    ]


def _routed(flat: DataFrame) -> dict[str, DataFrame]:
    return routing.route(flat, _routes(), ["unmatched"])


@query("route_counts")
def route_counts(spark, sf_dir):
    return routing.route_counts(inputs.event_records(spark, sf_dir), _routes(), ["unmatched"])


@query("route_matched")
def route_matched(spark, sf_dir):
    return _routed(inputs.event_records(spark, sf_dir))["store"].select("event_id")


@query("route_default")
def route_unmatched(spark, sf_dir):
    return _routed(inputs.event_records(spark, sf_dir))["unmatched"].select("event_id")


@query("route_none")
def route_none(spark, sf_dir):
    """Without routes everything goes to the default."""
    return routing.route(inputs.event_records(spark, sf_dir), [], ["unmatched"])["unmatched"].select("event_id")


@query("fan_out")
def fan_out(spark, sf_dir):
    """One read of the input, one table or sink per pipeline."""
    stored, alerts = inputs.new_table(spark), scratch_path(spark, "alerts")
    kept = inputs.event_records(spark, sf_dir).withColumn("id", F.col("event_id") + 1)

    def store(rows):
        append_logs(keep_identified(extract_rows(rows.drop("envelope", "event_id"), inputs.now())), stored)

    sinks = {"store": store, "alerts": lambda rows: rows.select("event_id").write.parquet(alerts), "unmatched": nop_sink}
    routing.run_pipelines(kept, _routed, sinks)
    return routing.merge_sources(
        scan_logs(spark, stored).select(F.lit("store").alias("pipeline"), "id"),
        spark.read.parquet(alerts).select(F.lit("alerts").alias("pipeline"), (F.col("event_id") + 1).alias("id")),
    )


@query("fan_in")
def fan_in(spark, sf_dir):
    events = keep_identified(inputs.event_rows(spark, sf_dir)).select("agentic_run_id", "phase", "event")
    turns = keep_identified(inputs.turn_rows(spark, sf_dir)).select("agentic_run_id", "phase", "event")
    return routing.merge_sources(events, turns)


# --- envelopes ---


def _from_envelopes(envelopes: DataFrame) -> DataFrame:
    service = routing.resource_attr("service.name").alias("service")
    flat = flatten_logs(envelopes).withColumn("service", service).withColumn("scope_name", F.col("scope.name"))
    keep = [c for c in ids.ARRIVAL_COLUMNS if c in flat.columns]
    return shown(extract_rows(flat, inputs.now()).drop(*keep), "agentic_run_id", "service", "scope_name")


@query("otlp_roundtrip")
def otlp_roundtrip(spark, sf_dir):
    return _from_envelopes(inputs.event_envelopes(spark, sf_dir).drop("envelope"))


@query("otlp_order")
def otlp_order(spark, sf_dir):
    """Records come out of an envelope in the order they went in: by service, scope and position."""
    flat = flatten_logs(inputs.event_envelopes(spark, sf_dir))
    seen = F.col("record.observedTimeUnixNano").cast("bigint")
    return flat.select("envelope", "ri", "si", "li", seen.alias("observed"))


@query("otlp_hot_envelope")
def otlp_hot_envelope(spark, sf_dir):
    """Regrouped by service, of which there are few: no envelope has more than a thousand records, and none is lost."""
    records = inputs.event_records(spark, sf_dir).withColumn("service", routing.resource_attr("service.name"))
    envelopes = to_otlp_envelopes(records, ["service"], max_records=1000).withColumn("nr", F.monotonically_increasing_id())
    flat = flatten_logs(envelopes)
    sizes = flat.groupBy("service", "nr").agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy("service").agg(F.sum("n").alias("records"), (F.max("n") <= 1000).alias("bounded"))


@query("otlp_files")
def otlp_files(spark, sf_dir):
    path = scratch_path(spark, "envelopes")
    write_otlp(inputs.event_envelopes(spark, sf_dir), path)
    return _from_envelopes(scan_otlp_logs(spark, path))


@query("envelope_routing")
def envelope_routing(spark, sf_dir):
    """Whole resources are routed inside their envelopes."""
    routes = [(lambda attributes: routing.text_attr(attributes, "service.name") == inputs.SERVICES[0], ("store",))]
    routed = routing.route_envelopes(inputs.event_envelopes(spark, sf_dir), routes, ["unmatched"], "resourceLogs")
    return routing.merge_sources(*[
        flatten_logs(e).groupBy(F.lit(name).alias("pipeline"), "envelope").agg(F.count(F.lit(1)).alias("records"))
        for name, e in routed.items()
    ])


# --- renderings ---


@query("records_json")
def record_stream(spark, sf_dir):
    return render.records_json(inputs.event_logs(spark, sf_dir))


@query("json_page")
def json_page(spark, sf_dir):
    return render.render_json(pages.get_page(inputs.event_logs(spark, sf_dir), RUN, phase="planning", limit=5))


@query("text_page")
def text_page(spark, sf_dir):
    page = pages.get_page(inputs.turn_logs(spark, sf_dir), CONVERSATION, limit=2, format="text")
    return render.render_page(page)


@query("json_pages")
def json_pages(spark, sf_dir):
    return render.pages_json(pages.pages_for_runs(inputs.event_logs(spark, sf_dir), 10))


@query("text_pages")
def text_pages(spark, sf_dir):
    return render.pages_text(pages.pages_for_runs(inputs.turn_logs(spark, sf_dir), 3))


# --- deletes and replays ---


def _noisy_runs(logs: DataFrame) -> DataFrame:
    """Runs with more errors than most, and one that does not exist."""
    errors = logs.filter(F.col("event") == "error").groupBy("agentic_run_id").count()
    unknown = logs.sparkSession.range(1).select(F.lit("run-unknown").alias("agentic_run_id"))
    return routing.merge_sources(errors.filter("count > 12").select("agentic_run_id"), unknown)


@query("purge_survivors")
def purge_survivors(spark, sf_dir):
    logs = inputs.event_logs(spark, sf_dir)
    return purge.purge_runs(logs, _noisy_runs(logs))[0].select("agentic_run_id", "id")


@query("purge_counts")
def purge_counts(spark, sf_dir):
    logs = inputs.event_logs(spark, sf_dir)
    return purge.purge_runs(logs, _noisy_runs(logs))[1]


@query("delete_result")
def delete_results(spark, sf_dir):
    logs = inputs.event_logs(spark, sf_dir)
    return render.render_delete(purge.purge_runs(logs, _noisy_runs(logs))[1])


def _copy(spark, sf_dir) -> str:
    name = inputs.new_table(spark, era_ids=5000)
    append_logs(inputs.event_logs(spark, sf_dir).drop("batch_id", "bucket", "era"), name)
    return name


@query("delete_run")
def deleted_run(spark, sf_dir):
    """The table after a run was deleted, with the number that was reported."""
    name = _copy(spark, sf_dir)
    n = delete_run(spark, name, RUN)
    return scan_logs(spark, name).select("agentic_run_id", "id", F.lit(n).cast("bigint").alias("deleted"))


def _in_batches(spark, sf_dir) -> str:
    """The event log written as five batches, the third of them twice, in eras of 2000 ids."""
    name = inputs.new_table(spark, era_ids=2000)
    logs = inputs.event_logs(spark, sf_dir).drop("batch_id", "bucket", "era")
    for batch in (0, 1, 2, 2, 3, 4):
        append_batch(logs.where((F.col("id") % 5) == batch), batch, name)
    return name


@query("compacted_table")
def compacted_table(spark, sf_dir):
    """The rows of a table of small files after its closed eras were compacted; each is there once, in no more files."""
    name = _in_batches(spark, sf_dir)
    before = scan_logs(spark, name).select(F.input_file_name()).distinct().count()
    compact_table(spark, name)
    logs = scan_logs(spark, name)
    fewer = logs.select(F.input_file_name()).distinct().count() <= before
    return shown(logs, "agentic_run_id", "id", "batch_id").withColumn("fewer_files", F.lit(fewer))


@query("purge_table")
def purged_table(spark, sf_dir):
    """What a table holds after a list of runs was purged from it, beside what was reported for each listed run."""
    name = _copy(spark, sf_dir)
    deleted = purge_table(spark, name, _noisy_runs(scan_logs(spark, name)))
    left = scan_logs(spark, name).select("agentic_run_id", "id", F.lit(None).cast("bigint").alias("deleted"))
    return left.unionByName(deleted.select("agentic_run_id", F.lit(None).cast("bigint").alias("id"), "deleted"))


@query("replayed_batch")
def replayed_batch(spark, sf_dir):
    """A batch that comes twice is there once."""
    name = inputs.new_table(spark)
    rows = inputs.event_logs(spark, sf_dir).drop("batch_id", "bucket", "era")
    for _ in range(2):
        append_batch(rows, 7, name)
    return shown(scan_logs(spark, name), "agentic_run_id", "id", "batch_id")


@query("empty_batch")
def empty_batch(spark, sf_dir):
    """A batch without rows leaves nothing, and a table that is there is not made again, whatever its settings."""
    name = inputs.new_table(spark)
    rows = inputs.event_logs(spark, sf_dir).drop("batch_id", "bucket", "era")
    append_batch(rows, 0, name)
    append_batch(rows.where("false"), 1, name)
    ensure_table(spark, *name.split("."), buckets=99)
    buckets = F.lit(table_settings(spark, name)[0]).alias("buckets")
    return scan_logs(spark, name).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n")).select("batch_id", "n", buckets)


@query("after_id")
def after_cursor(spark, sf_dir):
    logs = inputs.event_logs(spark, sf_dir)
    return after_id(for_run(logs, RUN), 500).select("id", "phase", "event")


# --- streams ---


def _ingested(spark, sf_dir, **options):
    name = inputs.new_table(spark)
    source = inputs.event_envelope_files(spark, sf_dir)
    q = start_ingest(spark, source, name, scratch_path(spark, "checkpoint"), None, inputs.now(), **options)
    q.awaitTermination()
    return name, source, q


@query("stream_ingest")
def stream_ingest(spark, sf_dir):
    name, _, _ = _ingested(spark, sf_dir, maxFilesPerTrigger=3)
    return shown(scan_logs(spark, name), "agentic_run_id")


@query("stream_ids")
def stream_ids(spark, sf_dir):
    """Ids of a stream are unique, and dense within each micro-batch."""
    name, _, _ = _ingested(spark, sf_dir, maxFilesPerTrigger=3)
    per_batch = scan_logs(spark, name).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("d"), F.min("id").alias("lo"), F.max("id").alias("hi")
    )
    return per_batch.agg(
        F.sum("n").alias("records"),
        F.sum("d").alias("ids"),
        F.bool_and(F.col("hi") - F.col("lo") + 1 == F.col("n")).alias("dense"),
        F.bool_and(F.col("lo") == F.col("batch_id") * ids.BATCH_SPAN + 1).alias("in_range"),
    )


@query("stream_replay")
def stream_replay(spark, sf_dir):
    """The same source again with a second checkpoint: rows once."""
    name, source, _ = _ingested(spark, sf_dir)
    again = start_ingest(spark, source, name, scratch_path(spark, "checkpoint"), None, inputs.now())
    again.awaitTermination()
    return shown(scan_logs(spark, name), "agentic_run_id")


@query("stream_resent")
def stream_resent(spark, sf_dir):
    """Every third envelope is sent twice, in files of their own; its records are stored once."""
    source, name = scratch_path(spark, "resent"), inputs.new_table(spark)
    envelopes = inputs.event_envelopes(spark, sf_dir)
    write_otlp(envelopes, source)
    write_otlp(envelopes.where("envelope % 3 = 0"), source)
    options = {"maxFilesPerTrigger": 3, "resent_within": "1 day"}
    start_ingest(spark, source, name, scratch_path(spark, "checkpoint"), None, inputs.now(), **options).awaitTermination()
    return shown(scan_logs(spark, name), "agentic_run_id")


@query("stream_restart")
def stream_restart(spark, sf_dir):
    """A stream that breaks off after it wrote a batch goes on from its checkpoint; foreign rows with larger ids came in between."""
    name, checkpoint = inputs.new_table(spark), scratch_path(spark, "checkpoint")
    source = inputs.event_envelope_files(spark, sf_dir)
    done = []

    def breaks_off(append):
        def write(df, batch_id):
            append(df, batch_id)
            done.append(batch_id)
            if len(done) == 2:
                raise Permanent("broken off")

        return write

    try:
        start_ingest(spark, source, name, checkpoint, None, inputs.now(), breaks_off, maxFilesPerTrigger=3).awaitTermination()
    except StreamingQueryException as error:
        if "broken off" not in str(error):
            raise
    foreign = inputs.turn_logs(spark, sf_dir).drop("batch_id", "bucket", "era")
    append_logs(foreign.withColumn("id", F.col("id") + ids.first_id(1 << 20)), name)
    start_ingest(spark, source, name, checkpoint, None, inputs.now(), maxFilesPerTrigger=3).awaitTermination()
    return shown(scan_logs(spark, name), "agentic_run_id")


@query("stream_page_walk")
def stream_page_walk(spark, sf_dir):
    """Page numbers in a table that a stream filled by many small batches, each a range of ids far from the last."""
    name, _, _ = _ingested(spark, sf_dir, maxFilesPerTrigger=1)
    walk = pages.paginate(scan_logs(spark, name), 10)
    return walk.groupBy("agentic_run_id", "page").agg(F.count(F.lit(1)).alias("records"), F.count_distinct("id").alias("ids"))


@query("stream_route")
def stream_route(spark, sf_dir):
    """Routed, then stored, forwarded or dropped; forwarded records are read back."""
    name, onward = inputs.new_table(spark), scratch_path(spark, "onward")
    stream = scan_otlp_logs(spark, inputs.event_envelope_files(spark, sf_dir), True, maxFilesPerTrigger=3)
    routes = [(lambda attributes: routing.text_attr(attributes, "service.name") == inputs.SERVICES[0], ("store",))]
    write = table_sink(name)
    sinks = {
        "store": lambda e, batch_id: write(log_rows(e, inputs.now()), batch_id),
        "unmatched": lambda e, batch_id: write_otlp(e, f"{onward}/batch={batch_id}", "overwrite"),
    }

    def branches(batch):
        return routing.route_envelopes(batch, routes, ["unmatched"], "resourceLogs")

    start_routed(stream, branches, sinks, scratch_path(spark, "checkpoint"), None).awaitTermination()
    stored = scan_logs(spark, name).select(F.lit("store").alias("pipeline"), "agentic_run_id", "phase", "event")
    passed = extract_rows(flatten_logs(scan_otlp_logs(spark, onward)), inputs.now())
    return routing.merge_sources(
        stored, passed.select(F.lit("unmatched").alias("pipeline"), "agentic_run_id", "phase", "event")
    )


def _with_metrics(spark, ingest: Callable) -> DataFrame:
    """The metrics of all batches, however many, of the stream that ``ingest`` runs and returns."""
    path = scratch_path(spark, "metrics")
    listener = IngestMetrics(spark, path)
    spark.streams.addListener(listener)
    try:
        q = ingest()
        if not listener.wait(q):
            raise TimeoutError("the reports of the stream did not come")
    finally:
        spark.streams.removeListener(listener)
    return read_metrics(spark, path).where(F.col("query_id") == str(q.id))


def _metered(spark, sf_dir) -> tuple[str, DataFrame]:
    """The table filled by a stream, and its metrics."""
    names = []

    def ingest():
        name, _, q = _ingested(spark, sf_dir, maxFilesPerTrigger=3)
        names.append(name)
        return q

    metrics = _with_metrics(spark, ingest)
    return names[0], metrics


@query("stream_counters")
def stream_counters(spark, sf_dir):
    _, metrics = _metered(spark, sf_dir)
    return metrics.agg(*[F.sum(c).alias(c) for c in ("records", "inserted", "skipped", "rejected")])


@query("rejected_lines")
def rejected_lines(spark, sf_dir):
    """Of every seven envelopes one is cut off and one has a number that is none: counted, kept apart, not ingested."""
    source, apart, name = scratch_path(spark, "damaged"), scratch_path(spark, "apart"), inputs.new_table(spark)
    line = F.to_json(F.struct("resourceLogs"))
    cut = F.left(line, F.length(line) - 20)
    mistyped = F.replace(line, F.lit('"severityNumber":9'), F.lit('"severityNumber":"nine"'))
    nth = F.col("envelope") % 7
    lines = inputs.event_envelopes(spark, sf_dir).select(F.when(nth == 3, cut).when(nth == 5, mistyped).otherwise(line))
    lines.write.text(source)

    def ingest():
        q = start_ingest(spark, source, name, scratch_path(spark, "checkpoint"), None, inputs.now())
        q.awaitTermination()
        return q

    metrics = _with_metrics(spark, ingest)
    stream = scan_otlp_logs(spark, source, True)
    keep_rejected(stream, apart, scratch_path(spark, "checkpoint"), None).awaitTermination()
    kept = spark.read.schema("line string").json(apart)
    return routing.merge_sources(
        *[metrics.select(F.lit(c).alias("what"), c).groupBy("what").agg(F.sum(c).alias("n")) for c in ("records", "skipped", "rejected")],
        scan_logs(spark, name).agg(F.lit("stored").alias("what"), F.count(F.lit(1)).alias("n")),
        kept.agg(F.lit("kept apart").alias("what"), F.count("line").alias("n")),
    )


@query("insert_duration")
def insert_duration(spark, sf_dir):
    """Buckets of the time that batches took to write; the times vary, so only whether they add up is returned."""
    name, metrics = _metered(spark, sf_dir)
    batches = scan_logs(spark, name).select("batch_id").distinct().count()
    times = counts.histogram(insert_durations(metrics), "insert_seconds")
    return times.select("bucket", "le", (F.col("count") == batches).alias("a_time_each"), (F.col("sum") > 0).alias("took_time"))


def _span_envelopes(spark, sf_dir) -> DataFrame:
    """``events`` as spans, one envelope per record batch and service."""
    fields = inputs.event_fields(spark, sf_dir)
    resource = F.expr(f"named_struct('attributes', {inputs.attributes({'service.name': 'service'})})")
    span = F.struct(
        F.hex("event_id").alias("spanId"),
        F.col("event_type").alias("name"),
        F.col("time_nanos").cast("string").alias("startTimeUnixNano"),
        F.col("observed_nanos").cast("string").alias("endTimeUnixNano"),
    )
    spans = fields.groupBy(F.call_function("div", F.col("event_id"), F.lit(inputs.ENVELOPE_SIZE)).alias("n"), "service").agg(
        F.first(resource).alias("resource"), F.collect_list(span).alias("spans")
    )
    scope_spans = F.to_variant_object(F.array(F.struct("spans")))
    return spans.select(F.array(F.struct("resource", scope_spans.alias("scopeSpans"))).alias("resourceSpans"))


@query("trace_forward")
def trace_forward(spark, sf_dir):
    """Spans are passed on whole, whatever their service."""
    source, onward = scratch_path(spark, "spans"), scratch_path(spark, "onward")
    write_otlp(_span_envelopes(spark, sf_dir), source)
    start_traces(spark, source, scratch_path(spark, "checkpoint"), onward, None).awaitTermination()
    scopes = F.variant_get("r.scopeSpans", "$", "array<struct<spans:array<struct<spanId:string,name:string,startTimeUnixNano:string>>>>")
    spans = F.flatten(F.transform(scopes, lambda scope: scope["spans"]))
    return (
        scan_otlp_traces(spark, onward)
        .select(F.explode("resourceSpans").alias("r"))
        .select(routing.text_attr("r.resource.attributes", "service.name").alias("service"), F.explode(spans).alias("s"))
        .select("service", F.col("s.spanId").alias("span_id"), F.col("s.name").alias("name"))
    )


@query("signal_traces")
def signal_traces(spark, sf_dir):
    """Logs are stored and traces forwarded, by two queries at the same time; nothing of one gets into the other."""
    name, spans, onward = inputs.new_table(spark), scratch_path(spark, "spans"), scratch_path(spark, "onward")
    write_otlp(_span_envelopes(spark, sf_dir), spans)
    running = [
        start_ingest(spark, inputs.event_envelope_files(spark, sf_dir), name, scratch_path(spark, "checkpoint"), "1 second", inputs.now()),
        start_traces(spark, spans, scratch_path(spark, "checkpoint"), onward, "1 second"),
    ]
    for q in running:
        drain(q)
    scopes = F.variant_get("r.scopeSpans", "$", "array<struct<spans:array<struct<spanId:string>>>>")
    resources = scan_otlp_traces(spark, onward).select(F.explode("resourceSpans").alias("r"))
    sent = resources.select(F.size(F.flatten(F.transform(scopes, lambda scope: scope["spans"]))).alias("n"))
    return scan_logs(spark, name).agg(F.lit("records").alias("what"), F.count(F.lit(1)).alias("n")).unionByName(
        sent.agg(F.lit("spans").alias("what"), F.sum("n").alias("n"))
    )


@query("signal_split")
def signal_split(spark, sf_dir):
    """Logs are stored, traces dropped, by two queries over two sources."""
    name, logs, spans = inputs.new_table(spark), inputs.event_envelope_files(spark, sf_dir), scratch_path(spark, "spans")
    write_otlp(_span_envelopes(spark, sf_dir), spans)
    running = [
        start_ingest(spark, logs, name, scratch_path(spark, "checkpoint"), "1 second", inputs.now()),
        start_traces(spark, spans, scratch_path(spark, "checkpoint")),
    ]
    for q in running:
        drain(q)
    return counts.count_by_run(scan_logs(spark, name))
