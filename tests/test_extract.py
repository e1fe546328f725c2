import pytest
from pyspark.sql import functions as F

from helpers import envelope, record, write_envelopes
from runledger.functions import json_text, rfc3339
from runledger.operators.extract import extract_rows, flatten_logs, ingest_stats, keep_identified, select_columns
from runledger.operators.ids import assign_batches, assign_slots
from runledger.operators.counts import batch_counts, histogram
from runledger.plans.inputs import now
from runledger.schema import RECORD_COLUMNS
from runledger.schema import LOG_RECORD, RESOURCE, SCOPE
from runledger.session import setting
from runledger.sources.otlp import scan_otlp_logs, to_otlp_envelopes, write_otlp

T = 1_783_598_400_000_000_000
RUN = "550e8400-e29b-41d4-a716-446655440000"


def extracted(spark, folder, *envelopes):
    return extract_rows(flatten_logs(scan_otlp_logs(spark, write_envelopes(folder, *envelopes))), now())


def shown(rows):
    columns = ["agentic_run_id", "phase", rfc3339(F.col("timestamp")), "event", json_text(F.col("body"))]
    return sorted(tuple(r) for r in rows.select(*columns).collect())


def test_one_record(spark, tmp_path):
    body = '{"tool":"bash"}'
    rows = extracted(spark, tmp_path, envelope(record(RUN, "planning", "audit.agent.tool.call", body, T)))
    quoted = '"{\\"tool\\":\\"bash\\"}"'
    assert shown(rows) == [(RUN, "planning", "2026-07-09T12:00:00Z", "audit.agent.tool.call", quoted)]


def test_several_records(spark, tmp_path):
    rows = extracted(spark, tmp_path, envelope(*[record(RUN, "execution", f"e{i}", "{}", T) for i in range(3)]))
    assert [r[3] for r in shown(rows)] == ["e0", "e1", "e2"]


def test_missing_phase_and_event_are_empty(spark, tmp_path):
    rows = extracted(spark, tmp_path, envelope(record(RUN, time=T)))
    assert shown(rows) == [(RUN, "", "2026-07-09T12:00:00Z", "", "null")]


def test_observed_time_then_now(spark, tmp_path):
    rows = extracted(spark, tmp_path, envelope(record(RUN, observed=T), record(RUN)))
    assert [r[2] for r in shown(rows)] == ["2026-01-01T00:00:00Z", "2026-07-09T12:00:00Z"]


@pytest.mark.parametrize("run", [None, ""])
def test_records_without_run_id_are_skipped(spark, tmp_path, run):
    rows = extracted(spark, tmp_path, envelope(record(run, "p", "e", "b", T), record("r", time=T)))
    assert ingest_stats(rows).first() == (2, 1, 1)
    assert [r[0] for r in shown(keep_identified(rows))] == ["r"]


@pytest.mark.parametrize("run, text", [(5, "5"), (True, "true"), (2.5, "2.5"), ([1, "a"], '[1,"a"]')])
def test_other_kinds_are_printed(spark, tmp_path, run, text):
    rows = extracted(spark, tmp_path, envelope(record(run, run, run, time=T)))
    assert shown(rows)[0][:2] == (text, text) and shown(rows)[0][3] == text


def test_first_of_a_repeated_key(spark, tmp_path):
    rows = extracted(spark, tmp_path, envelope(record("r", event="x", extra=[("event", "y")], time=T)))
    assert shown(rows)[0][3] == "x"


@pytest.mark.parametrize("empty", [{}, {"resourceLogs": []}, {"resourceLogs": [{"scopeLogs": []}]}, envelope()])
def test_empty_envelopes_give_nothing(spark, tmp_path, empty):
    rows = extracted(spark, tmp_path, empty)
    assert shown(rows) == [] and ingest_stats(rows).first() == (0, 0, 0)


def test_readers_see_five_columns(spark, tmp_path):
    rows = extracted(spark, tmp_path, envelope(record("r", time=T))).withColumn("id", F.lit(1))
    assert select_columns(rows).columns == RECORD_COLUMNS


def test_order_and_places(spark, tmp_path):
    two = envelope(record("a"), record("b"))
    two["resourceLogs"] += envelope(record("c"), service="s")["resourceLogs"]
    two["resourceLogs"][1]["scopeLogs"] += envelope(record("d"))["resourceLogs"][0]["scopeLogs"]
    flat = flatten_logs(scan_otlp_logs(spark, write_envelopes(tmp_path, two)))
    places = [tuple(r) for r in flat.select("ri", "si", "li").collect()]
    assert places == [(0, 0, 0), (0, 0, 1), (1, 0, 0), (1, 1, 0)]


def test_regroup_keeps_everything(spark, tmp_path):
    deep = {"deep": [[{"x": 1}], None], "flat": "é\n"}
    source = [envelope(*[record(f"r{i}", body=deep, time=T + i * 1000) for i in range(5)], service=f"s{j}") for j in range(3)]
    flat = flatten_logs(scan_otlp_logs(spark, write_envelopes(tmp_path / "in", *source)))
    numbered = flat.withColumn("n", F.col("resource.attributes")[0]["value"]["stringValue"])
    write_otlp(to_otlp_envelopes(numbered, ["n"]), str(tmp_path / "out"))
    again = flatten_logs(scan_otlp_logs(spark, str(tmp_path / "out")))

    def all_of(rows):
        columns = ["ri", "si", "li", F.to_json("resource"), F.to_json("scope"), F.to_json("record")]
        return sorted(tuple(r) for r in rows.select(*columns).collect())

    assert all_of(again) == all_of(flat) and len(all_of(flat)) == 15


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_large_envelopes_are_dealt_over_several(spark, threshold):
    """A null and a hot key, and one that stays whole, with places that repeat."""
    rows = [(None if i % 3 == 0 else "hot" if i % 3 == 1 else f"k{i % 90}", i % 2, 0, i % 40, f"{i}") for i in range(1800)]
    made = spark.createDataFrame(rows, "key string, ri int, si int, li int, time string")
    attrs = F.lit(None).cast(RESOURCE).alias("resource"), F.lit(None).cast(SCOPE).alias("scope")
    record = F.from_json(F.to_json(F.struct(F.col("time").alias("timeUnixNano"))), LOG_RECORD).alias("record")
    flat = made.select("key", "ri", "si", "li", *attrs, record).repartition(5)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", threshold):
        got = to_otlp_envelopes(flat, ["key"], max_records=100).collect()
    seen = []
    for e in got:
        times = [r["timeUnixNano"] for res in e["resourceLogs"] for sc in res["scopeLogs"] for r in sc["logRecords"]]
        assert len(times) <= 100
        places = [(int(t) % 2, int(t) % 40) for t in times]
        assert places == sorted(places)
        seen += [(e["key"], t) for t in times]
    assert sorted(seen, key=str) == sorted([(r[0], r[4]) for r in rows], key=str)
    per_key = [e["key"] for e in got]
    assert per_key.count(None) > 6 and per_key.count("hot") > 6 and all(per_key.count(f"k{i}") == 1 for i in range(2, 90, 3))


def test_batches_and_slots(spark):
    rows = spark.range(1, 251).select("id", F.timestamp_micros(F.col("id") * 10000).alias("timestamp"))
    sizes = batch_counts(assign_batches(rows, 100)).orderBy("batch")
    assert [tuple(r) for r in sizes.collect()] == [(0, 100), (1, 100), (2, 50)]
    slots = batch_counts(assign_slots(rows), "slot").orderBy("slot")
    assert [r["records"] for r in slots.collect()] == [99, 100, 51]


def test_histogram_includes_upper_bounds(spark):
    rows = spark.createDataFrame([(v,) for v in [0, 5, 6, 10, 11, 20000]], "v int")
    found = histogram(rows, "v", [5, 10]).collect()
    assert [(r.bucket, r.le, r.n) for r in found] == [(0, 5.0, 2), (1, 10.0, 2), (2, None, 2)]
    assert (found[0]["count"], found[0]["sum"]) == (6, 20032.0)
