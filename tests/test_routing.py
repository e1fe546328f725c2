import pytest
from pyspark.sql import functions as F

from helpers import envelope, record, write_envelopes
from runledger.operators.extract import flatten_logs
from runledger.operators.routing import Route, merge_sources, resource_attr, route, route_envelopes, run_pipelines, text_attr
from runledger.sources.otlp import scan_otlp_logs
from runledger.sources.sinks import debug_sink, nop_sink


@pytest.fixture
def envelopes(spark, tmp_path):
    mixed = envelope(record("a"), record("b"), service="agents")
    mixed["resourceLogs"] += envelope(record("c"), service="other")["resourceLogs"]
    numeric = envelope(record("e"))
    numeric["resourceLogs"][0]["resource"]["attributes"] = [{"key": "service.name", "value": {"intValue": "5"}}]
    return scan_otlp_logs(spark, write_envelopes(tmp_path, mixed, envelope(record("d")), numeric))


def run_ids(rows):
    return sorted(r[0] for r in rows.select(F.col("record.attributes")[0]["value"]["stringValue"]).collect())


def test_unmatched_and_missing_go_to_the_default(envelopes):
    flat = flatten_logs(envelopes)
    routed = route(flat, [Route(resource_attr("service.name") == "agents", ("store",))], ["rest"])
    assert run_ids(routed["store"]) == ["a", "b"] and run_ids(routed["rest"]) == ["c", "d", "e"]


def test_a_number_is_not_a_text(envelopes):
    routed = route(flatten_logs(envelopes), [Route(resource_attr("service.name") == "5", ("store",))], ["rest"])
    assert run_ids(routed["store"]) == []


def test_first_route_counts(envelopes):
    routes = [
        Route(resource_attr("service.name") == "agents", ("x", "y")),
        Route(resource_attr("service.name").isNotNull(), ("y", "rest")),
    ]
    routed = route(flatten_logs(envelopes), routes, ["rest"])
    assert {k: run_ids(v) for k, v in routed.items()} == {"x": ["a", "b"], "y": ["a", "b", "c"], "rest": ["c", "d", "e"]}


def test_no_routes_send_all_to_the_default(envelopes):
    routed = route(flatten_logs(envelopes), [], ["all"])
    assert list(routed) == ["all"] and len(run_ids(routed["all"])) == 5


def test_envelopes_are_routed_by_resource(envelopes):
    routes = [(lambda attributes: text_attr(attributes, "service.name") == "agents", ("store",))]
    routed = route_envelopes(envelopes, routes, ["rest"], "resourceLogs")
    assert run_ids(flatten_logs(routed["store"])) == ["a", "b"]
    assert run_ids(flatten_logs(routed["rest"])) == ["c", "d", "e"]
    assert routed["store"].count() == 1 and "Exchange" not in routed["store"]._jdf.queryExecution().executedPlan().toString()
    everything = route_envelopes(envelopes, [], ["all"], "resourceLogs")
    assert len(run_ids(flatten_logs(everything["all"]))) == 5


def test_fan_out_reads_once(spark, tmp_path, envelopes):
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(x):
        reads.add(1)
        return x

    flat = flatten_logs(envelopes).withColumn("li", seen(F.col("li").cast("string")))
    routes = [Route(resource_attr("service.name") == "agents", ("store", "copy"))]
    sinks = {
        "store": lambda rows: rows.select("li").write.parquet(str(tmp_path / "store")),
        "copy": lambda rows: rows.select("li").write.parquet(str(tmp_path / "copy")),
        "rest": nop_sink,
    }
    run_pipelines(flat, lambda rows: route(rows, routes, ["rest"]), sinks)
    assert spark.read.parquet(str(tmp_path / "store")).count() == spark.read.parquet(str(tmp_path / "copy")).count() == 2
    assert reads.value == 5


def test_fan_in_keeps_duplicates(spark):
    one = spark.createDataFrame([("a", 1)], "x string, y int")
    assert merge_sources(one, one.select("y", "x"), one).count() == 3


def test_debug_sink(spark, capsys):
    debug_sink(spark.range(3), 2)
    assert "only showing top 2 rows" in capsys.readouterr().out
