"""Envelopes are gathered in order, so that a task does not hold its rows once for each level."""

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from helpers import envelope, record, write_envelopes
from runledger.operators.extract import extract_rows, flatten_logs
from runledger.sources.otlp import scan_otlp_logs, to_otlp_envelopes, write_otlp


def test_envelopes_are_written_without_hashing_rows(spark, tmp_path, monkeypatch, capsys):
    source = write_envelopes(tmp_path / "in", *[envelope(record(f"r{i}", event="a"), record(f"r{i}", event="b"), service=f"s{i}") for i in range(300)])
    flat = flatten_logs(scan_otlp_logs(spark, source)).withColumn("n", F.expr("int(substring(resource.attributes[0].value.stringValue, 2)) div 2"))
    plans, json = [], DataFrameWriter.json

    def noted(self, path, *args, **named):
        self._df.explain()
        plans.append(capsys.readouterr().out)
        return json(self, path, *args, **named)

    monkeypatch.setattr(DataFrameWriter, "json", noted)
    out = str(tmp_path / "out")
    write_otlp(to_otlp_envelopes(flat.withColumn("ri", F.expr("int(substring(resource.attributes[0].value.stringValue, 2))")), ["n"]), out)
    assert plans[0].count("SortAggregate") == 3 and "ObjectHashAggregate" not in plans[0]
    assert scan_otlp_logs(spark, out).count() == 150
    got = extract_rows(flatten_logs(scan_otlp_logs(spark, out))).select("agentic_run_id", "event").collect()
    assert sorted(map(tuple, got)) == sorted((f"r{i}", e) for i in range(300) for e in "ab")
