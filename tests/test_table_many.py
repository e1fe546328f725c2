"""Tables of many small partitions."""

import os
import uuid
from urllib.parse import unquote

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from helpers import log_rows, new_table
from runledger.sources import table as table_module
from runledger.sources.directory import scan_runs
from runledger.sources.table import (
    append_batch, append_logs, compact_table, delete_run, drop_replaced, ensure_table, purge_table, scan_logs,
)


def rows(spark, n):
    return log_rows(spark, [(1 + i, f"r{i % 5}", "p", float(i), "e", f"{i}") for i in range(n)])


def kept(spark, name):
    return sorted((r["agentic_run_id"], r["id"]) for r in scan_logs(spark, name).collect())


@pytest.fixture
def described(monkeypatch):
    """Statements that ask the catalog about a table or a partition."""
    texts, sql = [], SparkSession.sql

    def noted(self, text, *args, **named):
        if text.startswith("DESCRIBE"):
            texts.append(text)
        return sql(self, text, *args, **named)

    monkeypatch.setattr(SparkSession, "sql", noted)
    return texts


@pytest.fixture
def dropping(monkeypatch):
    """Statements that drop partitions."""
    texts, sql = [], SparkSession.sql

    def noted(self, text, *args, **named):
        if " DROP " in text:
            texts.append(text)
        return sql(self, text, *args, **named)

    monkeypatch.setattr(SparkSession, "sql", noted)
    return texts


def in_batches(spark, n, era_ids):
    name = new_table(spark, 2, era_ids=era_ids)
    for batch in range(2):
        append_batch(rows(spark, n).where(F.col("id") % 2 == batch), batch, name)
    return name


def test_compaction_does_not_ask_about_each_partition(spark, described):
    asked = []
    for n in (20, 120):
        name = in_batches(spark, n, 10)
        described.clear()
        done = compact_table(spark, name)
        asked.append(len(described))
        assert len({era for _, era in done}) == n // 10 and kept(spark, name) == sorted((f"r{i % 5}", 1 + i) for i in range(n))
    assert asked[0] == asked[1]


def test_purge_does_not_ask_about_each_partition(spark, described):
    asked = []
    for n in (20, 120):
        name = in_batches(spark, n, 10)
        described.clear()
        gone = purge_table(spark, name, spark.createDataFrame([("r1",), ("r2",)], "agentic_run_id string")).collect()
        asked.append(len(described))
        assert {r["deleted"] for r in gone} == {n // 5}
        assert kept(spark, name) == sorted((f"r{i % 5}", 1 + i) for i in range(n) if i % 5 not in (1, 2))
    assert asked[0] == asked[1]


def test_eras_with_gaps(spark):
    name = new_table(spark, 2, era_ids=10)
    append_logs(rows(spark, 100).withColumn("agentic_run_id", F.expr("if(id % 30 = 7, 'r-x', agentic_run_id)")), name)
    before = kept(spark, name)
    purge_table(spark, name, spark.createDataFrame([("r-x",)], "agentic_run_id string"))
    assert kept(spark, name) == [r for r in before if r[0] != "r-x"] and len(before) == 100


def test_replaced_files_go_wherever_they_lie(spark, tmp_path):
    """The folder's name is one that a URI writes in another way."""
    schema = f"s_{uuid.uuid4().hex}"
    name = ensure_table(spark, schema, "logs", 2, era_ids=10, location=str(tmp_path / "a b%20c"))
    for batch in range(2):
        append_batch(rows(spark, 40).where(F.col("id") % 2 == batch), batch, name)

    def files():
        return sorted(f"{d}/{f}" for d, _, fs in os.walk(tmp_path) for f in fs if f.endswith(".parquet") and "bucket=" in d)

    def read():
        found = scan_logs(spark, name).select("_metadata.file_path").distinct().collect()
        return sorted(unquote(r["file_path"]).removeprefix("file:") for r in found)

    purge_table(spark, name, spark.createDataFrame([("r1",)], "agentic_run_id string"))
    assert files() == read()
    append_batch(rows(spark, 40).withColumn("id", F.col("id") + 40).where("id <= 60"), 5, name)
    compact_table(spark, name)
    drop_replaced(spark, name, older_than=0)
    assert files() == read() and len(kept(spark, name)) == 32 + 20


def partitions(spark, name):
    return {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}


def test_emptied_partitions_are_dropped_together(spark, dropping):
    """One row stays, all others go; the emptied partitions take a statement a hundred."""
    for n, statements in ((40, 1), (1200, 2)):
        name = new_table(spark, 1, era_ids=10)
        append_logs(rows(spark, n).withColumn("agentic_run_id", F.expr("if(id = 15, 'stays', agentic_run_id)")), name)
        assert len(partitions(spark, name)) == n // 10 + 1
        dropping.clear()
        gone = purge_table(spark, name, spark.createDataFrame([(f"r{i}",) for i in range(5)], "agentic_run_id string"))
        assert sum(r["deleted"] for r in gone.collect()) == n - 1 and len(dropping) == statements
        assert kept(spark, name) == [("stays", 15)] and partitions(spark, name) == {"bucket=0/era=1"}
        runs = scan_runs(spark, name).collect()
        assert [(r["agentic_run_id"], r["n"]) for r in runs] == [("stays", 1)]
        append_logs(rows(spark, 30), name)  # dropped partitions come back with the new rows alone
        assert len(kept(spark, name)) == 31


def test_a_purge_looks_for_files_while_it_counts(spark, monkeypatch):
    """What partitions hold and where they lie comes from one look at their files."""
    asked, size = [], table_module._sizes
    monkeypatch.setattr(table_module, "_sizes", lambda *args, **named: asked.append(named) or size(*args, **named))
    name = in_batches(spark, 60, 10)
    compact_table(spark, name)
    purge_table(spark, name, spark.createDataFrame([("r1",)], "agentic_run_id string"))
    delete_run(spark, name, "r2")
    assert [sorted(counts) for counts in asked] == [["left"], ["gone", "left"], ["gone", "left"]]
    assert kept(spark, name) == sorted((f"r{i % 5}", 1 + i) for i in range(60) if i % 5 not in (1, 2))
