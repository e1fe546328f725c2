from types import SimpleNamespace

import pytest
from pyspark.sql import DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from helpers import envelope, log_rows, new_table, record, write_envelopes
from runledger.operators.extract import extract_rows, flatten_logs, keep_identified
from runledger.operators.counts import count_by_run, count_prefix, count_run
from runledger.operators.filters import for_run
from runledger.operators import ids as ids_module
from runledger.operators.pages import get_page, pages_for_runs, paginate
from runledger.schema import TABLE_COLUMNS
from runledger.session import recorded_scratch, release_scratch, remove, setting, shared_dir, write_through
from runledger.sources.otlp import scan_otlp_logs
from runledger.sources import table as table_module
from runledger.sources.batches import read_records
from runledger.sources.directory import scan_runs
from runledger.sources.table import (
    append_batch, append_logs, compact_table, delete_run, drop_replaced, ensure_table, purge_table, scan_logs, table_settings,
)
from runledger.streaming.retry import Permanent


def rows(spark, n, run=lambda i: f"r{i % 5}", first=1):
    return log_rows(spark, [(first + i, run(i), "p", float(i), "e", f"{i}") for i in range(n)])


def ids(spark, name):
    return sorted(r["id"] for r in scan_logs(spark, name).collect())


def test_ensure_twice(spark):
    name = ensure_table(spark, buckets=4)
    append_logs(rows(spark, 3), name)
    assert ensure_table(spark, buckets=9) == name == "templogs.logs"
    assert ids(spark, name) == [1, 2, 3] and table_settings(spark, name)[0] == 4
    assert scan_logs(spark, name).columns == TABLE_COLUMNS


def test_one_spelling(spark):
    assert ensure_table(spark, "Audit", "Logs") == ensure_table(spark, "audit", "logs") == "audit.logs"


@pytest.mark.parametrize("schema, table", [("a b", "logs"), ("s", "x;y"), ("s", "")])
def test_bad_names(spark, schema, table):
    with pytest.raises(ValueError):
        ensure_table(spark, schema, table)


def test_append_and_read(spark):
    name = new_table(spark, 4)
    append_logs(rows(spark, 20), name)
    append_logs(rows(spark, 5, first=100), name)
    assert ids(spark, name) == list(range(1, 21)) + list(range(100, 105))
    assert get_page(scan_logs(spark, name), "r1").read().next_after == 101


def test_appended_rows_without_ids_follow_the_last(spark):
    name = new_table(spark, 4)
    append_logs(rows(spark, 20), name)
    append_logs(rows(spark, 10).drop("id"), name, order_cols=["timestamp"])
    assert ids(spark, name) == list(range(1, 31))
    later = scan_logs(spark, name).filter("id > 20").orderBy("id").collect()
    assert [int(r["event"] == "e" and r["timestamp"].timestamp()) for r in later] == list(range(10))
    with pytest.raises(ValueError):
        append_logs(rows(spark, 1).drop("id"), name)


def test_nothing_to_append(spark):
    name = new_table(spark, 4)
    append_logs(rows(spark, 1).filter("false"), name)
    assert append_batch(rows(spark, 1).filter("false"), 0, name) == 0
    assert ids(spark, name) == []


def test_replayed_batch_is_skipped(spark):
    name = new_table(spark, 4)
    assert append_batch(rows(spark, 10), 3, name) == 10
    assert append_batch(rows(spark, 10), 3, name) == 10
    assert append_batch(rows(spark, 5, first=50), 4, name) == 5
    assert ids(spark, name) == list(range(1, 11)) + list(range(50, 55))


def test_half_a_batch_is_an_error(spark):
    name = new_table(spark, 4)
    append_batch(rows(spark, 4), 3, name)
    with pytest.raises(RuntimeError):
        append_batch(rows(spark, 10), 3, name)
    assert ids(spark, name) == [1, 2, 3, 4]


def test_failed_append_leaves_nothing(spark):
    name = new_table(spark, 4)
    bad = rows(spark, 50).withColumn("event", F.when(F.col("id") == 49, F.raise_error(F.lit("broken"))).otherwise("e"))
    with pytest.raises(Exception, match="broken"):
        append_logs(bad, name)
    assert ids(spark, name) == []


def test_delete(spark):
    name = new_table(spark, 4)
    append_logs(rows(spark, 25), name)
    assert delete_run(spark, name, "r1") == 5
    assert delete_run(spark, name, "r1") == 0
    assert delete_run(spark, name, "nobody") == 0
    assert ids(spark, name) == [i for i in range(1, 26) if (i - 1) % 5 != 1]
    assert get_page(scan_logs(spark, name), "r1").read().records == []
    with pytest.raises(ValueError):
        delete_run(spark, name, "")


def test_delete_the_only_run_of_a_bucket(spark):
    name = new_table(spark, 1)
    append_logs(rows(spark, 6, run=lambda i: "only"), name)
    assert delete_run(spark, name, "only") == 6
    assert ids(spark, name) == []
    append_logs(rows(spark, 2, run=lambda i: "next", first=7), name)
    assert ids(spark, name) == [7, 8]


def partitions(spark, name):
    return {tuple(int(p.split("=")[1]) for p in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}


def files(spark, name, condition):
    return {r[0] for r in scan_logs(spark, name).filter(condition).select(F.input_file_name()).distinct().collect()}


def test_delete_rewrites_only_the_eras_of_the_run(spark):
    """A short run beside a long one: eras without the short run keep their files."""
    name = new_table(spark, 1, era_ids=100)
    append_logs(rows(spark, 500, run=lambda i: "short" if 150 <= i < 160 else "long"), name)
    append_logs(rows(spark, 100, run=lambda i: "short", first=600), name)  # an era of its own
    assert partitions(spark, name) == {(0, e) for e in range(7)}
    elsewhere = files(spark, name, "era <> 1")
    assert delete_run(spark, name, "short") == 110
    assert ids(spark, name) == [i for i in range(1, 501) if not 151 <= i <= 160]
    assert files(spark, name, "era <> 1") == {f for f in elsewhere if "era=6" not in f}
    assert (0, 6) not in partitions(spark, name)
    append_logs(rows(spark, 5, first=650), name)
    assert ids(spark, name)[-5:] == list(range(650, 655))


def test_cursor_skips_eras(spark):
    name = new_table(spark, 2, era_ids=10)
    append_logs(rows(spark, 100, run=lambda i: "r"), name)
    for after in (0, 8, 9, 10, 11, 55, 99, 100, 101):
        read = get_page(scan_logs(spark, name), "r", limit=7, after=after).read()
        assert [r["id"] for r in read.records] == list(range(after + 1, min(after + 8, 101)))
    text = plan(get_page(scan_logs(spark, name), "r", limit=7, after=55).fetched)
    assert "(era#" in text.split("PartitionFilters: ")[1] and ">= 5)" in text.split("PartitionFilters: ")[1]


def test_other_tables_are_refused(spark):
    name = new_table(spark, 1)
    spark.sql(f"CREATE TABLE {name}_y (id BIGINT) USING parquet")
    with pytest.raises(ValueError, match="ensure_table"):
        scan_logs(spark, f"{name}_y")


def test_external_tables_are_not_deleted_from(spark, tmp_path):
    name = new_table(spark, 1)
    spark.sql(f"CREATE TABLE {name}_x LIKE {name} LOCATION '{tmp_path}'")
    with pytest.raises(ValueError, match="external"):
        delete_run(spark, f"{name}_x", "r")


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_delete_in_a_managed_table(spark, mode):
    name = ensure_table(spark, "managed", f"logs_{mode}", 1)
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", mode):
        append_logs(rows(spark, 6, run=lambda i: f"r{i % 2}"), name)
        assert delete_run(spark, name, "r0") == 3
        assert ids(spark, name) == [2, 4, 6]
        assert delete_run(spark, name, "r1") == 3
        assert ids(spark, name) == []
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


def test_purge_a_list_of_runs(spark):
    """Each partition is rewritten once, others keep their files, emptied ones go."""
    name = new_table(spark, 2, era_ids=10)
    append_logs(rows(spark, 60, run=lambda i: f"r{i % 6}" if i < 40 else "late"), name)
    listed = spark.createDataFrame([("r1",), ("r4",), ("late",), ("nobody",), ("",), (None,), ("r1",)], "agentic_run_id string")
    counts = {r["agentic_run_id"]: r["deleted"] for r in purge_table(spark, name, listed).collect()}
    assert counts == {"r1": 7, "r4": 6, "late": 20, "nobody": 0}
    assert ids(spark, name) == [i for i in range(1, 41) if (i - 1) % 6 not in (1, 4)]
    assert max(era for _, era in partitions(spark, name)) == 4
    kept = files(spark, name, "true")
    assert purge_table(spark, name, listed.where("agentic_run_id = 'nobody'")).collect()[0]["deleted"] == 0
    assert purge_table(spark, name, listed.limit(0)).collect() == []
    assert files(spark, name, "true") == kept
    append_logs(rows(spark, 3, first=41), name)  # into a partition that was switched
    assert ids(spark, name)[-3:] == [41, 42, 43]
    assert delete_run(spark, name, "r2") > 0  # and rewritten again
    assert ids(spark, name) == sorted(i for i in ids(spark, name))


@pytest.mark.parametrize("fails", ["SET LOCATION", "parquet"])
def test_a_delete_that_breaks_off_loses_no_other_run(spark, monkeypatch, fails):
    name = new_table(spark, 1, era_ids=10)
    append_logs(rows(spark, 30, run=lambda i: "gone" if i % 3 == 0 else f"r{i % 3}"), name)
    before = [r["id"] for r in scan_logs(spark, name).where("agentic_run_id <> 'gone'").orderBy("id").collect()]
    done = []

    def broken_sql(self, text, *args, _sql=SparkSession.sql, **kwargs):
        if "SET LOCATION" in text:
            done.append(text)
            if len(done) == 2:
                raise OSError("broken off")
        return _sql(self, text, *args, **kwargs)

    def broken_write(self, *args, **kwargs):
        raise OSError("broken off")

    with monkeypatch.context() as patch:
        if fails == "parquet":
            patch.setattr(DataFrameWriter, "parquet", broken_write)
        else:
            patch.setattr(SparkSession, "sql", broken_sql)
        with pytest.raises(OSError, match="broken off"):
            delete_run(spark, name, "gone")
    others = scan_logs(spark, name).where("agentic_run_id <> 'gone'").orderBy("id")
    assert [r["id"] for r in others.collect()] == before
    left = scan_logs(spark, name).where("agentic_run_id = 'gone'").count()
    assert delete_run(spark, name, "gone") == left > 0
    assert ids(spark, name) == before


def test_odd_run_ids(spark):
    odd = ["it's", 'a"b', "x\\y", "né", "a/b=c", " "]
    name = new_table(spark, 4)
    append_logs(log_rows(spark, [(i + 1, run, "", 0.0, "", "1") for i, run in enumerate(odd)]), name)
    for i, run in enumerate(odd):
        assert [r["id"] for r in get_page(scan_logs(spark, name), run).read().records] == [i + 1]
    assert [delete_run(spark, name, run) for run in odd] == [1] * len(odd)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_run_reads_its_bucket_and_pushes_its_filters(spark):
    name = new_table(spark, 4)
    append_logs(rows(spark, 20), name)
    page = get_page(scan_logs(spark, name), "r1", after=3)
    text = plan(page.fetched)
    assert "(bucket#" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(agentic_run_id,r1)" in text and "GreaterThan(id,3)" in text and "<= 17)" in text
    assert "Exchange" not in text and "TakeOrderedAndProject" in text


def test_a_page_searches_as_many_eras_as_it_takes(spark):
    """A run in 40 eras: a page reads one, or doubles them until it is full; later files need not even be there."""
    name = new_table(spark, 1, era_ids=10)
    append_logs(rows(spark, 400, run=lambda i: "r", first=0), name)
    logs = scan_logs(spark, name)
    assert get_page(logs, "r", limit=5).eras == [0]
    assert get_page(logs, "r", limit=9).eras == [0, 1, 2]  # nine ids beyond 0, and a tenth to know there is more
    assert get_page(logs, "r", limit=60, after=105).eras == list(range(10, 17))
    assert get_page(logs, "r", limit=5, after=397).eras == [39]
    assert get_page(logs, "nobody", limit=5).eras == list(range(40))
    assert get_page(logs, "r", phase="none", limit=5).read().records == []
    for i in range(2, 40):
        remove(spark, table_module._location(spark, name, f"PARTITION (bucket = 0, era = {i})"))
    read = get_page(scan_logs(spark, name), "r", limit=8).read()
    assert [r["id"] for r in read.records] == list(range(1, 9)) and read.has_more


def test_slices_follow_runs_and_eras_not_batches(spark, monkeypatch):
    """300 small batches with ids far apart: as many sizes as runs and eras, and the same positions."""
    name = new_table(spark, 2, era_ids=100 * 1000)
    made = [(1000 * i + j, f"r{j}", "p", 0.0, "e", "1") for i in range(300) for j in range(1, 4)]
    append_logs(log_rows(spark, made), name)
    sizes = []

    def write(df, what, _write=ids_module.write_through):
        out = _write(df, what)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(ids_module, "write_through", write)
    walk = paginate(scan_logs(spark, name), 10, slice_width=200)
    assert sizes == [9]  # three runs in three eras of a hundred batches each
    assert sorted(tuple(r) for r in walk.collect()) == sorted((f"r{j}", 1000 * i + j, i // 10) for i in range(300) for j in range(1, 4))
    assert "body" not in plan(walk)


def test_few_cursors_read_few_buckets(spark):
    name = new_table(spark, 16)
    append_logs(rows(spark, 200, run=lambda i: f"r{i % 40}"), name)
    cursors = spark.createDataFrame([("r3", 50), ("r3x", 0)], "agentic_run_id string, after long")
    found = pages_for_runs(scan_logs(spark, name), 2, cursors)
    assert sorted((r["id"], r["has_more"]) for r in found.collect()) == [(84, True), (124, True)]
    scans = [part for part in plan(found).split("FileScan parquet")[1:] if "body#" in part.split("]")[0]]
    assert scans and all("(bucket#" in s.split("PartitionFilters: ")[1].split("]")[0] for s in scans)
    assert all("GreaterThan(id,50)" in s or "(id#" in s and "> 50)" in s for s in scans)
    assert pages_for_runs(scan_logs(spark, name), 2, cursors.filter("after = 0")).collect() == []


def test_counting_a_run_reads_one_column(spark):
    name = new_table(spark, 4)
    append_logs(rows(spark, 20), name)
    assert "ReadSchema: struct<agentic_run_id:string>" in plan(for_run(scan_logs(spark, name), "r1").groupBy().count())


def test_a_hot_run_is_written_by_many_tasks(spark):
    name = new_table(spark, 2)
    run = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 500))
    many = spark.range(1, 60001, 1, 6).select(
        "id", run.alias("agentic_run_id"), F.lit("p").alias("phase"), F.current_timestamp().alias("timestamp"),
        F.sha2(F.col("id").cast("string"), 256).alias("event"), F.parse_json(F.lit("1")).alias("body"),
    )
    with setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k"):
        append_logs(many, name)
    files = for_run(scan_logs(spark, name), "hot").select(F.input_file_name().alias("f")).distinct().count()
    assert files > 1 and scan_logs(spark, name).count() == 60000


def test_scratch_is_released_but_for_what_is_read(spark):
    noted = []
    with recorded_scratch(noted):
        kept, gone = (write_through(spark.range(3), name) for name in ("kept", "gone"))
    assert len(noted) == 2 and kept.count() == gone.count() == 3
    release_scratch(spark, noted, kept.where("id > 0"))
    assert len(noted) == 1 and kept.count() == 3
    with pytest.raises(Exception, match="(?i)exist"):
        spark.range(1).join(gone).count()


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_shared_folder_where_none_is_set():
    def session(master):
        context = SimpleNamespace(master=master, applicationId="app-1")
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)

    assert shared_dir(session("local[2]")) == shared_dir(session("local[2]"))
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            shared_dir(session(master))


def test_moved_rows_have_no_order_of_arrival(spark, tmp_path):
    lines = [envelope(*[record("r", event=f"e{i}") for i in range(50)]) for _ in range(4)]
    rows = keep_identified(extract_rows(flatten_logs(scan_otlp_logs(spark, write_envelopes(tmp_path, *lines)))))
    name = new_table(spark, 4)
    with pytest.raises(ValueError, match="moved"):
        append_batch(rows.repartition(3), 0, name)
    assert ids(spark, name) == []


# --- records of batches


def folder(spark, name):
    return table_module._location(spark, name)


def other_bodies(df):
    return df.withColumn("body", F.parse_json(F.lit('"another"')))


def test_a_batch_that_differs_in_its_bodies_is_not_a_replay(spark):
    name = new_table(spark, 4)
    append_batch(rows(spark, 10), 3, name)
    with pytest.raises(Permanent, match="others"):
        append_batch(other_bodies(rows(spark, 10)), 3, name)
    assert ids(spark, name) == list(range(1, 11))


def test_a_replay_is_known_whatever_was_appended_since(spark):
    """The latest era holds no batch at all, and still batch 1 is not written again."""
    name = new_table(spark, 4, era_ids=1000)
    for batch in range(2):
        append_batch(rows(spark, 10, first=1 + 10 * batch), batch, name)
    append_logs(rows(spark, 5000, first=10_000), name)
    assert append_batch(rows(spark, 10, first=11), 1, name) == 10
    assert scan_logs(spark, name).where("batch_id = 1").count() == 10


def test_a_replay_does_not_bring_back_what_was_deleted(spark):
    name = new_table(spark, 4)
    append_batch(rows(spark, 10), 3, name)
    assert delete_run(spark, name, "r1") == 2
    assert append_batch(rows(spark, 10), 3, name) == 10
    assert scan_logs(spark, name).count() == 8


def test_records_of_batches(spark):
    name = new_table(spark, 4)
    append_batch(rows(spark, 10), 3, name)
    append_batch(rows(spark, 4, first=20), 4, name)
    append_batch(rows(spark, 4).limit(0), 5, name)  # nothing to note
    found = {r["batch_id"]: r for r in read_records(spark, folder(spark, name)).collect()}
    assert {b: (r["n"], r["done"]) for b, r in found.items()} == {3: (10, True), 4: (4, True)}
    assert found[3]["digest"] != found[4]["digest"]


@pytest.mark.parametrize("fails", ["_lay_out", "add_runs", "write_record"])
def test_a_batch_that_breaks_off_is_finished_by_its_replay(spark, monkeypatch, fails):
    """Before the rows, after them, and before the record says so; then the directory is right again too."""
    name = new_table(spark, 4, era_ids=100)
    append_batch(rows(spark, 50), 0, name)
    real = getattr(table_module, fails)

    def broken(*args, **kwargs):
        if fails != "write_record" or args[2].done:
            raise OSError("power cut")
        return real(*args, **kwargs)

    batch = rows(spark, 30, first=1000)
    with monkeypatch.context() as patch:
        patch.setattr(table_module, fails, broken)
        with pytest.raises(OSError, match="power cut"):
            append_batch(batch, 1, name)
    assert append_batch(batch, 1, name) == 30
    assert append_batch(batch, 1, name) == 30
    assert ids(spark, name) == [*range(1, 51), *range(1000, 1030)]
    assert_directory(spark, name)


def test_a_batch_that_was_begun_in_vain_gives_its_id_free(spark, monkeypatch):
    name = new_table(spark, 4)

    def broken(*args):
        raise OSError("power cut")

    with monkeypatch.context() as patch:
        patch.setattr(table_module, "_lay_out", broken)
        with pytest.raises(OSError):
            append_batch(rows(spark, 10), 0, name)
    assert append_batch(other_bodies(rows(spark, 7)), 0, name) == 7
    assert ids(spark, name) == list(range(1, 8))


# --- the run directory


def assert_directory(spark, name):
    logs, runs = scan_logs(spark, name), scan_runs(spark, name)
    own = logs.groupBy("agentic_run_id", "era").agg(F.count(F.lit(1)), F.min("id"), F.max("id"))
    assert sorted(map(tuple, runs.collect())) == sorted(map(tuple, own.collect()))
    assert sorted(count_by_run(runs).collect()) == sorted(count_by_run(logs).collect())
    for prefix in ("r", "r1", "none", ""):
        assert count_prefix(runs, prefix).first() == count_prefix(logs, prefix).first()
    assert count_run(runs, "r1").first() == count_run(logs, "r1").first()


def test_directory_follows_appends_replays_and_deletes(spark):
    name = new_table(spark, 4, era_ids=50)
    assert_directory(spark, name)
    append_logs(rows(spark, 120, run=lambda i: f"r{i % 13}"), name)
    append_batch(rows(spark, 30, first=200), 0, name)
    append_batch(rows(spark, 30, first=200), 0, name)
    assert_directory(spark, name)
    delete_run(spark, name, "r1")
    delete_run(spark, name, "nobody")
    assert_directory(spark, name)
    purge_table(spark, name, spark.createDataFrame([("r2",), ("r12",)], "agentic_run_id string"))
    append_logs(rows(spark, 10, first=400, run=lambda i: "r1"), name)
    assert_directory(spark, name)


def test_counting_by_the_directory_reads_no_log_file(spark):
    name = new_table(spark, 4)
    append_logs(rows(spark, 20), name)
    runs, own = scan_runs(spark, name), folder(spark, name)
    for counted in (count_run(runs, "r1"), count_by_run(runs), count_prefix(runs, "r")):
        text = plan(counted)
        assert "_runs" in text and f"{own}]" not in text and "body" not in text
    assert "StringStartsWith(agentic_run_id,r)" in plan(count_prefix(runs, "r"))
    assert "EqualTo(agentic_run_id,r1)" in plan(count_run(runs, "r1"))


def test_directory_of_a_delete_that_broke_off(spark, monkeypatch):
    name = new_table(spark, 2, era_ids=10)
    append_logs(rows(spark, 60), name)

    def broken(*args, **kwargs):
        raise OSError("power cut")

    with monkeypatch.context() as patch:
        patch.setattr(table_module, "add_runs", broken)
        with pytest.raises(OSError):
            delete_run(spark, name, "r1")
    assert delete_run(spark, name, "r1") == 0  # it is all gone, and now the directory knows
    assert_directory(spark, name)


def test_directory_of_a_table_that_had_none(spark):
    name = new_table(spark, 4)
    append_logs(rows(spark, 20), name)
    spark.sql(f"DROP TABLE {name}_runs")
    assert ensure_table(spark, *name.split(".")) == name
    assert_directory(spark, name)


# --- compaction


def table_files(spark, name):
    return scan_logs(spark, name).select(F.input_file_name()).distinct().count()


def test_compaction(spark):
    name = new_table(spark, 2, era_ids=100)
    for i in range(6):
        append_logs(rows(spark, 40, first=1 + 40 * i), name)
    before, n = table_files(spark, name), ids(spark, name)
    reader = scan_logs(spark, name).select("id")
    reader._jdf.queryExecution().executedPlan()  # planned before, run in the middle and after
    assert {era for _, era in compact_table(spark, name)} == {0, 1}
    assert sorted(r["id"] for r in reader.collect()) == n
    assert ids(spark, name) == n and table_files(spark, name) < before
    assert [t for t in files(spark, name, "era < 2") if "_rewritten" not in t] == []
    assert_directory(spark, name)
    assert compact_table(spark, name) == []  # nothing left to do
    assert drop_replaced(spark, name) == 0 and drop_replaced(spark, name, 0) == 4 and drop_replaced(spark, name, 0) == 0
    assert ids(spark, name) == n
    append_logs(rows(spark, 10, first=500), name)
    assert delete_run(spark, name, "r1") > 0
    assert_directory(spark, name)


def test_compaction_keeps_files_of_the_target_size(spark):
    name = new_table(spark, 1, era_ids=100)
    for i in range(4):
        append_logs(rows(spark, 40, first=1 + 40 * i), name)
    assert compact_table(spark, name, target_bytes=1) == []  # every file is as large as that
    assert compact_table(spark, name, open_eras=2) == []
    assert compact_table(spark, name, open_eras=0) == [(0, 0), (0, 1)]


def test_compaction_that_breaks_off(spark, monkeypatch):
    name = new_table(spark, 2, era_ids=100)
    for i in range(6):
        append_logs(rows(spark, 40, first=1 + 40 * i), name)
    n, done = ids(spark, name), []

    def broken_sql(self, text, *args, _sql=SparkSession.sql, **kwargs):
        if "SET LOCATION" in text and len(done) == 1:
            raise OSError("broken off")
        if "SET LOCATION" in text:
            done.append(text)
        return _sql(self, text, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(SparkSession, "sql", broken_sql)
        with pytest.raises(OSError):
            compact_table(spark, name)
    assert ids(spark, name) == n
    assert compact_table(spark, name) and ids(spark, name) == n


def rows_read(spark, df):
    """Rows that the scans of a query hand on, after row groups were skipped."""
    with setting(spark, "spark.sql.adaptive.enabled", "false"):
        df = df.select("*")
        df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.mark.parametrize("rewritten", [False, True])
def test_an_absent_run_in_a_full_bucket_reads_no_row_group(spark, rewritten):
    name = new_table(spark, 1, era_ids=10_000)
    for i in range(2):
        append_logs(rows(spark, 500, run=lambda i: f"run-{i * 2:04d}", first=1 + 500 * i), name)
    if rewritten:
        assert compact_table(spark, name, open_eras=0) == [(0, 0)]
    there = for_run(scan_logs(spark, name), "run-0100").select("id")
    absent = [for_run(scan_logs(spark, name), f"run-{i:04d}").select("id") for i in range(101, 161, 6)]  # between runs that are there
    assert there.count() == 2 and rows_read(spark, there) >= 2
    assert sum(rows_read(spark, df) > 0 for df in absent) <= 2  # a Bloom filter may err, with odds of one in a hundred


def test_bloom_filters_where_runs_are_too_many_for_a_dictionary(spark, tmp_path):
    n = 100_000
    runs = spark.range(0, n, 1, 1).select(F.sha2(F.col("id").cast("string"), 256).alias("agentic_run_id"), "id")
    for name, options in (("plain", {}), ("filtered", table_module.FILE_OPTIONS)):
        runs.sortWithinPartitions("agentic_run_id").write.options(**options).parquet(str(tmp_path / name))
    plain, filtered = (sum(f.stat().st_size for f in (tmp_path / d).glob("*.parquet")) for d in ("plain", "filtered"))
    assert plain < filtered < plain + 3 * n
    absent = F.col("agentic_run_id") == F.sha2(F.lit("absent"), 256)
    reads = {d: rows_read(spark, spark.read.parquet(str(tmp_path / d)).where(absent).select("id")) for d in ("plain", "filtered")}
    assert reads["filtered"] == 0 < reads["plain"]
