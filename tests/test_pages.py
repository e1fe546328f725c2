import json
import random

import pytest
from pyspark.sql import functions as F

from helpers import log_rows
from runledger.operators.counts import count_by_run, count_prefix, count_run
from runledger.operators.ids import assign_ids, positions
from runledger.operators.pages import get_page, page_bounds, pages_for_runs, paginate
from runledger.operators.purge import purge_runs
from runledger.operators.render import pages_text, record_json, render_delete, render_json, render_page, render_text


@pytest.fixture(scope="module")
def logs(spark):
    """Run a: 5 rows; run b: 3 rows; ids interleaved."""
    rows = [
        (1, "a", "planning", 0.0, "e1", '{"msg":"hello"}'),
        (2, "b", "planning", 1.0, "e1", '"text"'),
        (3, "a", "planning", 1.5, "e2", '"line one\\nline two"'),
        (5, "a", "planning", 2.0, "e3", "null"),
        (8, "b", "", 2.0, "e2", None),
        (9, "a", "execution", 3.0, "e4", "5"),
        (11, "a", "execution", 4.0, "e5", None),
        (12, "b", "execution", 5.0, "e3", '[1,2]'),
    ]
    return log_rows(spark, rows).cache()


def ids(page):
    return [r["id"] for r in page.rows.orderBy("id").collect()]


def test_whole_run(logs):
    page = get_page(logs, "a")
    assert ids(page) == [1, 3, 5, 9, 11]
    assert page.summary.first() == ("a", 5, False, 11)


def test_phase(logs):
    assert ids(get_page(logs, "a", phase="planning")) == [1, 3, 5]
    assert ids(get_page(logs, "a", phase="")) == [1, 3, 5, 9, 11]


def test_look_ahead_and_cursor(logs):
    first = get_page(logs, "a", limit=2).read()
    assert [r["id"] for r in first.records] == [1, 3] and first.has_more and first.next_after == 3
    second = get_page(logs, "a", limit=2, after=first.next_after).read()
    assert [r["id"] for r in second.records] == [5, 9] and second.has_more
    third = get_page(logs, "a", limit=2, after=second.next_after).read()
    assert [r["id"] for r in third.records] == [11] and not third.has_more


def test_limit_equal_to_the_number_of_rows(logs):
    assert get_page(logs, "a", limit=5).summary.first()["has_more"] is False
    assert get_page(logs, "a", limit=4).summary.first()["has_more"] is True


def test_cap(spark):
    many = log_rows(spark, [(i, "r", "", 0.0, "", "1") for i in range(1, 1202)])
    page = get_page(many, "r", limit=9999)
    assert page.fetched.count() == 1001
    assert page.summary.first() == ("r", 1000, True, 1000)


def test_unknown_run_is_an_empty_page(logs):
    page = get_page(logs, "nobody")
    assert page.summary.first() == ("nobody", 0, False, None)
    assert json.loads(render_json(page).first()[0]) == {"agentic_run_id": "nobody", "records": [], "has_more": False}
    assert [r["line"] for r in render_text(page).collect()] == ["agentic_run_id: nobody", "records: 0", "has_more: false", ""]


def test_bad_parameters(logs):
    for bad in ({"run_id": ""}, {"run_id": "a", "limit": 0}, {"run_id": "a", "after": -1}):
        with pytest.raises(ValueError):
            get_page(logs, **bad)


def test_json_page(logs):
    found = json.loads(render_json(get_page(logs, "a", phase="execution", limit=1)).first()[0])
    assert found == {
        "agentic_run_id": "a",
        "phase": "execution",
        "records": [{"id": 9, "phase": "execution", "timestamp": "1970-01-01T00:00:03Z", "event": "e4", "body": 5}],
        "has_more": True,
    }


def test_missing_body_is_shown_as_null(logs):
    found = [json.loads(r[0])["body"] for r in logs.filter("body IS NULL OR id = 5").select(record_json()).collect()]
    assert found == [None, None, None]


def test_run_ids_are_quoted(spark):
    odd = 'a"b\\é'
    rows = log_rows(spark, [(1, odd, "", 0.0, "", "1")])
    assert json.loads(render_json(get_page(rows, odd)).first()[0])["agentic_run_id"] == odd


def test_text_page(logs):
    lines = render_text(get_page(logs, "a")).orderBy("line_no").collect()
    assert [r["line_no"] for r in lines] == list(range(1, 10))
    assert [r["line"] for r in lines] == [
        "agentic_run_id: a",
        "records: 5",
        "has_more: false",
        "",
        '1970-01-01T00:00:00Z: {"msg":"hello"}',
        "1970-01-01T00:00:01.5Z: line one\nline two",
        "1970-01-01T00:00:02Z: ",
        "1970-01-01T00:00:03Z: 5",
        "1970-01-01T00:00:04Z: ",
    ]


@pytest.mark.parametrize("format, columns", [("text", ["line_no", "line"]), ("json", ["value"]), ("xml", ["value"]), ("TEXT", ["value"])])
def test_format(logs, format, columns):
    assert render_page(get_page(logs, "a", format=format)).columns == columns


def test_pages_of_all_runs(spark, logs):
    found = pages_for_runs(logs, 3).orderBy("id").collect()
    assert [(r.agentic_run_id, r.id, r.has_more) for r in found] == [
        ("a", 1, True), ("b", 2, False), ("a", 3, True), ("a", 5, True), ("b", 8, False), ("b", 12, False),
    ]
    cursors = spark.createDataFrame([("a", 3), ("b", 12), ("c", 0)], "agentic_run_id string, after long")
    behind = pages_for_runs(logs, 2, cursors).orderBy("id").collect()
    assert [(r.id, r.has_more) for r in behind] == [(5, True), (9, True)]
    bounds = page_bounds(logs, 2, cursors).collect()
    assert [(r.agentic_run_id, r.next_after, r.records) for r in bounds] == [("a", 9, 2)]
    assert pages_text(pages_for_runs(logs, 2)).filter("line_no = 2").select("line").distinct().collect() == [("records: 2",)]


def test_walk_agrees_with_a_client(logs):
    numbered = paginate(logs, 2, slice_width=4).filter("agentic_run_id = 'a'").orderBy("id").collect()
    walked, after, page = [], 0, 0
    while True:
        read = get_page(logs, "a", limit=2, after=after).read()
        walked += [(r["id"], page) for r in read.records]
        if not read.has_more:
            break
        after, page = read.next_after, page + 1
    assert [(r["id"], r["page"]) for r in numbered] == walked


@pytest.mark.parametrize("width", [1, 7, 100, 1 << 20])
def test_positions_of_a_hot_run(spark, width):
    """A third of all rows in one run, ids with gaps, slices of any width."""
    rng = random.Random(width)
    rows, next_id = [], 0
    for _ in range(900):
        next_id += rng.choice([1, 1, 1, 40])
        rows.append((next_id, "hot" if rng.random() < 0.34 else f"r{rng.randrange(40)}"))
    rng.shuffle(rows)
    made = spark.createDataFrame(rows, "id long, agentic_run_id string").repartition(5)
    want, seen = {}, {}
    for i, run in sorted(rows):
        seen[run] = seen.get(run, 0) + 1
        want[i] = seen[run]
    assert {r["id"]: r["position"] for r in positions(made, width).collect()} == want
    some = {r["id"]: r["position"] for r in positions(made, width, first=7).collect()}
    assert some == {i: p for i, p in want.items() if p <= 7}
    bounds = {r["agentic_run_id"]: (r["records"], r["has_more"]) for r in page_bounds(made.withColumn("phase", F.lit("")), 10, slice_width=width).collect()}
    assert bounds == {run: (min(n, 10), n > 10) for run, n in seen.items()}


def test_bounds_prune_before_the_shuffle(logs):
    text = page_bounds(logs, 2)._jdf.queryExecution().executedPlan().toString()
    partial = text.index("Partial", text.index("WindowGroupLimit"))
    assert "Exchange" in text[:partial] and "body" not in text.split("InMemoryTableScan")[0]


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_assigned_ids(spark, partitions):
    rng = random.Random(partitions)
    rows = [(rng.choice(["x", "x", "x", "y"]), i) for i in range(500)]
    rng.shuffle(rows)
    made = assign_ids(spark.createDataFrame(rows, "k string, n long"), ["k", "n"], 10, partitions)
    assert sorted((r["id"], r["k"], r["n"]) for r in made.collect()) == [(11 + i, *row) for i, row in enumerate(sorted(rows))]


def test_assigned_ids_of_nothing(spark):
    assert assign_ids(spark.range(0).select(F.col("id").alias("n")), ["n"]).collect() == []


def test_counts(logs):
    assert count_run(logs, "a").first()[0] == 5 and count_run(logs, "x").first()[0] == 0
    assert dict(count_by_run(logs).collect()) == {"a": 5, "b": 3}
    assert count_prefix(logs, "").first()[0] == 8 and count_prefix(logs, "b").first()[0] == 3


def test_prefix_is_taken_literally(spark):
    rows = log_rows(spark, [(1, "e2e_x-1", "", 0.0, "", "1"), (2, "e2eyx-1", "", 0.0, "", "1"), (3, "e2e%-1", "", 0.0, "", "1")])
    assert count_prefix(rows, "e2e_x-").first()[0] == 1 and count_prefix(rows, "e2e%").first()[0] == 1


def test_purge(spark, logs):
    runs = spark.createDataFrame([("a",), ("a",), ("none",)], "agentic_run_id string")
    survivors, deleted = purge_runs(logs, runs)
    assert sorted(r["id"] for r in survivors.collect()) == [2, 8, 12] and survivors.columns == logs.columns
    assert {tuple(r) for r in deleted.collect()} == {(5, "a"), (0, "none")}
    assert sorted(r[0] for r in render_delete(deleted).collect()) == [
        '{"deleted":0,"agentic_run_id":"none"}',
        '{"deleted":5,"agentic_run_id":"a"}',
    ]
