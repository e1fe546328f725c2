"""The registered query of SpotSigs: classes over all documents beside the comparison with edits."""

import os
import random
from collections import Counter

import pyarrow as pa

from runledger.llm import spotsigs
from runledger.llm.queries import REGISTRY
from runledger.session import setting
from test_llm_cases import DOCS, clashing, components_of, prose, rows


def wanted(data):
    """Id, text and class of every row, by all pairs."""
    texts = sorted({t or "" for _, t in data})
    sets = [set(s.tolist()) for s in spotsigs.signature_sets(pa.array(texts))]
    links = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if a and 5 * len(a & b) >= 4 * len(a | b)]
    label = dict(zip(texts, components_of(len(texts), links), strict=True))
    least = {}
    for d, t in sorted(data, key=lambda r: (r[0] is not None, r[0] or 0)):
        least.setdefault(label[t or ""], d)
    return Counter((d, len(t or ""), least[label[t or ""]]) for d, t in data)


def test_query_names_classes_of_texts_that_are_no_neighbours(spark, tmp_path):
    data = [(i, prose(i, 150)) for i in range(20)]
    data += [(50, data[3][1] + " the end of this"), (70, data[8][1]), (60, data[3][1].replace("the", "this", 1))]
    data += [(70, prose(900, 80)), (70, prose(900, 80)), (None, data[8][1]), (80, None), (81, "")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = REGISTRY["op5_spotsigs"](spark, str(tmp_path)).collect()
    want = wanted(data)
    assert {(50, 3), (60, 3)} <= {(d, c) for d, _, c in want}
    assert Counter((r["doc_id"], r["n_chars"], r["class_id"]) for r in got) == want


def test_rows_are_those_of_the_comparison(spark):
    df = clashing(spark.createDataFrame(rows(), DOCS).repartition(3))
    got = spotsigs.compare_in_classes(df)
    plain = spotsigs.compare_with_edits(df)
    assert got.columns == [*plain.columns, "class_id"] and "node" not in plain.columns
    assert Counter(map(tuple, got.drop("class_id").collect())) == Counter(map(tuple, plain.collect()))
    assert Counter((r["doc_id"], r["n_chars"], r["class_id"]) for r in got.collect()) == wanted([r[:2] for r in rows()])
    assert spotsigs.compare_in_classes(df.where("false")).count() == 0


def test_result_rows_are_not_shuffled_and_little_is_left_behind(spark):
    left = f"{spark.conf.get('spark.checkpoint.dir')}/runledger"
    before = set(os.listdir(left)) if os.path.isdir(left) else set()
    data = [(i, prose(i, 60)) for i in range(30)] + [(40 + i, prose(i, 60) + " and more") for i in range(5)]
    got = spotsigs.compare_in_classes(spark.createDataFrame(data, "doc_id long, text string").repartition(3))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan[: plan.index("MapInArrow")]
    assert {name.split("-")[0] for name in set(os.listdir(left)) - before} == {"classes"}
    assert spark.conf.get(spotsigs.SHUFFLES_REMOVED) == "false"
    assert Counter((r["doc_id"], r["n_chars"], r["class_id"]) for r in got.collect()) == wanted(data)


def test_classes_of_rows_of_one_id_in_small_blocks_and_batches(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "ROWS_PER_BLOCK", 5)
    data = [(i, prose(i, 60)) for i in range(12)]
    data += [(i, prose(11 - i, 60).replace("the", "this", 1)) for i in range(12)] + data[:4] + [(3, None), (None, data[7][1]), (None, "")]
    df = spark.createDataFrame(data, "doc_id int, text string").repartition(4)
    for size in ("1", "3"):
        with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", size):
            got = spotsigs.compare_in_classes(df).collect()
        assert Counter((r["doc_id"], r["n_chars"], r["class_id"]) for r in got) == wanted(data)


def test_rarest_signatures_meet_all_pairs_whatever_is_frequent(spark):
    draw = random.Random(5)
    sets = []
    for base in range(25):
        own = [*range(draw.randint(0, 20)), *(1000 * (base + 1) + k for k in range(draw.randint(1, 20)))]
        sets += [own, own[: max(1, len(own) * 9 // 10)], [*own, *range(500, 500 + len(own) // 4)]]
    sets = [[], [7], [7, 8], *map(sorted, {tuple(s) for s in sets})]
    signed = spark.createDataFrame(list(enumerate(sets)), "node long, signs array<int>").repartition(3)
    buckets = {}
    for r in spotsigs._rarest(signed, 0.8).collect():
        assert r["size"] == len(sets[r["node"]])
        buckets.setdefault(r["key"], set()).add(r["node"])
    met = {(a, b) for nodes in buckets.values() for a in nodes for b in nodes}
    linked = {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if i != j and a and 5 * len({*a} & {*b}) >= 4 * len({*a} | {*b})}
    assert len(linked) > 20 and linked <= met
