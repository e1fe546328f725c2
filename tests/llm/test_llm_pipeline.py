"""The pipeline's stages, one after the other, on rows with nulls, copies and repeated rows; and the language of pages."""

from collections import Counter
from pathlib import Path

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from runledger.llm import language_id
from runledger.llm.queries import REGISTRY
from runledger.session import shared_dir
from test_llm_cases import DOCS, clashing, jaccard, plain_removal, prose, rows, shingle_weights

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3).cache()


def test_stages_one_by_one(spark, docs):
    (_, quality), (_, near), (_, passages), (_, mix), (_, pack) = corpus_pipeline.STAGES
    before = clashing(docs)
    clean = quality(spark, before, SF).cache()
    assert clean.columns == before.columns
    got = {(r["doc_id"], r["text"]) for r in clean.collect()}
    assert (3, prose(3, 91)) in got and not {d for d, _ in got} & {20, 21, 22, 60, 61, 62, 63, 64}
    once = near(spark, clean, SF).cache()
    assert once.columns == before.columns
    texts = [r["text"] for r in once.collect()]
    sets = [shingle_weights(t) for t in texts]
    assert len(set(texts)) == len(texts)
    assert all(jaccard(sets[i], sets[j]) < 0.8 for i in range(len(sets)) for j in range(i) if sets[i] and sets[j])
    rest = passages(spark, once, SF).cache()
    assert rest.columns == before.columns and rest.count() == len(texts)
    raw = [t.encode() for t in texts]
    want = Counter()
    for t, gone in zip(raw, plain_removal(raw, 400), strict=True):
        for low, high in reversed(gone):
            t = t[:low] + t[high:]
        want[t.decode("utf-8", "ignore")] += 1
    assert want == Counter(r["text"] for r in rest.collect())
    assert sum(map(len, want)) < sum(map(len, texts))
    taken = mix(spark, rest, SF).cache()
    assert taken.columns == before.columns
    assert set(map(str, taken.collect())) <= set(map(str, rest.collect()))
    pieces = pack(spark, taken, SF)
    assert sorted(r["sequence_id"] for r in pieces.collect()) == list(range(pieces.count()))


def test_only_the_result_is_left(spark, docs, tmp_path):
    """What the stages write on their way is removed; a stage called by hand keeps what its input is read from."""
    own = Path(shared_dir(spark), "runledger")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    before = set(own.glob("*"))
    result = corpus_pipeline.run(spark, str(tmp_path))
    left = set(own.glob("*")) - before
    assert len(left) == 1 and result.count() > 0 and str(left.pop()) in result.inputFiles()[0]
    (_, quality), (_, near), *_ = corpus_pipeline.STAGES
    lazy = quality(spark, docs, SF)
    assert near(spark, lazy, SF).count() > 0


def test_stages_on_an_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
        docs = docs if "text" in docs.columns else spark.createDataFrame([], DOCS)


def test_held_out_language(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    half = F.col("doc_id") % 2 == 0
    model = language_id.train(table.where(half))
    logs = language_id.text_log_likelihoods(F.col("text"), model)
    got = table.where(~half).select("lang", logs.alias("logs")).collect()
    right = [language_id.LANGUAGES[max(range(4), key=lambda i: r["logs"][i])] == r["lang"] for r in got]
    assert sum(right) >= 0.95 * len(right)


def test_evidence_of_pages(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.train(table)
    german = table.where("lang = 'de' and n_chars > 500").first()["text"]
    data = [(i, f"http://a.b.de/{i}", f"<html lang='de'><p>{german[i * 20:i * 20 + 200]}</p></html>") for i in range(20)]
    data += [(50, "http://a.b.de/x", None), (51, None, "<html lang=en><body>the of and with</body>"), (52, "nothing", ""), (53, "", None)]
    df = spark.createDataFrame([(*d, "own", "own") for d in data], "page_id long, url string, html string, logs string, vote string")
    got = {r["page_id"]: r for r in language_id.identify(df, model).collect()}
    assert len(got) == len(data) and got[0]["logs"] == "own"
    assert all(got[i]["lang"] == "de" for i in range(20)) and got[50]["lang"] == "de" and got[51]["lang"] == "en"
    assert got[51]["declared"] == "en" and got[52]["declared"] is None and got[53]["host"] == ""
    assert language_id.identify(df.where("false"), model).count() == 0


def test_every_query_covers_its_table(spark):
    for name in ("op4_lm_scoring", "op5_spotsigs", "op8_probminhash", "op10_suffix_dedup", "op2_sharding", "op3_mixing"):
        assert REGISTRY[name](spark, SF).select("doc_id").distinct().count() == 200
