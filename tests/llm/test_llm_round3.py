"""Exact copies, source divergence and collocations on nulls, empty and long texts, ties, repeated rows, clashes and empty tables."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from runledger.llm import collocations, divergence, exact_dedup, sharding
from test_llm_cases import DOCS, prose, rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


# --- exact copies


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def test_copies(docs):
    marked = exact_dedup.mark_copies(docs).collect()
    texts = defaultdict(list)
    for r in marked:
        texts[r["text"] or ""].append(r)
    assert len(marked) == docs.count()
    assert Counter((r["doc_id"], r["text"]) for r in marked) == Counter((r[0], r[1]) for r in rows())
    for same in texts.values():
        ids = [r["doc_id"] for r in same if r["doc_id"] is not None]
        keep = max(ids) if ids else None
        assert {r["keep_id"] for r in same} == {keep}
        assert {r["group_size"] for r in same} == {len(same)}
        assert [r["doc_id"] for r in same if r["kept"]] == [keep]


def test_copies_told_apart_at_each_level(spark):
    head = "h" * exact_dedup.PREFIX_BYTES
    texts = ["short", head + "a", head + "b", "x" + head, head + "a", "other length"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    refined = {r["row"]["doc_id"]: r["full"] for r in exact_dedup.refine(df).collect()}
    assert {i for i, full in refined.items() if full is not None} == {1, 2, 4}  # 3 has their length, not their prefix
    assert refined[1].hex() == sha(texts[1])
    kept = {r["doc_id"] for r in exact_dedup.drop_copies(df).collect()}
    assert kept == {0, 2, 3, 4, 5}


def test_copies_with_full_cells(docs, monkeypatch):
    """With a single cell nothing is told apart early, and the result is the same."""
    want = Counter(map(tuple, exact_dedup.mark_copies(docs).collect()))
    monkeypatch.setattr(exact_dedup, "CELLS", 1)
    assert Counter(map(tuple, exact_dedup.mark_copies(docs).collect())) == want


def test_copies_when_a_third_is_one_text(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    marked = exact_dedup.mark_copies(df)
    assert marked.where("group_size = 1000 and keep_id = 2997").count() == 1000
    assert marked.where("kept").count() == 2001


def test_copies_that_differ_elsewhere_stay_alike_in_reruns(spark):
    data = [(1, "t", i) for i in range(20)]
    runs = [spark.createDataFrame(data, "doc_id long, text string, extra int").repartition(n) for n in (1, 3, 7)]
    assert len({exact_dedup.drop_copies(df).first()["extra"] for df in runs}) == 1


def test_copies_of_clashing_and_odd_columns(docs):
    names = "row full length head cell place n id stays chosen key same_length keep_id KEPT".split()
    odd = docs.select("*", *[F.lit(f"own {c}").alias(c) for c in names], F.create_map(F.lit("k"), F.col("lang")).alias("m"))
    marked = exact_dedup.mark_copies(odd)
    assert marked.columns == [*docs.columns, *names[:-2], "m", "keep_id", "group_size", "kept"]
    assert marked.where("row = 'own row' and full = 'own full' and place = 'own place' and m['k'] <=> lang").count() == docs.count()
    assert exact_dedup.drop_copies(odd).columns == odd.columns


def test_copies_of_nothing(none):
    assert exact_dedup.mark_copies(none).collect() == []
    assert exact_dedup.drop_copies(none).collect() == []
    assert "text" not in exact_dedup.mark_copies(none, keep_text=False).columns


# --- source divergence


def terms_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain_audit(docs, least, top):
    out = set()
    for lang in {d[2] or "" for d in docs}:
        mine = [(d[3] or "", terms_of(d[1])) for d in docs if (d[2] or "") == lang]
        spread = Counter(t for _, terms in mine for t in set(terms))
        kept = sorted(t for t, n in spread.items() if n >= least)
        groups = {s: Counter() for s, _ in mine}
        for source, terms in mine:
            groups[source].update(t for t in terms if spread[t] >= least)

        def chances(counts):
            total = sum(counts.values())
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        everything = chances(sum(groups.values(), Counter()))
        p = {s: chances(c) for s, c in groups.items()}

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s in groups:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in groups if o != s]
            terms = [(f(p[s][t], everything[t]), t) for t in kept if groups[s][t] and p[s][t] > everything[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                shown = found if part == "pair" else found[:top]
                out |= {(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(shown, 1)}
    return out


@pytest.mark.parametrize("least, top", [(10, 10), (2, 3), (1000, 10)])
def test_divergence(docs, least, top):
    got = divergence.audit(docs, least, top).collect()
    assert len(set(map(tuple, got))) == len(got)
    assert set(map(tuple, got)) == plain_audit(rows(), least, top)


def test_divergence_counts_copies(spark):
    """Copies across and within sources, nulls, a source without words, and a language without kept words."""
    data = [(i, prose(i % 4, 40), None if i % 7 == 0 else "en", f"s{i % 5}") for i in range(60)]
    data += [(100, "123 456", "en", "empty"), (101, None, "en", None), (102, "once", "xx", "a"), (103, "once", "xx", "b")]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    got = set(map(tuple, divergence.audit(df.select("*", F.lit(1).alias("key"), F.lit(2).alias("n"))).collect()))
    assert got == plain_audit(data, 10, 10)
    assert ("xx", "a", "pair", "b", 0, 1) in got


def test_divergence_flushes(spark, docs, monkeypatch):
    monkeypatch.setattr(divergence, "FLUSH_TERMS", 5)
    assert set(map(tuple, divergence.audit(docs, 2).collect())) == plain_audit(rows(), 2, 10)


def test_texts_are_collapsed(spark):
    df = spark.createDataFrame([("en", "a", "x"), ("en", "a", "x"), ("en", "b", "x"), ("de", "a", "x"), (None, "a", None)], "lang string, source string, text string")
    got = {(r["lang"], bytes(r["body"]), tuple(sorted((s["source"], s["n"]) for s in r["sources"]))) for r in divergence.collapse(df).collect()}
    assert got == {("en", b"x", (("a", 2), ("b", 1))), ("de", b"x", (("a", 1),)), ("", b"", (("a", 1),))}


def test_divergence_of_nothing(none):
    assert divergence.audit(none).collect() == []


# --- collocations


def plain_phrases(docs, least):
    f = defaultdict(Counter)
    for _, text, lang, *_ in docs:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            for k in range(1, 5):
                f["und" if lang is None else lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return f


def plain_mine(docs, least, top):
    out = set()
    for lang, f in plain_phrases(docs, least).items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        candidates = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        held = []
        for g, a in candidates.items():
            inside = [
                h for h in candidates if len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))
            ]
            if any(100 * candidates[h] >= 80 * a for h in inside):
                continue
            score, k = min((2000000 * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
            held.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(held)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out


def sentences() -> list[tuple]:
    texts = ["New York is big, new york City; in New York", "of the Rings\tof  the rings", "a a a a a a.b b b", "x", "ÄÖ  é\x01é ÄÖ\x0bäö"]
    out = [(i, texts[i % 5] + (f" w{i}" if i % 3 else ""), ["en", "de", None][i % 2 + (i % 11 == 0)], "s") for i in range(120)]
    return out + rows()


@pytest.mark.parametrize("least, top", [(30, 2000), (4, 2000), (2, 5)])
def test_collocations(spark, least, top):
    df = spark.createDataFrame([r[:3] for r in sentences()], "doc_id long, text string, lang string").repartition(3)
    clashing = df.select("*", *[F.lit(1).alias(c) for c in ("row", "body", "n", "chunk", "phrase", "rank", "key")])
    got = collocations.mine(clashing, least, top).collect()
    assert len(set(map(tuple, got))) == len(got)
    assert set(map(tuple, got)) == plain_mine(sentences(), least, top)


def test_chunks_hold_every_phrase_once(spark, monkeypatch):
    monkeypatch.setattr(collocations, "PERIOD", 2)
    monkeypatch.setattr(collocations, "BUFFER_BYTES", 100)
    texts = [r[1].encode() for r in sentences() if r[1]]
    chunks = collocations.parse(texts)
    # A chunk that goes on ends with the trigger that the next one begins with; what begins there is the next one's.
    words = Counter()
    for chunk, n in chunks.items():
        own = chunk.split() if chunk.endswith(b"\n") else chunk.split(b" ")[: -collocations.TRIGGER]
        for w in own:
            words[w] += n
    want = Counter(w.encode() for _, f in plain_phrases([(0, t.decode(), "en") for t in texts], 1).items() for g, c in f.items() if len(g) == 1 for w in g for _ in range(c))
    assert words == want
    assert sum(not c.endswith(b"\n") for c in chunks) > 20


def test_equal_passages_have_equal_chunks(monkeypatch):
    monkeypatch.setattr(collocations, "PERIOD", 8)
    passage = " ".join(prose(3, 200).replace(".", "").split())
    alone, inside = collocations.parse([passage.encode()]), collocations.parse([f"some words {passage} and more".encode()])
    assert len(set(alone) & set(inside)) >= len(alone) - 2 > 5


def test_long_words_and_texts(spark):
    texts = ["y" * 300_000 + " z", "q r " * 50_000, "", None]
    df = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    got = {r["phrase"]: r["a"] for r in collocations.mine(df).collect()}
    # Shorter ones are inside longer ones that are as frequent.
    assert got == {"q r q r": 49_999, "r q r q": 49_998}


def test_collocations_of_nothing(none, spark):
    assert collocations.mine(none).collect() == []
    assert collocations.mine(spark.createDataFrame([("only a few words", "en")], "text string, lang string")).collect() == []


# --- working names


def test_working_names_of_shards_are_free(docs):
    names = ["__n", "__h", "__b", "__start", "__before", "__place", "__ROWS", "rows", "___n"]
    odd = docs.select("doc_id", "text", *[F.concat(F.lit(c), F.coalesce("lang", F.lit(""))).alias(c) for c in names])
    got = sharding.assign_shards(odd, 4)
    assert Counter(map(tuple, got.drop("row_number", "shard", "slot").collect())) == Counter(map(tuple, odd.collect()))
    slots = [(r["shard"], r["slot"]) for r in got.collect()]
    assert sorted(slots) == sorted((i % 4, i // 4) for i in range(docs.count()))


def test_shards_of_documents_by_plain_figures(spark):
    """Sizes, checksums and the law of the registered query, in plain Python."""
    import zlib

    from runledger.llm.queries import SHARDS, op2_sharding

    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op2_sharding(spark, sf_dir).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in got} == {i: (len(t) + 1, zlib.crc32(t)) for i, t in texts.items()}
    assert {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}
    assert Counter((r["shard"], r["slot"]) for r in got) == Counter((i % SHARDS, i // SHARDS) for i in range(len(texts)))
