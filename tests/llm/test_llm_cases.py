"""Every operator on nulls, empty and long texts, ties, repeated rows, clashing columns and empty tables."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from runledger.llm import (
    buckets, line_quality, lm_scoring, mixing, packing, probminhash, sharding, spotsigs, suffix_dedup, textbytes, url_filter,
)
from runledger.llm.common import number_rows
from runledger.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    common = ["the", "of", "and", "is", "la", "der", "que"]
    made = ["".join(rng.choice("abcdeéfghiß") for _ in range(rng.randint(2, 9))) for _ in range(200)]
    words = [rng.choice(common if rng.random() < 0.4 else made) for _ in range(n)]
    return "\n".join(" ".join(words[i : i + 12]).capitalize() + "." for i in range(0, n, 12))


def rows() -> list[tuple]:
    passage = prose(900, 120)
    out = [(i, prose(i, 40 + 17 * i), "en", f"s{i % 3}", None) for i in range(12)]
    out += [(20, None, None, None, None), (21, "", "en", "s1", 0), (22, " \n\t ", "en", "", 4), (None, "no id", "en", "s1", 5)]
    out += [(23, prose(5, 125), "en", "s9", 1)] * 3  # the same row
    out += [(23, "another text of the same id", "en", "s9", 1)]
    out += [(30 + i, prose(7, 159), "fr", "s0", 1) for i in range(6)]  # copies
    out += [(40 + i, prose(60 + i, 90) + "\n" + passage + "\n" + prose(70 + i, 30 + 7 * i), "de", "s2", 1) for i in range(8)]
    out += [(50 + i, prose(80, 300).replace("the", f"the{i}", 2 + i), "de", None, 1) for i in range(5)]  # near copies
    out += [(60, "x" * 3000, "en", "s1", 3000), (61, "ab " * 1500, "en", "s1", 4500), (62, "ß" * 901, "de", "s1", 901)]
    out += [(63, "word", "en", "s1", 4), (64, "word", "es", "s1", 4), (65, "<|endoftext|>日本語 \x1c text\x85", "en", "s1", 3)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def clashing(df):
    names = "row node key block size shard slot host path text2 label kept spans h target copies t1 t2 bucket start".split()
    return df.select("*", *[F.lit(f"own {n}").alias(n) for n in names])


# --- numbering, sharding


def test_numbers_are_gapless_and_depend_on_rows_alone(docs):
    one, n = number_rows(docs.select("doc_id", "text"))
    two, _ = number_rows(docs.repartition(5, "text").select("doc_id", "text"))
    assert n == docs.count()
    assert sorted(r["number"] for r in one.collect()) == list(range(n))
    assert Counter(map(tuple, one.collect())) == Counter(map(tuple, two.collect()))


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 100, 1001])
def test_permutation_and_its_inverse(spark, n):
    df = spark.range(n).select("id", sharding.permute(F.col("id"), n).alias("p"))
    df = df.select("*", sharding.permute(F.col("p"), n, inverse=True).alias("back"))
    got = df.collect()
    assert sorted(r["p"] for r in got) == list(range(n))
    assert all(r["back"] == r["id"] for r in got)


@pytest.mark.parametrize("shards", [1, 7, 8, 100])
def test_shards(docs, shards):
    got = sharding.assign_shards(clashing(docs), shards).collect()
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    sizes = [len(by[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == docs.count()
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert got[0]["host"] == "own host" and got[0].asDict().keys() >= {"row_number", "kept"}
    again = sharding.assign_shards(clashing(docs).repartition(7), shards)
    assert Counter(map(str, again.collect())) == Counter(map(str, got))
    located = again.select(
        sharding.row_number_at(F.col("shard"), F.col("slot"), docs.count(), shards).alias("a"), F.col("row_number").alias("b")
    )
    assert all(r["a"] == r["b"] for r in located.collect())


def test_empty_tables(spark, none):
    ids = spark.createDataFrame([], "doc_id long")
    for df in (
        sharding.assign_shards(none, 8), mixing.mix(none.withColumn("size", F.lit(0))), mixing.mix_documents(none),
        lm_scoring.score(none, ids), spotsigs.compare_with_edits(none), spotsigs.fingerprint(none),
        spotsigs.near_classes(none),
        line_quality.judge_lines(none), probminhash.near_duplicates(none), probminhash.deduplicate(none), packing.pack(none),
        suffix_dedup.remove_repeats(none), suffix_dedup.remove_from_documents(none),
        url_filter.judge_urls(none.withColumn("url", F.col("text")), [url_filter.Rule("org/", "block")]),
    ):
        assert df.count() == 0


# --- mixing


def filled(sizes: dict) -> dict:
    """Targets by sharing again and again, as the rule says."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    left, total, target = set(order), float(sum(sizes.values())), {}
    while True:
        share = {s: total * weight[s] / sum(weight[x] for x in left) for s in left}
        over = {s for s in left if share[s] > 3 * sizes[s] * (1 + 1e-12)}
        if not over:
            return target | share
        for s in over:
            target[s] = 3.0 * sizes[s]
            total -= target[s]
        left -= over


def words_of(text) -> int:
    return len((text or "").translate(dict.fromkeys(range(9, 14), " ")).split(" ")) - (text or "").translate(
        dict.fromkeys(range(9, 14), " ")
    ).split(" ").count("")


def test_mix(docs):
    narrow = docs.select("doc_id", "source", mixing.count_words(F.col("text")).alias("size"), F.lit("own").alias("p"))
    got = mixing.mix(narrow).collect()
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter((r[0], r[3], words_of(r[1])) for r in rows())
    sizes, taken, largest, target = Counter(), Counter(), Counter(), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        target[r["source"]] = r["target"]
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
    want = filled(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= largest[s]
    again = mixing.mix(narrow.repartition(5)).collect()
    assert Counter(map(str, again)) == Counter(map(str, got))


def test_mix_over_many_blocks(spark):
    rng = random.Random(3)
    data = [(i, f"s{0 if i % 3 else i % 7}", rng.randint(0, 50) if i % 50 else 3000) for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(data, "doc_id long, source string, size long")).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(3000))
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
    for s, t in filled(sizes).items():
        assert abs(taken[s] - t) <= 3000
    shares = defaultdict(list)
    for r in got:
        shares[r["source"]].append(r["copies"])
    for s, t in filled(sizes).items():  # single documents too get what is due on average
        assert np.mean(shares[s]) == pytest.approx(t / sizes[s], abs=0.12)


def test_mix_documents_repeats_rows(docs):
    got = mixing.mix_documents(clashing(docs).drop("source").join(docs.select("doc_id", "source").distinct(), "doc_id"))
    assert set(got.columns) >= {"doc_id", "text", "copies", "kept"}
    assert {r["copies"] for r in got.collect()} == {"own copies"}
    many = Counter((r["doc_id"], r["text"]) for r in mixing.mix_documents(docs).collect())
    had = Counter((r[0], r[1]) for r in rows())
    assert all(n <= 3 * had[k] for k, n in many.items())


# --- quality rules: figures against plain Python


def test_line_quality(docs):
    import re

    word = re.compile(r"[^\x20\x09-\x0D]+")
    got = line_quality.judge_lines(clashing(docs)).collect()
    assert got[0]["host"] == "own host"
    for r in got:
        text = r["text"] or ""
        w = word.findall(text)
        grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in text.split("\n") if word.search(x)]
        assert r["n_words"] == len(w) and r["word_chars"] == sum(map(len, w))
        assert r["n_repeat_words"] == len(covered) and r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["base_failed"] == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
        assert (r["clean_text"] is None) == (r["text"] is None)


@pytest.mark.parametrize(
    ("line", "fails"),
    [
        ("A sentence that ends well.", False), ("He said “so it is.”", False), ("No end of a sentence", True),
        ("Home | News | Sport | More.", True), ("Read more.", True), ("Licensed under the Apache License, Version 2.0.", True),
        ("BUY!! NOW!! CHEAP!!", True), ("of%%% it*** be&&& so.", True), ("R&D grew by 5% in $ terms at the firm, and more of it than that.", False),
    ],
)
def test_line_rules(spark, line, fails):
    good = "This is a plain sentence that is long enough to be kept by all means.\n"
    df = spark.createDataFrame([(good * 1 + line + "\nAnd here is yet another one of them, as plain as it gets.",)], "text string")
    r = line_quality.judge_lines(df).first()
    assert (line not in r["clean_text"]) == fails and r["kept"]


def test_lost_text_rejects(spark):
    df = spark.createDataFrame([("a | b | c | d | e | f | g\n" * 3 + "A good line it is.",), ("many words here without any end " * 3,)], "text string")
    assert [r["kept"] for r in line_quality.judge_lines(df).collect()] == [False, False]


# --- URL filter


URLS = [
    None, "", "no scheme/com/de/", "http://EXAMPLE.org/es/x?y", "https://a.example.org/en/12", "https://a.example.org/en/2",
    "http://notexample.org/es/", "http://com/fr/", "http://x.com/de/?q", "http://x.com/de", "http://x.com#/de/", "http://x.com:80/de/",
    "http://a://b.com/de/", "ftp://org", "ftp://org/", "http://www.example.net/en/1", "//x.com/de/", "http://x.COM/DE/", "http://Ä.com/de/ä",
    "x\ny://z.com/de/", "http://example.org/en/1", "http://example.org.evil.net/en/1",
]


def plain_judge(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
        host, rest = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = rest[: min([i for i in map(rest.find, "?#") if i >= 0], default=len(rest))]
    best = None
    for rule in rules:
        h, _, p = rule.pattern.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            key = (-len(rule.pattern), rule.verdict != "block", rule.pattern)
            best = min(best, (key, rule)) if best else (key, rule)
    return host, path, best and best[1].pattern, best[1].verdict if best else default


@pytest.mark.parametrize("max_inline", [100, 0])
def test_urls(spark, max_inline):
    from runledger.llm.queries import RULES

    rules = [*RULES, url_filter.Rule("example.org/en/1", "allow"), url_filter.Rule("z.com/d", "allow"), url_filter.Rule("b.com/", "block")]
    df = spark.createDataFrame([(i, u, "own") for i, u in enumerate(URLS * 2)], "page_id long, url string, rule string")
    got = url_filter.judge_urls(df, rules, max_inline=max_inline).collect()
    assert len(got) == 2 * len(URLS)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain_judge(r["url"], rules), r


def test_rules_are_checked():
    with pytest.raises(ValueError):
        url_filter.judge_urls(None, [url_filter.Rule("no slash", "block")])


# --- packing


def test_packing_is_whole(docs):
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(packing.default_paths()[0])
    got = packing.pack(clashing(docs)).collect()
    assert sorted(r["sequence_id"] for r in got) == list(range(len(got)))
    assert all(r["offset"] == 0 and r["length"] & (r["length"] - 1) == 0 and r["length"] <= 2048 for r in got)
    want = Counter()
    for d, text, *_ in rows():
        ids, at = [*slow.encode(text or "", add_special_tokens=False).ids, 1], 0
        for n in packing.piece_lengths(len(ids)):
            own = ids[at : at + n]
            want[d, at, n, len(ids), zlib.crc32(np.array(own, "<u4").tobytes()), tuple(own)] += 1
            at += n
    assert want == Counter((r["doc_id"], r["start"], r["length"], r["doc_tokens"], r["ids_crc32"], tuple(r["ids"])) for r in got)
    narrow = packing.pack(docs, keep_ids=False).collect()
    assert {r["sequence_id"]: r["ids_crc32"] for r in narrow}.keys() == {r["sequence_id"] for r in got}


def test_piece_lengths():
    for n in [1, 2, 3, 2047, 2048, 2049, 10_000]:
        pieces = packing.piece_lengths(n)
        assert sum(pieces) == n and all(p <= 2048 and p & (p - 1) == 0 for p in pieces)


def test_both_encoders_agree():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    encoder = packing.Encoder(*packing.default_paths())

    @settings(max_examples=300, deadline=None)
    @given(st.text(st.characters(max_codepoint=0x24F), max_size=60))
    def check(text):
        assert encoder.ids(text).tolist()[:-1] == encoder.slow.encode(text, add_special_tokens=False).ids

    check()


# --- SpotSigs


def test_edits_and_fingerprints(docs):
    got = spotsigs.compare_with_edits(clashing(docs)).collect()
    assert len(got) == docs.count()
    # Rows of one id stand in any order, so look at ids that are alone.
    order = sorted(((r[0] is None, -(r[0] or 0)), r[1] or "") for r in rows())
    texts = [t for _, t in order]
    ids = [None if n else -i for (n, i), _ in order]
    by = {r["doc_id"]: r for r in got}
    for k, d in enumerate(ids):
        following = (k + 1) % len(ids)
        if ids.count(d) > 1 or ids.count(ids[following]) > 1:
            continue
        edit = spotsigs.edited(texts[k], texts[following])
        r = by[d]
        assert r["n_chars"] == len(texts[k]) and len(edit) <= len(texts[k])
        assert r["edited_sha256"] == hashlib.sha256(edit.encode()).hexdigest()
        own, changed, after = spotsigs.signature_sets(pa.array([texts[k], edit, texts[following]]))
        assert r["fingerprint"] == spotsigs.written(own) and r["edited_fingerprint"] == spotsigs.written(changed)
        a, b, c = set(own.tolist()), set(changed.tolist()), set(after.tolist())
        assert r["near_edited"] == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        assert r["near_next"] == pytest.approx(len(a & c) / len(a | c) if a | c else 1.0)
    prints = defaultdict(set)
    for r in spotsigs.fingerprint(docs).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        if r["doc_id"] != 23:
            prints[r["text"]].add(r["fingerprint"])
    assert all(len(v) == 1 for v in prints.values())


def test_blocks_of_ids(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "ROWS_PER_BLOCK", 7)
    data = [(i * i, prose(i, 5 + i)) for i in range(60)]
    got = {r["doc_id"]: r for r in spotsigs.compare_with_edits(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert len(got) == 60
    for i in range(60):
        edit = spotsigs.edited(data[i][1], data[i - 1][1])
        assert got[i * i]["edited_sha256"] == hashlib.sha256(edit.encode()).hexdigest()


# --- language model


def test_grams_and_losses(spark):
    import math

    texts = ["abab", "abc", "", "ABCD abcd"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    chosen = spark.createDataFrame([(1,), (None,), (99,), (1,)], "doc_id long")
    got = {r["doc_id"]: r for r in lm_scoring.score(df, chosen, block_bytes=6).collect()}

    def counts(of):
        c = [Counter() for _ in range(6)]
        for t in of:
            raw = b"\0" * 4 + t.lower().encode()
            for i in range(4, len(raw)):
                for k in range(1, 6):
                    c[k][raw[i - k + 1 : i + 1]] += 1
        return c

    def loss(c, t):
        raw, total = b"\0" * 4 + t.lower().encode(), sum(c[1].values())
        out = 0.0
        for i in range(4, len(raw)):
            p = (c[1][raw[i : i + 1]] + 1) / (total + 256)
            for k in range(2, 6):
                context = sum(n for g, n in c[k].items() if g[:-1] == raw[i - k + 1 : i])
                p = (c[k][raw[i - k + 1 : i + 1]] + lm_scoring.SMOOTHING * p) / (context + lm_scoring.SMOOTHING)
            out -= math.log(p)
        return out / max(1, len(raw) - 4)

    for d, t in enumerate(texts):
        assert got[d]["n_tokens"] == len(t)
        assert got[d]["target_loss"] == pytest.approx(loss(counts(["abc"]), t))
        assert got[d]["background_loss"] == pytest.approx(loss(counts(texts), t))
        assert got[d]["score"] == pytest.approx(got[d]["target_loss"] - got[d]["background_loss"])


def test_chosen_kind_scores_lower(spark, docs):
    import pandas as pd

    ids = docs.where("lang = 'de'").select("doc_id")
    got = lm_scoring.score(clashing(docs), ids)
    assert got.count() == docs.count()
    scores = pd.DataFrame([(r["doc_id"], r["score"]) for r in got.collect()], columns=["d", "s"])
    chosen = scores.d.between(40, 54)
    assert scores[chosen].s.max() < scores[scores.d < 12].s.min()


# --- near-duplicates


def shingle_weights(text):
    import math

    w = (text or "").translate(dict.fromkeys(range(9, 14), " ")).split(" ")
    w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in w if x]
    found = Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)) if w)
    return {k: 1 + math.log2(v) for k, v in found.items()}


def likeness(a, b):
    both = a.keys() & b.keys()
    every = a.keys() | b.keys()
    return sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in every) for i in both)


def test_signatures_estimate_the_probability_jaccard():
    rng = random.Random(5)
    for _ in range(5):
        a = {k: rng.choice([1, 2, 3.5]) for k in range(0, 120)}
        b = {k: rng.choice([1, 2, 3.5]) for k in range(rng.randint(5, 60), 130)}
        sets = [(np.array(sorted(x), np.uint64), np.array([x[k] for k in sorted(x)])) for x in (a, b)]
        exact = likeness(a, b)
        signs = probminhash.signatures(
            np.repeat([0, 1], [len(a), len(b)]), textbytes.mixed(np.concatenate([s[0] for s in sets])),
            np.concatenate([s[1] for s in sets]), 2, 4096,
        )
        assert (signs[0] == signs[1]).mean() == pytest.approx(exact, abs=0.04)


def jaccard(a, b):
    return len(a.keys() & b.keys()) / len(a.keys() | b.keys())


def components_of(n, links):
    label = list(range(n))
    for _ in range(n):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_near_duplicates_against_all_pairs(spark, docs):
    got = probminhash.near_duplicates(clashing(docs)).collect()
    assert len(got) == docs.count()
    texts = sorted({r[1] or "" for r in rows()})
    sets = [shingle_weights(t) for t in texts]
    links = [
        (i, j) for i in range(len(texts)) for j in range(i) if sets[i] and sets[j] and jaccard(sets[i], sets[j]) >= 0.8
    ]
    assert links
    label = dict(zip(texts, components_of(len(texts), links), strict=True))
    least = {}
    for r in sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0)):
        least.setdefault(label[r[1] or ""], r[0])
    want = Counter((r[0], least[label[r[1] or ""]]) for r in rows())
    assert want == Counter((r["doc_id"], r["class_id"]) for r in got)
    assert sum(r["kept"] for r in got) == len(least)
    kept = probminhash.deduplicate(clashing(docs)).collect()
    assert Counter(r["doc_id"] for r in kept) == Counter(r["doc_id"] for r in got if r["kept"])
    assert kept[0]["node"] == "own node"


def test_links_between_sets():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 12, 9)) for _ in range(60)]
    links = [
        (i, j) for i in range(60) for j in range(i) if 5 * len(set(sets[i]) & set(sets[j])) >= 4 * len(set(sets[i]) | set(sets[j]))
    ]
    assert buckets.links_between(sets, 0.8).tolist() == components_of(60, links)


@pytest.mark.parametrize("group", [256, 20])
def test_large_group_of_near_copies(spark, monkeypatch, group):
    monkeypatch.setattr(buckets, "GROUP", group)
    base = prose(1, 400).split()
    data = [(0, " ".join(base))]
    for i in range(1, 150):  # each like the base, few like each other
        w = list(base)
        for k in range(7):
            w[(i * 13 + k * 50) % 400] = f"changed{i}-{k}"
        data.append((i, " ".join(w)))
    data += [(1000 + i, prose(500 + i, 100)) for i in range(50)]
    got = probminhash.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert Counter(r["class_id"] for r in got)[0] == 150 and sum(r["kept"] for r in got) == 51


@pytest.mark.parametrize("buckets_of", [1, 3])
def test_large_buckets_lose_no_link(spark, monkeypatch, buckets_of):
    """Chains through a bucket that is far larger than a group, with few hubs, against all pairs."""
    monkeypatch.setattr(buckets, "GROUP", 6)
    monkeypatch.setattr(buckets, "HUBS", 1)
    rng = random.Random(8)
    sets = []
    for family in range(40):
        own = [f"{family * 1000 + k}" for k in range(rng.choice([10, 11, 40, 60]))]
        for step in range(rng.choice([1, 2, 6])):  # each like the one before, the last not like the first
            sets.append(own[step:] + [f"{family * 1000 + 500 + k}" for k in range(step)])
    rng.shuffle(sets)
    links = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if 5 * len({*a} & {*b}) >= 4 * len({*a} | {*b})]
    want = components_of(len(sets), links)
    assert 40 <= len(set(want)) < len(sets)

    def sets_of(texts):
        for t in texts.to_pylist():
            yield np.array(sorted(map(int, t.split())), np.uint64)

    rows = [(i, key, len(s)) for i, s in enumerate(sets) for key in range(buckets_of)]
    texts = spark.createDataFrame([(i, " ".join(s)) for i, s in enumerate(sets)], "node long, text string")
    got = buckets.classes(spark.createDataFrame(rows, "node long, key long, size long"), texts, sets_of, 0.8).collect()
    label = {r["node"]: r["label"] for r in got}
    assert [label.get(i, i) for i in range(len(sets))] == want


def test_classes_of_signature_sets(spark, docs):
    got = spotsigs.near_classes(clashing(docs)).collect()
    texts = sorted({r[1] or "" for r in rows()})
    sets = [set(s.tolist()) for s in spotsigs.signature_sets(pa.array(texts))]
    links = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if a and 5 * len(a & b) >= 4 * len(a | b)]
    assert links
    label = dict(zip(texts, components_of(len(texts), links), strict=True))
    least = {}
    for r in sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0)):
        least.setdefault(label[r[1] or ""], r[0])
    assert Counter((r[0], least[label[r[1] or ""]]) for r in rows()) == Counter((r["doc_id"], r["class_id"]) for r in got)


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)] + [(7, 7)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    label = components_of(500, links)
    ends = {x for link in links if link[0] != link[1] for x in link}
    assert got == {n: label[n] for n in ends}


# --- repeated passages


def plain_removal(texts: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = True
        out.append(suffix_dedup._spans(gone).tolist())
    return out


def check_removal(spark, data):
    df = spark.createDataFrame(data, DOCS).repartition(3)
    got = suffix_dedup.remove_repeats(clashing(df)).collect()
    raw = [(r[1] or "").encode() for r in data]
    want = Counter()
    for r, t, gone in zip(data, raw, plain_removal(raw, suffix_dedup.LENGTH), strict=True):
        kept, at = b"", 0
        for low, high in gone:
            kept, at = kept + t[at:low], high
        kept += t[at:]
        want[r[0], len(t), len(t) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept] += 1
    assert want == Counter(
        (r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], bytes(r["kept"])) for r in got
    )
    assert got[0]["host"] == "own host"


def test_removal_against_all_strings(spark):
    check_removal(spark, rows())


def test_removal_in_small_parts(spark, monkeypatch):
    """Many parts of a bucket, long texts in slices, and passages that start and end anywhere."""
    monkeypatch.setattr(suffix_dedup, "RUNS_AT_ONCE", 2)
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 1500)
    monkeypatch.setattr(suffix_dedup, "SORT_BYTES", 4000)
    rng = random.Random(4)
    source = prose(31, 900)
    data = []
    for i in range(40):
        low = rng.randrange(len(source) - 1200)
        data.append((i, prose(1000 + i, 30) + source[low : low + rng.randint(380, 1200)] + prose(2000 + i, 20), "en", "s", 1))
    data.append((99, "ab" * 2000 + prose(5, 100) + "ab" * 700, "en", "s", 1))
    check_removal(spark, data)


def test_suffix_order_and_cover():
    for period in (3, 7, 32):
        cover = set(suffix_dedup.difference_cover(period))
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    rng = np.random.default_rng(1)
    text = np.concatenate((rng.integers(97, 99, 700), np.tile(rng.integers(97, 99, 90), 9), np.zeros(1200))).astype(np.uint8)
    starts = np.arange(1500)
    order, _ = suffix_dedup.sort_suffixes(text, starts, np.zeros(len(starts), np.uint64), 400)
    raw = text.tobytes()
    keys = [raw[i : i + 400] for i in order]
    assert keys == sorted(keys)


def test_texts_after_removal(spark, docs):
    got = suffix_dedup.remove_from_documents(clashing(docs))
    assert got.columns == clashing(docs).columns
    rows_ = got.collect()
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in rows_)
    assert [r["text"] for r in rows_ if r["doc_id"] == 20] == [None]
    assert all(r["text"] == "" for r in rows_ if 30 <= (r["doc_id"] or 0) < 36)
