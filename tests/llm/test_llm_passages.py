"""Passages of over 50 words, however few bytes they have, against all windows of words."""

import random
import re
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest

from runledger.llm import passages, suffix_dedup
from test_llm_cases import DOCS, clashing, plain_removal, prose, rows

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def short_words(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(4, 6))) for _ in range(n)]


def window_removal(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Flags of the bytes in windows of ``n`` words that are found again."""
    found = [[m.span() for m in WORD.finditer(t)] for t in texts]
    windows = [[tuple(t[a:b] for a, b in w[i : i + n]) for i in range(len(w) - n + 1)] for t, w in zip(texts, found, strict=True)]
    count = Counter(x for own in windows for x in own)
    out = []
    for t, w, own in zip(texts, found, windows, strict=True):
        gone = np.zeros(len(t), bool)
        for i, x in enumerate(own):
            if count[x] > 1:
                gone[w[i][0] : w[i + n - 1][1]] = True
        out.append(gone)
    return out


def check(spark, data):
    df = clashing(spark.createDataFrame(data, DOCS).repartition(3))
    got = dict(corpus_pipeline.STAGES)["repeated passages"](spark, df, "")
    raw = [(r[1] or "").encode() for r in data]
    want = Counter()
    for r, t, by_words, by_bytes in zip(data, raw, window_removal(raw, 51), plain_removal(raw, 400), strict=True):
        for low, high in by_bytes:
            by_words[low:high] = True
        left = np.frombuffer(t, np.uint8)[~by_words].tobytes().decode("utf-8", "ignore")
        want[r[0], None if r[1] is None else left] += 1
    assert got.columns == df.columns
    assert want == Counter((r["doc_id"], r["text"]) for r in got.collect())


def test_stage_removes_51_words_of_300_bytes(spark):
    passage = " ".join(short_words(1, 51))
    assert 290 <= len(passage) <= 320
    fifty = " ".join(short_words(2, 50))
    data = [(i, f"{prose(i, 30)} {passage} {prose(10 + i, 30)} {fifty} {prose(20 + i, 9)}", "en", "s", 1) for i in range(3)]
    df = spark.createDataFrame(data, DOCS)
    got = [r["text"] for r in dict(corpus_pipeline.STAGES)["repeated passages"](spark, df, "").collect()]
    assert len(got) == 3 and all(fifty in t and passage not in t and passage.split()[25] not in t.split() for t in got)
    check(spark, data)


def test_stage_against_all_windows(spark):
    rng = random.Random(6)
    source = short_words(3, 500)
    data = rows()
    for i in range(60):  # passages that start and end anywhere, with any space between their words
        low, n = rng.randrange(400), rng.randint(40, 100)
        own = rng.choice([" ", "\n", " \t "]).join(source[low : low + n])
        data.append((200 + i, prose(3000 + i, 20) + " " + own + " " + prose(4000 + i, 20), "en", "s", 1))
    data.append((300, " ".join(["ja"] * 300 + short_words(4, 60) * 2 + ["no"] * 51), "en", "s", 1))
    data.append((301, "\n" + " ".join(["z"] * 51) + "\t", "en", "s", 1))
    data.append((302, "\n".join(["z"] * 51), "en", "s", 1))
    check(spark, data)


@pytest.mark.parametrize("n", [2, 9, 51])
def test_slices_hold_every_window(monkeypatch, n):
    rng = random.Random(n)
    text = "".join(rng.choice(["a", "bb ", " ", "\n", "longer" * rng.randint(1, 99)]) for _ in range(3000)).encode()
    data = np.frombuffer(text, np.uint8)
    words = [m.span() for m in WORD.finditer(text)]
    want = {(words[i][0], words[i + n - 1][1]) for i in range(len(words) - n + 1)}
    for chunk, most in ((700, 1 << 20), (7, 1 << 20), (5000, 60), (1 << 20, 60)):
        monkeypatch.setattr(passages, "CHUNK_BYTES", chunk)
        monkeypatch.setattr(passages, "MOST_WORDS", most)
        got = []
        for low, part, _ in passages.pieces(data, np.array([0, len(data)]), n):
            own = [m.span() for m in WORD.finditer(part.tobytes())]
            got += [(low + own[i][0], low + own[i + n - 1][1]) for i in range(len(own) - n + 1)]
        assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize(("length", "gram"), [(100, 32), (401, 399)])
def test_length_is_a_parameter(spark, length, gram):
    data = rows()
    raw = [(r[1] or "").encode() for r in data]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(data, DOCS), kept="", length=length, gram=gram).collect()
    want = Counter((r[0], len(t), sum(b - a for a, b in gone), len(gone)) for r, t, gone in zip(data, raw, plain_removal(raw, length), strict=True))
    assert want == Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"]) for r in got)


def test_lengths_are_checked(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(df, length=100)
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(df, over_words=0)
    assert suffix_dedup.remove_repeats(df.where("false"), over_words=50).count() == 0


def test_passages_are_reported_beside_the_bytes(spark):
    """The contract's figures stay those of 400-byte strings; passages of 51 words count however short their words."""
    passage = " ".join(short_words(1, 51))
    data = rows() + [(400 + i, f"{prose(i, 30)} {passage} {prose(10 + i, 30)}", "en", "s", 1) for i in range(3)]
    df = clashing(spark.createDataFrame(data, DOCS).repartition(3))
    got = suffix_dedup.remove_repeats(df, kept="", report_words=50).collect()
    raw = [(r[1] or "").encode() for r in data]
    want = Counter()
    for r, t, flags, gone in zip(data, raw, window_removal(raw, 51), plain_removal(raw, 400), strict=True):
        runs = int((np.diff(np.concatenate(([0], flags.astype(np.int8)))) == 1).sum())
        want[r[0], len(t), sum(b - a for a, b in gone), len(gone), int(flags.sum()), runs] += 1
    assert want == Counter(tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "n_passage_bytes", "n_passages")) for r in got)
    assert all(r["n_passage_bytes"] >= len(passage) for r in got if r["doc_id"] is not None and r["doc_id"] >= 400)
