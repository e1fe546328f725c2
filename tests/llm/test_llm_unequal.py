"""Near-duplicates whose shingles are repeated unequally, against all pairs."""

import random
from collections import Counter

from runledger.llm import buckets, probminhash
from test_llm_cases import components_of, jaccard, likeness, shingle_weights


def test_unequal_repeats_against_all_pairs(spark):
    data = []
    for pair in range(60):
        rng = random.Random(pair)
        own = [f"w{pair}x{k}" for k in range(204)]
        if pair % 3 == 0:  # more shingles, found many times
            more = [f"m{pair}x{k}" for k in range(rng.randint(20, 30))]
            other = own + more * rng.choice([8, 16])
        elif pair % 3 == 1:  # nearly the same shingles, a part of them found many times
            other = own + own[20:100] * 16
        else:  # both repeat, but not the same part
            other = own + own[100:160] * 16
            own = own + own[20:80] * 16
        data += [(2 * pair, " ".join(own)), (2 * pair + 1, " ".join(other))]
    sets = [shingle_weights(t) for _, t in data]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if jaccard(sets[i], sets[j]) >= 0.8]
    assert len(links) == 60 and min(likeness(sets[i], sets[j]) for i, j in links) < 0.6
    label = components_of(len(data), links)
    got = probminhash.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == Counter(enumerate(label))


def test_likely_keeps_all_that_are_there(spark):
    """Numbers at the edges of words and of the sign; nothing else passes while the table is sparse, no column is added."""
    nodes = [0, 63, 64, -1, -64, 2**63 - 1, -(2**63), buckets.CELLS, 12345]
    texts = spark.createDataFrame([(n, "t") for n in nodes] + [(777, "t"), (999, "t")], "node long, text string")
    got = buckets.likely(texts, spark.createDataFrame([(n,) for n in nodes * 2], "node long"))
    assert sorted(r["node"] for r in got.collect()) == sorted(nodes) and got.columns == texts.columns
    assert buckets.likely(texts, texts.where("false")).count() == 0
