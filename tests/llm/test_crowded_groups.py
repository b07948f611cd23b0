"""Large groups of texts that are alike but not linked."""

import random

import numpy as np

from pawnshop.llm import near_dedup, text as tx


def _variants(n, words=400, changed=11, seed=5):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(words)]
    out = []
    for k in range(n):
        own = list(base)
        for at in rnd.sample(range(words), changed):
            own[at] = f"v{k}x{at}"
        out.append(" ".join(own))
    # the last ones are linked: one changed word more than the text before
    return out + [t + " end" for t in out[-3:]]


def _sequence(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return near_dedup.distinct_in_order(tx.shingles(*tx.words(data, np.array([0, len(data)])), near_dedup.WORDS)[0])


def _classes(sequences):
    root = list(range(len(sequences)))
    for a in range(len(sequences)):
        for b in range(a):
            if near_dedup.similarity(sequences[a], sequences[b]) >= near_dedup.SIMILARITY and root[a] != root[b]:
                lo, hi = sorted((root[a], root[b]))
                root = [lo if r == hi else r for r in root]
    return dict(enumerate(root))


def test_alike_texts_that_are_not_linked_are_not_aligned(spark, monkeypatch):
    texts = _variants(60)
    sequences = [_sequence(t) for t in texts]
    want = _classes(sequences)
    assert 50 < len(set(want.values())) < len(texts)
    counts, remaining = [], near_dedup._remaining
    monkeypatch.setattr(near_dedup, "_remaining", lambda *a: counts.append(remaining(*a)) or counts[-1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert dict(map(tuple, near_dedup.near_duplicates(docs).collect())) == want
    assert counts[0].count() < 200  # of 1953 pairs


def test_marks_differ_in_no_more_bits_than_sets_in_shingles():
    rnd = np.random.default_rng(3)
    for n in (1, 5, 300, 5000):
        a = rnd.integers(0, 2**63, n).astype(np.uint64)
        b = np.concatenate([a[: n - n // 4], rnd.integers(0, 2**63, n // 3).astype(np.uint64)])
        x, y = near_dedup.marks([a, b]).view(np.uint64)
        assert sum(int(v).bit_count() for v in x ^ y) <= len(np.setxor1d(a, b))
    assert (near_dedup.marks([a])[0] == near_dedup.marks([a[::-1]])[0]).all()
