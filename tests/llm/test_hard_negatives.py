"""Hard negatives against scores of all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from pawnshop.llm import catalog, hard_negatives as hard

SF = "/root/testdata/sf0.01"
SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType()),
                       T.StructField("row", T.StringType()), T.StructField("block", T.StringType())])


def brute(rows, is_anchor, positives=5, negatives=10):
    """rows: (id, vector, label); every row counts for itself."""
    use = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
           if None not in (i, v, label) and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, v, label) in enumerate(use):
        if not is_anchor(i):
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), j, m == label) for b, (j, w, m) in enumerate(use) if b != a and len(w) == len(v)]
        for s, p, _ in sorted(x for x in scored if x[2])[:positives]:
            ok = sorted(x for x in scored if not x[2] and 30 * -s <= 100 * -x[0] <= 90 * -s)[:negatives]
            out += [(i, p, r + 1, n, -s, -t) for r, (t, n, _) in enumerate(ok)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert got(catalog.op11_threshold_negatives(spark, SF)) == brute(rows, lambda i: i % 100 == 0)


@pytest.mark.parametrize("block", [7, 100, 4096])
def test_ties_and_blocks_of_any_size(spark, monkeypatch, block):
    monkeypatch.setattr(hard, "BLOCK", block)
    monkeypatch.setattr(hard, "CHUNK", 3)
    monkeypatch.setattr(hard, "FIRST_STEP", 1)
    rng = random.Random(block)
    # few distinct vectors: scores tie all over
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(3)], rng.randrange(3)) for i in range(300)]
    rows += [(1000 + i, [1.0, 1.0, 0.25], i % 2) for i in range(200)] + [(20, [0.0, 0.0, 0.0], 1), (40, [-1.0, -1.0, -1.0], 2)]
    rng.shuffle(rows)
    assert got(hard.mine(frame(spark, rows), F.col("id") % 20 == 0)) == brute(rows, lambda i: i % 20 == 0)


def test_reading_stops_at_the_threshold():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(2000, 4)) ** 3 * 100
    x = np.floor(x).astype(np.int64)
    lists = hard.Lists(x, np.argsort(x, axis=0, kind="stable").T.astype(np.int32), np.arange(2000), np.zeros(2000, np.int64), np.arange(2000))
    everything = np.ones(2000, bool)
    for a in x[:50]:
        (places, scores), = lists.search(a, everything, np.array([hard._WHOLE]), 5)[0]
        want = np.lexsort((np.arange(2000), -(x @ a)))[:5]
        assert places.tolist() == want.tolist() and scores.tolist() == (x @ a)[want].tolist()
    read = [lists.search(a, everything, np.array([hard._WHOLE]), 5)[1] for a in x[:50]]
    assert np.mean(read) < 1000


def test_awkward_vectors(spark):
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (None, [1.0, 1.0], 1), (1, None, 1), (2, [], 1), (3, [1.0, None], 1), (4, [float("nan"), 1.0], 1),
            (5, [float("inf"), 1.0], 2), (6, [1.0, 0.5], None), (7, [1.0, 2.0, 3.0], 2), (8, [0.6, 0.3], 2), (9, [0.5, 0.5], 2), (10, [0.9, 0.9], 1),
            (11, [0.5, 0.5], 3), (20, [-1e6, 1e6], 3)]
    result = hard.mine(frame(spark, rows), F.col("id") % 10 == 0)
    assert got(result) == brute([r for r in rows if r[0] != 7], lambda i: i % 10 == 0)
    assert hard.mine(frame(spark, []), F.col("id") % 10 == 0).columns == result.columns
    assert hard.mine(frame(spark, []), F.col("id") % 10 == 0).count() == 0
    with pytest.raises(Exception, match="64 bits"):
        hard.mine(frame(spark, [(0, [1e14, 0.0], 1), (1, [1e14, 0.0], 1)]), F.col("id") == 0).collect()


def test_no_table_goes_through_the_driver(spark, monkeypatch):
    plans = []
    settled = hard.settled
    monkeypatch.setattr(hard, "settled", lambda df, *a, **b: (plans.append(df), settled(df, *a, **b))[1])
    monkeypatch.setattr(hard, "BLOCK", 16)  # a chunk visits many blocks
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)], i % 3) for i in range(400)]
    result = hard.mine(frame(spark, rows), F.col("id") % 20 == 0)
    assert got(result) == brute(rows, lambda i: i % 20 == 0)
    for df in (*plans, result):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
