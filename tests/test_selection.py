"""Ranks and cuts found by counting alone."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pawnshop.functions.scalar import hash_unit
from pawnshop.operators import profile as pr, sampling as sa
from pawnshop.operators.selection import order_statistics, selected_quantiles


def test_every_rank_of_awkward_values(spark):
    rng = random.Random(5)
    values = [-math.inf, math.inf, math.nan, math.nan, 0.0, 5e-324, 1e308, -1.7e308, *[7.5] * 300, *[rng.gauss(0, 10.0 ** rng.randrange(-9, 9)) for _ in range(300)]]
    rng.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(5)
    ranks = [0, 1, 2, 50, 200, 299, 300, 450, len(values) - 4, len(values) - 3, len(values) - 1]
    [(group, n, at)] = order_statistics(df, "v", lambda n: ranks)
    want = np.sort(values)  # NaN last, as Spark sorts
    assert (group, n) == ({}, len(values))
    for r in ranks:
        got, below = at[r]
        assert got == want[r] or math.isnan(got) and math.isnan(want[r])
        assert below == sum(v < got for v in values) if not math.isnan(got) else below == len(values) - 2


def test_quantiles_of_groups_and_of_nothing(spark):
    rng = np.random.default_rng(2)
    rows = [(g, int(v)) for g, n in (("a", 1000), ("b", 3), (None, 50)) for v in rng.integers(-40, 40, n)]
    df = spark.createDataFrame([*rows, ("c", None)], "g string, v int")
    got = {r["g"]: [r["q0"], r["q1"], r["q2"]] for r in selected_quantiles(df, "v", [0.1, 0.5, 1.0], ["g"])}
    assert set(got) == {"a", "b", None}
    for g in got:
        assert got[g] == pytest.approx(np.quantile([v for h, v in rows if h == g], [0.1, 0.5, 1.0]).tolist())
    assert selected_quantiles(df.where("g = 'c'"), "v", [0.5]) == [] == selected_quantiles(df.limit(0), "v", [0.5], ["g"])


def split_of(rows, test=0.2, validation=0.25):
    """Brute force over (label, hash, key)."""
    out = {}
    for y in {r[0] for r in rows}:
        own = sorted(r[1:] for r in rows if r[0] == y)
        a = math.ceil(len(own) * test)
        b = a + math.ceil((len(own) - a) * validation)
        out.update({(y, k): "test" if p < a else "validation" if p < b else "train" for p, (_, k) in enumerate(own)})
    return out


def test_split_equals_brute_force(spark):
    df = spark.range(997).select(F.col("id").alias("k"), (F.col("id") % 7 == 0).cast("int").alias("label"))
    df = df.unionByName(spark.createDataFrame([(5000, None), (None, 1), (6000, 9)], "k long, label int"))
    rows = [tuple(r) for r in df.where("label is not null and k is not null").select("label", hash_unit("k", 42, "split"), "k").collect()]
    got = {(r["label"], r["k"]): r["split"] for r in sa.stratified_split(df, "label", "k").collect()}
    assert got == split_of(rows)
    assert sa.stratified_split(df.limit(0), "label", "k").count() == 0


def test_split_decides_by_key_where_hashes_are_equal(spark, monkeypatch):
    monkeypatch.setattr(sa, "hash_unit", lambda key, seed, purpose: (F.col(key) % 3) / F.lit(4.0))
    df = spark.range(100).select(F.col("id").alias("k"), F.lit("y").alias("label"))
    rows = [("y", k % 3 / 4, k) for k in range(100)]
    assert {(r["label"], r["k"]): r["split"] for r in sa.stratified_split(df, "label", "k").collect()} == split_of(rows)


def test_rows_that_repeat_a_key_stay_together(spark):
    df = spark.range(300).select(F.when(F.col("id") < 100, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.lit(1).alias("label"))
    got = sa.stratified_split(df, "label", "k")
    assert got.count() == 300 and got.where("k = -1").select("split").distinct().count() == 1


def test_no_row_is_shuffled(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 2).cast("int").alias("label"), F.col("id").cast("double").alias("v"))
    for out in (sa.stratified_split(df, "label", "k"), pr.quantile_bins(df, "v", list("abcd"))):
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert [r["count"] for r in pr.quantile_bins(df, "v", list("abcd"), "b").groupBy("b").count().orderBy("b").collect()] == [250] * 4
