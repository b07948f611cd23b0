"""Exact top k by candidates and hash buckets, against counting every value."""

import pytest
from pyspark.sql import functions as F

from pawnshop.operators import profile as pr


def rows_of(spark, counts: dict):
    data = spark.createDataFrame(list(counts.items()), "c string, n int")
    return data.select("c", F.explode(F.sequence(F.lit(1), "n")).alias("x")).repartition(5, "x")


CASES = {
    "skewed": {f"v{i}": 400 // (i + 1) + 1 for i in range(150)},
    "all equal": {f"v{i:03}": 3 for i in range(200)},
    "near ties": {f"v{i:03}": 20 + (i % 2) for i in range(120)},
    "null is a value": {None: 50, "": 49, "a": 50, "b": 1},
    "fewer than k": {"a": 2, "b": 1},
    "one hot value": {"hot": 900, **{f"v{i}": 1 for i in range(300)}},
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("tracked,buckets", [(4096, 4096), (8, 3)])
def test_equals_counting_every_value(spark, name, tracked, buckets):
    df = rows_of(spark, CASES[name])
    got = [tuple(r) for r in pr.heavy_hitters(df, "c", 5, tracked, buckets).collect()]
    want = sorted(CASES[name].items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))[:5]
    assert got == want


def test_empty_table_and_only_nulls(spark):
    df = rows_of(spark, {"a": 1})
    assert pr.heavy_hitters(df.where("x < 0"), "c", 5).collect() == []
    assert [tuple(r) for r in pr.heavy_hitters(df.withColumn("c", F.lit(None).cast("string")), "c", 5).collect()] == [(None, 1)]
