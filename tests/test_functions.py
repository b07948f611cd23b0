"""Column functions on the edge rows of FIXTURES.md section 1 and 2."""

from pyspark.sql import functions as F

from pawnshop.functions import binary_label, outcome_flag, safe_cast, text_quality, hash_unit


def test_labels_and_flags(spark):
    rows = [(" WHITE ",), ("White\t",), ("Black",), ("draw\n",), ("abandoned",), (None,), ("Winner",)]
    df = spark.createDataFrame(rows, "w string")
    got = df.select(binary_label("w").alias("l"), outcome_flag("w", "White").alias("f")).collect()
    assert [r.l for r in got] == [1, 1, 0, 0, None, None, None]
    # flags are case-sensitive and exact: only the literal 'White' counts
    assert [r.f for r in got] == [0, 0, 0, 0, 0, 0, 0]
    assert df.select(outcome_flag(F.lit("White"), "White")).first()[0] == 1


def test_safe_cast(spark):
    df = spark.createDataFrame([("42",), ("x",), (None,), (" 7",)], "n string")
    assert [r[0] for r in df.select(safe_cast("n", "int")).collect()] == [42, None, None, 7]


def test_text_quality(spark):
    texts = [None, "", "FEN", '[Event "x"] 1. e4', "   1. e4 e5", "1. d4 *", "12. Nf3"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(text_quality("t")).collect()] == [False, False, False, False, True, True, False]


def test_hash_unit_is_stable_and_uniform(spark):
    df = spark.range(20000)
    u = df.select(hash_unit("id", 42).alias("u"))
    stats = u.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0.0 <= stats[0] and stats[1] < 1.0 and abs(stats[2] - 0.5) < 0.02
    assert spark.range(7, 8).select(hash_unit("id", 42)).first()[0] == 1560222700 / 2 ** 32
