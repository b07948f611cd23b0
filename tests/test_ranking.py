"""Ranks, hash streams, alignment and movetext on inputs the test tables don't hold."""

import random
import time

import pytest
from pyspark.sql import functions as F

from pawnshop import sources as S
from pawnshop.operators import evaluate as ev, learn, moves as M, sampling as sa
from pawnshop.operators.ranking import exact_quantiles, row_position, running_total
from pawnshop.session import checkpoint_dir


def positions(df, order, **kw):
    return [(r["id"], r["pos"]) for r in sorted(row_position(df, order, **kw).collect(), key=lambda r: r["pos"])]


def test_nulls_come_first_as_spark_sorts_them(spark):
    df = spark.createDataFrame([("n", None), ("a", 1.0), ("b", 2.0), ("c", 3.0), ("z", float("nan"))], "id string, v double")
    assert positions(df, ["v"]) == [("n", 0), ("a", 1), ("b", 2), ("c", 3), ("z", 4)]


@pytest.mark.parametrize("kind", ["text", "date", "decimal"])
def test_any_type_can_be_ranked(spark, kind):
    rng = random.Random(1)
    names = sorted({"".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 12))) for _ in range(400)}, key=lambda s: s.encode())
    rows = [(x, k) for k, x in enumerate(names)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id string, k int")
    col = {"text": F.col("id"), "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("k")), "decimal": F.col("k").cast("decimal(20,3)") - 200}[kind]
    got = positions(df.withColumn("v", col), ["v"])
    assert [x for x, _ in got] == names and [p for _, p in got] == list(range(len(names)))


def test_one_value_shared_by_most_rows_is_spread(spark):
    rows = [(k, 5.0 if k % 10 else float(k)) for k in range(2000)]
    df = spark.createDataFrame(rows, "id long, v double")
    assert positions(df, ["v", "id"]) == [(i, p) for p, (_, i) in enumerate(sorted((v, k) for k, v in rows))]
    run = running_total(df.withColumn("w", F.lit(2)), ["v", "id"], ["w"], buckets=64)
    assert {r["id"]: r["cum_w"] for r in run.collect()} == {i: 2 * p + 2 for p, (_, i) in enumerate(sorted((v, k) for k, v in rows))}


def test_groups_with_a_null_key_are_ranked(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, None, 1.0), (3, "g", 1.0)], "id long, g string, v double")
    assert {r["id"]: (r["pos"], r["pos_n"]) for r in row_position(df, ["v"], ["g"]).collect()} == {1: (1, 2), 2: (0, 2), 3: (0, 1)}


def test_quantiles_of_skewed_values(spark):
    values = [0.0] * 500 + [float(k) for k in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = exact_quantiles(df, "v", [0.0, 0.25, 0.75, 1.0]).first()
    import numpy as np
    assert list(row) == pytest.approx(np.quantile(values, [0, 0.25, 0.75, 1]).tolist())


def test_shuffle_builds_quickly_at_many_partitions(spark):
    df = spark.range(1000).select(F.col("id").alias("k"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2048")
    try:
        start = time.time()
        sa.hash_shuffle(df, "k")._jdf.queryExecution().executedPlan()
        assert time.time() - start < 5
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_sample_balance_and_split_are_independent(spark):
    df = spark.range(20000).select(F.col("id").alias("k"), (F.col("id") % 5 == 0).cast("int").alias("label"))
    parts = lambda d: {(r["split"], r["label"]): r["n"] for r in d.groupBy("split", "label").agg(F.count("*").alias("n")).collect()}
    sampled = parts(sa.hash_split(sa.hash_sample(df, "k", 0.1), "k"))
    assert 300 < sampled["test", 0] + sampled["test", 1] < 500
    balanced = parts(sa.hash_split(sa.balance_classes(df, "label", "k"), "k"))
    assert all(600 < balanced["test", y] < 1000 and 2900 < balanced["train", y] < 3500 for y in (0, 1))
    exact = parts(sa.stratified_split(sa.balance_classes(df, "label", "k"), "label", "k"))
    assert all(exact[s, y] > 500 for s in ("test", "validation", "train") for y in (0, 1))


def test_auc_counts_ties_half(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, 0.4), (0, 0.4)], "label int, s double")
    assert ev.roc_auc(df, "label", "s").first()["auc"] == pytest.approx(0.875)


def test_a_constant_column_is_standardised_to_zero(spark):
    df = spark.createDataFrame([(1, 2.0, 1.0), (2, 2.0, 3.0), (3, None, 5.0)], "id int, c double, v double")
    got = {r["id"]: (r["z_c"], r["z_v"]) for r in learn.standardize(df, ["c", "v"], keep=["id"]).collect()}
    assert got == {1: (0.0, -1.0), 2: (0.0, 0.0), 3: (None, 1.0)}


def test_unknown_tokens_are_passed_over_and_texts_stay_apart(spark):
    long = " ".join(f"{k + 1}. Nf3 Nf6" if k % 2 else f"{k + 1}. Ng1 Ng8" for k in range(45))
    rows = [(1, "1. e4 d5 2. exd5 e.p. Qxd5 *"), (1, "1. d4 *"), (None, "1. e4 e5 *"), (None, "1. c4 *"), (2, long + " 1-0 60. a4"), (3, None), (4, " ")]
    games = spark.createDataFrame(rows, "game_id long, movetext string")
    moves = sorted(((r["game_id"] or 0, r["ply"], r["san"]) for r in M.movetext_tokens(games, "game_id", "movetext").collect() if r["game_id"] != 2))
    assert moves == sorted([(1, 1, "e4"), (1, 2, "d5"), (1, 3, "exd5"), (1, 4, "Qxd5"), (1, 1, "d4"), (0, 1, "e4"), (0, 2, "e5"), (0, 1, "c4")])
    total = sorted(((r["game_id"] or 0, r["total_moves"]) for r in M.total_moves(games, "game_id", "movetext").collect()), key=str)
    assert total == sorted([(1, 2), (1, 1), (0, 1), (0, 1), (2, 45), (3, None), (4, None)], key=str)


def test_alignment_keeps_what_has_no_partner(spark, tmp_path):
    for name, n in (("a", 7), ("b", 5)):
        spark.range(n).selectExpr(f"concat('{name}', id) as x").coalesce(1).write.csv(f"{tmp_path}/{name}")
    left, right = (S.with_source(spark.read.csv(f"{tmp_path}/{n}").toDF(n)) for n in "ab")
    got = {r["ordinal"]: (r["a"], r["b"]) for r in S.align_by_ordinal(left, right).collect()}
    assert got == {k: (f"a{k}", f"b{k}" if k < 5 else None) for k in range(7)}
    report = S.alignment_report(S.with_ordinal(left), S.with_ordinal(right), "ordinal").first()
    assert tuple(report) == (5, 2, 0)


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
