"""Properties of the profile, sampling and evaluation operators."""

import math

import pytest
from pyspark.sql import functions as F

from pawnshop.operators import evaluate as ev, profile as pr, sampling as sa
from pawnshop.operators.ranking import exact_quantiles, row_position
from pawnshop.plans import adapters as ad

from conftest import SF001


@pytest.fixture(scope="module")
def games(spark):
    return ad.games(spark, SF001).cache()


def test_entropy_bounds(games):
    prof = pr.entity_profile(games, "WhiteName", "WhiteElo", "Opening", "Winner").collect()
    pairs = pr.pair_frequency(games, "WhiteName", "WhiteElo", "Opening").groupBy("Player").count().collect()
    k = {r.Player: r["count"] for r in pairs}
    for r in prof:
        assert -1e-9 <= r.ShannonEntropy <= math.log2(k[r.Player]) + 1e-9


def test_entropy_matches_textbook_form(games):
    rel = pr.relative_frequency(games, "WhiteName", "WhiteElo", "Opening")
    textbook = {r.Player: r.h for r in rel.groupBy("Player").agg(
        F.sum(-F.col("freq_rel") * F.log2("freq_rel")).alias("h")).collect()}
    for r in pr.shannon_entropy(games, "WhiteName", "WhiteElo", "Opening").collect():
        assert r.ShannonEntropy == pytest.approx(textbook[r.Player], abs=1e-9)


def test_shares_sum_to_one(games):
    rel = pr.relative_frequency(games, "WhiteName", "WhiteElo", "Opening")
    for r in rel.groupBy("Player").agg(F.sum("freq_rel").alias("s")).collect():
        assert r.s == pytest.approx(1.0)


def test_outcome_shares_sum_to_one(games):
    for r in pr.group_outcome_profile(games, "TimeControl", "Winner", "Number_of_Moves").collect():
        assert r.prop_white_win + r.prop_black_win + r.prop_draw == pytest.approx(1.0)


def test_splits_disjoint_and_complete(games):
    lab = games.select("game_id", F.when(F.col("Winner") == "White", 1).otherwise(0).alias("label"))
    s = sa.stratified_split(lab, "label", "game_id").collect()
    assert len(s) == lab.count() and len({r.game_id for r in s}) == len(s)
    for y in (0, 1):
        n = sum(1 for r in s if r.label == y)
        n_test = sum(1 for r in s if r.label == y and r.split == "test")
        n_val = sum(1 for r in s if r.label == y and r.split == "validation")
        assert n_test == math.ceil(0.2 * n) and n_val == math.ceil(0.25 * (n - n_test))


def test_hash_ops_ignore_partitioning(games):
    base = sorted(sa.hash_shuffle(games.select("game_id"), "game_id").collect())
    for n in (1, 7, 32):
        again = sorted(sa.hash_shuffle(games.select("game_id").repartition(n), "game_id").collect())
        assert again == base
    assert sorted(r.position for r in base) == list(range(len(base)))


def test_row_position_exact_with_groups(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 5000).alias("v"))
    got = row_position(df, ["v"], ["g"], name="p").collect()
    for g in range(3):
        vals = sorted(r.v for r in got if r.g == g)
        pos = {r.v: r.p for r in got if r.g == g}
        assert [pos[v] for v in vals] == list(range(len(vals)))


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    vals = [float((i * 37) % 101) for i in range(999)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    q = exact_quantiles(df, "x", [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]).first()
    for i, p in enumerate([0.0, 0.1, 0.25, 0.5, 0.9, 1.0]):
        assert q[f"q{i}"] == pytest.approx(float(np.quantile(vals, p)))


@pytest.fixture(scope="module")
def scores(spark):
    return ad.scores(spark, SF001).cache()


def test_confusion_counts_cover_all_rows(scores):
    r = ev.confusion_metrics(scores, "label", score="prob1", threshold=0.5).first()
    assert r.tp + r.tn + r.fp + r.fn == scores.count()


def test_auc_of_negated_score(scores):
    a = ev.roc_auc(scores, "label", "prob1").first().auc
    b = ev.roc_auc(scores.withColumn("prob1", -F.col("prob1")), "label", "prob1").first().auc
    assert a + b == pytest.approx(1.0)


def test_auc_brute_force(scores):
    rows = scores.collect()
    pos = [r.prob1 for r in rows if r.label == 1]
    neg = [r.prob1 for r in rows if r.label == 0]
    u = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    assert ev.roc_auc(scores, "label", "prob1").first().auc == pytest.approx(u / (len(pos) * len(neg)))


def test_threshold_scan_matches_single_threshold(scores):
    scan = {r.threshold: r for r in ev.threshold_scan(scores, "label", "prob1").collect()}
    one = ev.confusion_metrics(scores, "label", score="prob1", threshold=0.4).first()
    assert (scan[0.4].tp, scan[0.4].fp, scan[0.4].f1) == (one.tp, one.fp, one.f1)


def test_best_threshold_prefers_lowest_on_ties(spark):
    scan = spark.createDataFrame([(0.3, 0.5), (0.4, 0.7), (0.5, 0.7)], "threshold double, f1 double")
    assert ev.best_threshold(scan).first().threshold == 0.4


def test_balance_keeps_minority(games):
    lab = games.select("game_id", F.when(F.col("Winner") == "White", 1).otherwise(0).alias("label"))
    counts = {r.label: r["count"] for r in lab.groupBy("label").count().collect()}
    minority = min(counts, key=counts.get)
    bal = {r.label: r["count"] for r in sa.balance_classes(lab, "label", "game_id").groupBy("label").count().collect()}
    assert bal[minority] == counts[minority] and bal[1 - minority] <= counts[1 - minority]


def test_profile_ignores_partitioning(games):
    base = sorted(pr.entity_profile(games, "WhiteName", "WhiteElo", "Opening", "Winner").collect())
    for n in (1, 7, 32):
        again = pr.entity_profile(games.repartition(n), "WhiteName", "WhiteElo", "Opening", "Winner").collect()
        assert [(r.Player, r.GamesAsWhite, r.WinsAsWhite, round(r.ShannonEntropy, 9)) for r in sorted(again)] == \
               [(r.Player, r.GamesAsWhite, r.WinsAsWhite, round(r.ShannonEntropy, 9)) for r in base]


def test_board_features_ignore_partitioning(spark):
    from pawnshop.operators import board as B
    pieces = ad.boards(spark, SF001).cache()
    base = sorted(B.position_features(pieces, ["board_id"]).collect())
    for n in (1, 7):
        assert sorted(B.position_features(pieces.repartition(n), ["board_id"]).collect()) == base
