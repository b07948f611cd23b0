"""Model fitting: a signal test and the shape of the result rows."""

import pytest
from pyspark.sql import functions as F

from pawnshop.operators import learn as L
from pawnshop.plans import adapters as ad

from conftest import SF01


@pytest.fixture(scope="module")
def table(spark):
    # label is a function of the features, so a working fit must beat chance clearly
    g = ad.games(spark, SF01).where(F.col("WhiteElo").isNotNull() & F.col("BlackElo").isNotNull())
    return g.select("game_id", "WhiteElo", "BlackElo",
                    (F.col("WhiteElo") > F.col("BlackElo")).cast("int").alias("label"))


FEATS = ["WhiteElo", "BlackElo"]


def _check(row, n_min=100):
    assert row.tp + row.tn + row.fp + row.fn >= n_min
    assert 0.0 <= row.accuracy <= 1.0 and 0.0 <= row.f1 <= 1.0


def test_logistic_learns_signal(table):
    r = L.logistic_phase(table, "label", FEATS, "game_id").first()
    _check(r)
    assert r.auc > 0.9 and r.accuracy > 0.8


def test_linear_reports_regression_metrics(table):
    r = L.linear_phase(table, "label", FEATS, "game_id").first()
    _check(r)
    assert r.rmse is not None and r.r2 > 0.2 and r.auc > 0.9


def test_forest_threshold_from_validation(table):
    r = L.forest_phase(table, "label", FEATS, "game_id", trees=5, depth=4).first()
    _check(r)
    assert r.threshold in (0.3, 0.4, 0.5, 0.6, 0.7) and r.auc > 0.9


def test_feature_weights_and_guard(spark, table):
    top = L.fit_forest_with_weights(table, "label", FEATS, "game_id", trees=5, depth=4, k=2).collect()
    assert {r.feature for r in top} == set(FEATS)
    empty = table.where("game_id < 0")
    assert L.logistic_phase(empty, "label", FEATS, "game_id").first().error.startswith("only 0")


def test_an_empty_test_split_gives_a_record(spark, table):
    from pawnshop.operators.sampling import hash_split
    train_only = hash_split(table, "game_id", seed=42).where("split = 'train'").drop("split")
    for fit in (L.linear_phase, L.logistic_phase):
        r = fit(train_only, "label", FEATS, "game_id").first()
        assert r.error == "no test rows" and r.model


def test_cyclic_donors_are_permutations_without_fixed_rows(spark):
    rows = spark.range(23).select(F.col("id").alias("key"), (F.col("id") * 10).cast("double").alias("v"))
    got = L.cyclic_donors(rows, "key", ["v"], repeats=5, seed=1).collect()
    by = {}
    for r in got:
        by.setdefault(r.repeat, {})[r.key] = int(r.donor[0]) // 10
    assert sorted(by) == list(range(5))
    for m in by.values():
        assert sorted(m) == sorted(m.values()) == list(range(23)) and all(k != v for k, v in m.items())
    assert len({tuple(sorted(m.items())) for m in by.values()}) == 5
    # one cycle in hash order, shifted: repeat r goes 1 + floor(r * 22 / 5) steps along the cycle of repeat 0
    for r, m in by.items():
        for k in range(23):
            at = k
            for _ in range(1 + r * 22 // 5):
                at = by[0][at]
            assert m[k] == at
    one = L.cyclic_donors(rows.limit(1), "key", ["v"], repeats=2).collect()
    assert [r.donor[0] for r in one] == [one[0].v] * 2


def test_permutation_importance_finds_the_signal(spark, table):
    from pawnshop.functions.scalar import hash_unit
    t = table.withColumn("noise", hash_unit("game_id", 7, "noise"))
    got = L.permutation_importance(t, "label", [*FEATS, "noise"], "game_id", [*FEATS, "noise"], repeats=3, trees=5, depth=4)
    w = {r.feature: r.importance for r in got.collect()}
    assert min(w["WhiteElo"], w["BlackElo"]) > 0.1 > abs(w["noise"])
    assert L.permutation_importance(t.where("game_id < 0"), "label", FEATS, "game_id", FEATS).count() == 0


def test_permutation_importance_is_the_drop_of_f1(spark, table):
    """Against rescoring each repeat and column on its own."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pawnshop.operators.sampling import class_weights, stratified_split

    got = {r.feature: r.importance for r in L.permutation_importance(
        table, "label", FEATS, "game_id", FEATS, repeats=2, trees=3, depth=3).collect()}
    data = stratified_split(L.prepared(table, "label", FEATS, "game_id"), "label", "game_id", seed=42).checkpoint()
    est = RandomForestClassifier(labelCol="label", weightCol="class_weight", numTrees=3, maxDepth=3, seed=42)
    model = Pipeline(stages=[L.assembler(FEATS), est]).fit(class_weights(data.where("split = 'train'"), "label"))
    val = data.where("split = 'validation'").drop("split")

    def f1(frame):
        p = model.transform(frame).select("label", "prediction").collect()
        tp = sum(r.label == 1 and r.prediction == 1 for r in p)
        return 2 * tp / (sum(r.label == 1 for r in p) + sum(r.prediction == 1 for r in p))

    donors = L.cyclic_donors(val, "game_id", FEATS, 2, 42).checkpoint()
    base = f1(val)
    for i, c in enumerate(FEATS):
        drops = [base - f1(donors.where(F.col("repeat") == r).withColumn(c, F.col("donor")[i])) for r in range(2)]
        assert got[c] == pytest.approx(sum(drops) / 2, abs=1e-9)


def test_report_keeps_scans_features_and_counts(spark, table, tmp_path):
    from pawnshop import sources as S
    long = table.withColumn("phase", F.lit("mid")).unionByName(table.withColumn("phase", F.lit("final")))
    fits = L.fit_all_phases(long, "label", FEATS, "game_id", phases=("mid", "final"), models=("linear", "logistic"))
    forest = L.forest_phase(table, "label", FEATS, "game_id", trees=3, depth=3)
    report = L.metrics_report(L.metrics_table([fits, forest]), table.count())
    S.write_json(report, str(tmp_path / "m"))
    back = spark.read.schema(report.schema).json(str(tmp_path / "m"))
    r = back.first()
    assert r.dataset_rows == table.count() and r.generated_at.startswith("20")
    assert [x.phase for x in r.linear_regression] == ["final", "mid"] and not r.hist_gradient_boosting
    f = r.random_forest[0]
    assert [s.threshold for s in f.scan] == [0.3, 0.4, 0.5, 0.6, 0.7]
    assert f.threshold == max(f.scan, key=lambda s: (s.f1, -s.threshold)).threshold
    assert {t.feature for t in f.top_features} == set(FEATS) and sum(t.weight for t in f.top_features) == pytest.approx(1)
    assert L.report_rows(back).count() == 5


def test_forest_table_and_threshold_choices(spark, table):
    nodes = L.forest_table(table, "label", FEATS, "game_id", trees=3, depth=3).collect()
    assert {r.tree for r in nodes} == {0, 1, 2}
    for r in nodes:
        inner = r.left >= 0
        assert (r.feature in FEATS) == inner == (r.threshold is not None) == (r.leaf is None)
    assert L.forest_table(table.where("game_id < 0"), "label", FEATS, "game_id").count() == 0
    got = L.threshold_choices(L.forest_phase(table, "label", FEATS, "game_id", trees=3, depth=3)).collect()
    assert [r.chosen for r in got].count(True) == 1
    best = max(got, key=lambda r: (r.f1, -r.threshold))
    assert best.chosen
