"""Linear models from moments against Spark ML and against plain numpy."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from pawnshop.operators import learn as L, moments as MM
from pawnshop.operators.sampling import hash_split

FEATS = ["a", "b", "c", "flat"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    rows = []
    for phase in ("open", "mid"):
        for k in range(600):
            a, b = rng.normal(50, 9), rng.normal(-3, 0.2)
            y = int(a + 30 * b + rng.normal(0, 8) > -40)
            rows.append((k, phase, float(a), float(b), float(a * 0.5 + rng.normal()), 7.0, y))
    rows += [(1000, "open", None, 1.0, 1.0, 7.0, 1), (1001, "open", 1.0, 1.0, 1.0, 7.0, None)]
    return spark.createDataFrame(rows, "id long, phase string, a double, b double, c double, flat double, label int").cache()


@pytest.fixture(scope="module")
def moments(table):
    return MM.phase_moments(table, "label", FEATS, "id").cache()


def test_coefficients_and_errors_equal_spark_ml(table, moments):
    summary = {r.phase: r for r in MM.linear_summary(moments, FEATS).collect()}
    weights = {(r.phase, r.feature): r for r in MM.linear_weights(moments, FEATS).collect()}
    for phase in ("open", "mid"):
        one = hash_split(L.prepared(table.where(F.col("phase") == phase), "label", FEATS, "id"), "id", seed=42)
        model = Pipeline(stages=L._scaled(FEATS) + [LinearRegression(featuresCol="features", labelCol="label", maxIter=50, regParam=0.1)]).fit(
            one.where("split = 'train'"))
        for f, w in zip(FEATS, model.stages[-1].coefficients.toArray()):
            assert weights[phase, f].standardized == pytest.approx(w, abs=1e-6)
        assert weights[phase, "intercept"].standardized == pytest.approx(model.stages[-1].intercept, abs=1e-6)
        row = L.linear_phase(table.where(F.col("phase") == phase), "label", FEATS, "id", phase).first()
        assert summary[phase].train_rows == row.train_rows
        assert summary[phase].rmse == pytest.approx(row.rmse, abs=1e-6) and summary[phase].r2 == pytest.approx(row.r2, abs=1e-6)


def test_moments_of_batches_add_up(table, moments):
    parts = [MM.phase_moments(table.where(F.col("id") % 3 == k), "label", FEATS, "id") for k in range(3)]
    both = MM.merged(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["phase", "split"])
    key = lambda r: (r["phase"], r["split"])
    for x, y in zip(sorted(both.collect(), key=key), sorted(moments.collect(), key=key), strict=True):
        assert key(x) == key(y) and np.allclose(x["moments"], y["moments"], rtol=1e-12)


def test_moments_equal_numpy(table, moments):
    rows = hash_split(table.where("phase = 'mid'"), "id", seed=42).where("split = 'test'").collect()
    m = np.array([[1.0, *[r[f] for f in FEATS], r.label] for r in rows])
    got = moments.where("phase = 'mid' and split = 'test'").first()["moments"]
    assert np.allclose(MM.Moments(got, 6).m, m.T @ m)
    pairs = MM.long_moments(moments, "label", FEATS, ["phase", "split"]).where("phase = 'mid' and split = 'test' and a = 'b' and b = 'label'").first()
    assert pairs.total == pytest.approx((m[:, 2] * m[:, 5]).sum())


def test_too_few_rows_give_records(spark, table):
    small = MM.phase_moments(table.where("phase = 'open' and id < 2"), "label", FEATS, "id")
    r = MM.linear_summary(small, FEATS).collect()
    assert all(x.error for x in r) and MM.linear_summary(MM.phase_moments(table.where("id < 0"), "label", FEATS, "id"), FEATS).count() == 0
    # a label that doesn't vary: constant score, no R²
    flat = MM.phase_moments(table.withColumn("label", F.lit(1)), "label", FEATS, "id")
    assert all(x.rmse == pytest.approx(0, abs=1e-6) and x.r2 is None for x in MM.linear_summary(flat, FEATS).collect())
