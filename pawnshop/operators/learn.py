"""Model fitting and scoring on feature tables."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, functions as F


def standardize(df: DataFrame, cols: list[str], keep: list[str] = (), prefix: str = "z_") -> DataFrame:
    """L2: (x - mean) / sample std per column.  The moments are one global
    aggregate, inlined as scalar subqueries (no join, no driver round trip).  A
    column without spread becomes 0, as centring alone would leave it."""
    stats = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"s_{c}") for c in cols])
    out = [*keep]
    for c in cols:
        m = stats.select(f"m_{c}").scalar()
        s = stats.select(f"s_{c}").scalar()
        out.append(F.when(F.col(c).isNull(), F.lit(None)).when(s > 0, (F.col(c) - m) / F.nullif(s, F.lit(0.0))).otherwise(F.lit(0.0)).alias(f"{prefix}{c}"))
    return df.select(*out)


# --------------------------------------------------------------------------- fitting

from pyspark.ml import Pipeline  # noqa: E402
from pyspark.ml.classification import (  # noqa: E402
    LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler  # noqa: E402
from pyspark.ml.functions import vector_to_array  # noqa: E402
from pyspark.ml.regression import LinearRegression  # noqa: E402

from pawnshop.operators import evaluate as ev  # noqa: E402
from pawnshop.operators.reshape import complete_cases  # noqa: E402
from pawnshop.operators.sampling import class_weights, hash_split, stratified_split  # noqa: E402
from pawnshop.schema import THRESHOLDS  # noqa: E402

MIN_ROWS = 50


def prepared(df: DataFrame, label: str, features: list[str], key: str) -> DataFrame:
    """Complete cases of a table written once to the checkpoint folder: the fit,
    the split counts and every metric then read this table instead of re-running
    the feature lineage (and a lost executor does not lose it).  The conditions
    apply to the written columns: pushed below the features, each would repeat
    the whole expression of its feature."""
    from pawnshop.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)  # the cluster's folder; a local one only when none is set
    return complete_cases(df.select(key, label, *features).checkpoint(eager=True), label, features, [key])


def assembler(features: list[str], out: str = "features") -> VectorAssembler:
    """L1: feature columns -> one vector column."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="skip")


def _scaled(features):
    return [assembler(features, "raw"),
            StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)]


def _score(model, df, label, kind):
    pred = model.transform(df)
    if kind == "linear":
        return pred.select(F.col(label).alias("label"), F.col("prediction").alias("prob1"))
    return pred.select(F.col(label).alias("label"), vector_to_array("probability")[1].alias("prob1"))


def _metrics_row(spark, info: dict, scored, threshold: float, with_regression: bool = False, scan=None, top=None):
    """One result row: confusion metrics, exact AUC and (optionally) RMSE/R^2, with the
    scan of thresholds on validation and the heaviest features where there are any.
    Each part is a one-row aggregate; the final row is assembled on the driver
    (a handful of numbers, not data)."""
    row = dict(info)
    row["threshold"] = float(threshold)
    row.update(ev.confusion_metrics(scored, "label", score="prob1", threshold=threshold).first().asDict())
    row.update(ev.roc_auc(scored, "label", "prob1").first().asDict())
    reg = ev.regression_metrics(scored, "label", "prob1").first().asDict() if with_regression else {}
    row["rmse"], row["r2"] = reg.get("rmse"), reg.get("r2")
    schema = ("phase string, model string, train_rows long, threshold double, tp long, tn long, fp long, "
              "fn long, accuracy double, precision double, recall double, f1 double, auc double, "
              "rmse double, r2 double")
    names = [c.split(" ")[0] for c in schema.split(", ")]
    lists = ", scan array<struct<threshold: double, precision: double, recall: double, f1: double>>, top_features array<struct<feature: string, weight: double>>"
    scan = [(r["threshold"], r["precision"], r["recall"], r["f1"]) for r in scan] if scan is not None else None
    top = [(r["feature"], r["weight"]) for r in top] if top is not None else None
    return spark.createDataFrame([(*(row.get(n) for n in names), scan, top)], schema + lists)


def _top(weights: DataFrame, k: int = 15) -> list:
    """The k heaviest features, a list as short as k."""
    return ev.top_k_abs(weights, "weight", "feature", k).collect()


def _rows_by_split(data: DataFrame) -> dict:
    return {r["split"]: r["count"] for r in data.groupBy("split").count().collect()}


def _guard(spark, info, n_train, n_test=None):
    """An error record instead of a failure when there is too little data,
    a warning when there are fewer than ``MIN_ROWS`` training rows."""
    if n_train < 2:
        return spark.createDataFrame([(*info.values(), f"only {n_train} training rows")],
                                     [*info.keys(), "error"])  # D6: typed error record
    if n_test == 0:
        return spark.createDataFrame([(*info.values(), "no test rows")], [*info.keys(), "error"])
    if n_train < MIN_ROWS:
        warnings.warn(f"{info}: fitted on {n_train} rows, fewer than {MIN_ROWS}", stacklevel=3)
    return None


def linear_phase(df: DataFrame, label: str, features: list[str], key: str, phase: str = "mid",
                 seed: int = 42) -> DataFrame:
    """L3: linear regression on the 0/1 label (maxIter 50, L2 0.1), label 1 if
    prediction >= 0.5; accuracy/F1 plus RMSE and R^2 on the 20 % test split."""
    data = hash_split(prepared(df, label, features, key), key, seed=seed)
    train, test = data.where("split = 'train'"), data.where("split = 'test'")
    info = {"phase": phase, "model": "linear"}
    rows = _rows_by_split(data)
    n = rows.get("train", 0)
    bad = _guard(df.sparkSession, info, n, rows.get("test", 0))
    if bad is not None:
        return bad
    model = Pipeline(stages=_scaled(features) + [
        LinearRegression(featuresCol="features", labelCol=label, maxIter=50, regParam=0.1)]).fit(train)
    return _metrics_row(df.sparkSession, {**info, "train_rows": n},
                        _score(model, test, label, "linear"), 0.5, with_regression=True,
                        top=_top(feature_weights(df.sparkSession, model, features)))


def logistic_phase(df: DataFrame, label: str, features: list[str], key: str, phase: str = "mid",
                   seed: int = 42) -> DataFrame:
    """L4: logistic regression (maxIter 100, L2 0.1); accuracy and AUC on test."""
    data = hash_split(prepared(df, label, features, key), key, seed=seed)
    train, test = data.where("split = 'train'"), data.where("split = 'test'")
    info = {"phase": phase, "model": "logistic"}
    rows = _rows_by_split(data)
    n = rows.get("train", 0)
    bad = _guard(df.sparkSession, info, n, rows.get("test", 0))
    if bad is not None:
        return bad
    model = Pipeline(stages=_scaled(features) + [
        LogisticRegression(featuresCol="features", labelCol=label, maxIter=100, regParam=0.1,
                           elasticNetParam=0.0)]).fit(train)
    return _metrics_row(df.sparkSession, {**info, "train_rows": n}, _score(model, test, label, "logistic"), 0.5,
                        top=_top(feature_weights(df.sparkSession, model, features)))


def logistic_weights(df: DataFrame, label: str, features: list[str], key: str, seed: int = 42) -> DataFrame:
    """(feature, weight) of the logistic model of ``logistic_phase`` on standardized features, the intercept as a
    row of its own; no rows where there is too little to fit on."""
    train = hash_split(prepared(df, label, features, key), key, seed=seed).where("split = 'train'")
    spark = df.sparkSession
    if train.select(label).distinct().count() < 2:
        return spark.createDataFrame([], "feature string, weight double")
    model = Pipeline(stages=_scaled(features) + [
        LogisticRegression(featuresCol="features", labelCol=label, maxIter=100, regParam=0.1, elasticNetParam=0.0)]).fit(train)
    top = spark.createDataFrame([("intercept", float(model.stages[-1].intercept))], "feature string, weight double")
    return feature_weights(spark, model, features).unionByName(top)


def _weighted_tree(df, label, features, key, phase, name, estimator, seed):
    """Flow of L5: stratified 60/20/20 split, class weights from the
    training rows, threshold chosen on validation, metrics on test."""
    data = stratified_split(prepared(df, label, features, key), label, key, seed=seed).checkpoint(eager=True)
    train = class_weights(data.where("split = 'train'"), label)
    val, test = data.where("split = 'validation'"), data.where("split = 'test'")
    info = {"phase": phase, "model": name}
    rows = _rows_by_split(data)
    n = rows.get("train", 0)
    bad = _guard(df.sparkSession, info, n, rows.get("test", 0))
    if bad is not None:
        return bad, None
    model = Pipeline(stages=[assembler(features), estimator]).fit(train)
    scan = ev.threshold_scan(_score(model, val, label, "tree"), "label", "prob1", THRESHOLDS)
    t, scan = _tuned(scan)
    return _metrics_row(df.sparkSession, {**info, "train_rows": n}, _score(model, test, label, "tree"), t, scan=scan,
                        top=_top(feature_weights(df.sparkSession, model, features))), model


def _tuned(scan: DataFrame) -> tuple[float, list]:
    """E5: the best threshold on validation (0.5 without validation rows) and the scan, a row per threshold."""
    scan = scan.orderBy("threshold").checkpoint(eager=True)
    best = ev.best_threshold(scan).first()
    return (best["threshold"] if best else 0.5), scan.collect()


def forest_phase(df: DataFrame, label: str, features: list[str], key: str, phase: str = "mid",
                 trees: int = 60, depth: int = 8, seed: int = 42) -> DataFrame:
    """Weighted random forest (60 trees, depth 8, seed 42)."""
    est = RandomForestClassifier(featuresCol="features", labelCol=label, weightCol="class_weight",
                                 numTrees=trees, maxDepth=depth, seed=seed)
    return _weighted_tree(df, label, features, key, phase, "forest", est, seed)[0]


def boosting_phase(df: DataFrame, label: str, features: list[str], key: str, phase: str = "mid",
                   rounds: int = 300, depth: int = 6, rate: float = 0.1, seed: int = 42, patience: int = 15,
                   folder: str | None = None) -> DataFrame:
    """L6 (re-aimed): gradient-boosted trees with class weights, up to ``rounds`` of them; stops ``patience`` rounds
    after the least validation loss and scores with the trees up to it.  With a ``folder`` of the caller's, a driver
    that died is replaced by a new call, which goes on after the last finished round."""
    from pawnshop.operators import boosting as B, trees as T
    from pawnshop.session import scratch_path

    spark = df.sparkSession
    data = stratified_split(prepared(df, label, features, key), label, key, seed=seed).checkpoint(eager=True)
    info = {"phase": phase, "model": "boosting"}
    rows = _rows_by_split(data)
    n = rows.get("train", 0)
    bad = _guard(spark, info, n, rows.get("test", 0))
    if bad is not None:
        return bad
    folder = folder or scratch_path(spark, "boosting")
    train = class_weights(data.where("split = 'train'"), label)
    weighted = train.unionByName(data.where("split = 'validation'").withColumn("class_weight", F.lit(1.0)))
    losses = B.boost(weighted, label, features, "class_weight", folder, rounds, depth, rate, patience=patience, seed=seed)
    trees = B.boosted_trees(spark, folder, 1, B.best_round(losses))
    rest = data.where("split <> 'train'").select("split", F.col(label).alias("label"), F.array(*[F.col(c).cast("double") for c in features]).alias("_x"))
    # several aggregates read the scores
    scored = (B.with_margin(rest, trees, "_x", depth, rate, "_margin")
              .select("split", "label", B.probability(F.col("_margin")).alias("prob1")).checkpoint(eager=True))
    t, scan = _tuned(ev.threshold_scan(scored.where("split = 'validation'").drop("split"), "label", "prob1", THRESHOLDS))
    return _metrics_row(spark, {**info, "train_rows": n}, scored.where("split = 'test'").drop("split"), t, scan=scan,
                        top=_top(T.importances(trees, features)))


def feature_weights(spark, model, features: list[str]) -> DataFrame:
    """Coefficients (linear models) or impurity importances (trees) as a
    table - one row per feature, so it is as small as the feature list."""
    last = model.stages[-1] if hasattr(model, "stages") else model
    if hasattr(last, "coefficients"):
        w = last.coefficients.toArray().tolist()
    else:
        w = last.featureImportances.toArray().tolist()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, w)], "feature string, weight double")


def fit_forest_with_weights(df, label, features, key, phase="mid", trees=60, depth=8, seed=42, k=15):
    """L5 + L9 + O4: the top-k impurity importances of the weighted forest."""
    est = RandomForestClassifier(featuresCol="features", labelCol=label, weightCol="class_weight",
                                 numTrees=trees, maxDepth=depth, seed=seed)
    _, model = _weighted_tree(df, label, features, key, phase, "forest", est, seed)
    if model is None:
        return df.sparkSession.createDataFrame([], "feature string, weight double")
    return ev.top_k_abs(feature_weights(df.sparkSession, model, features), "weight", "feature", k)


def forest_table(df: DataFrame, label: str, features: list[str], key: str, phase: str = "mid",
                 trees: int = 60, depth: int = 8, seed: int = 42) -> DataFrame:
    """The nodes of the fitted forest as rows (``trees.nodes_of``) with the features' names; ``trees`` scores and
    weighs with them.  No rows where there is too little to fit on."""
    from pawnshop.operators.trees import nodes_of
    est = RandomForestClassifier(featuresCol="features", labelCol=label, weightCol="class_weight",
                                 numTrees=trees, maxDepth=depth, seed=seed)
    _, model = _weighted_tree(df, label, features, key, phase, "forest", est, seed)
    if model is None:
        return df.sparkSession.createDataFrame([], "tree int, node int, feature string, threshold double, left int, right int, leaf double")
    names = F.get(F.array(*[F.lit(c) for c in features]), F.col("feature"))
    return (nodes_of(model.stages[-1]).withColumn("feature", F.when(F.col("left") >= 0, names))
            .select("tree", "node", "feature", "threshold", "left", "right", "leaf"))


def threshold_choices(fit: DataFrame) -> DataFrame:
    """E5: the validation scan behind a fit's threshold, a row per threshold; ``chosen`` marks the one that was taken."""
    return fit.select("phase", "model", "threshold", F.explode("scan").alias("_s")).select(
        "phase", "model", "_s.*", (F.col("_s.threshold") == F.col("threshold")).alias("chosen"))


def fit_counts(df: DataFrame, label: str, key: str, seed: int = 42) -> DataFrame:
    """Rows per class in each part of the split that the tree models fit, tune and test on."""
    split = stratified_split(df.where(F.col(label).isin(0, 1)), label, key, seed=seed)
    return split.groupBy(label, "split").agg(F.count(F.lit(1)).alias("n"))


def cyclic_donors(df: DataFrame, key: str, columns: list[str], repeats: int = 5, seed: int = 42) -> DataFrame:
    """Each row ``repeats`` times with the values of another row: ``repeat`` and the array ``donor`` of ``columns``.

    Rows stand in hash order once; in repeat r the row at position p of n takes
    the values of position (p + 1 + floor(r (n - 1) / repeats)) mod n, so that
    every repeat is a permutation without a fixed row, and no two are the same
    while there are more rows than repeats.  A single row is its own donor.
    """
    from pawnshop.functions.scalar import hash_unit
    from pawnshop.operators.ranking import row_position

    order = row_position(df.withColumn("_h", hash_unit(key, seed, "permute")), ["_h", key], name="_p", uniform=True).checkpoint(eager=True)
    n, r = F.col("_p_n"), F.col("repeat")
    shift = F.when(n > 1, 1 + F.expr(f"(repeat * (_p_n - 1)) div {int(repeats)}")).otherwise(F.lit(0))
    wants = (order.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
             .withColumn("_from", F.pmod(F.col("_p") + shift, n)).drop("_p", "_p_n", "_h"))
    gives = order.select(F.col("_p").alias("_from"), F.array(*[F.col(c).cast("double") for c in columns]).alias("donor"))
    return wants.join(gives, "_from").drop("_from").withColumn("repeat", r.cast("int"))


def permutation_importance(df: DataFrame, label: str, features: list[str], key: str, columns: list[str],
                           repeats: int = 5, seed: int = 42, trees: int = 20, depth: int = 6) -> DataFrame:
    """Mean F1 drop on validation when one column takes the values of other rows (``cyclic_donors``).

    One ranking serves all repeats.  A row isn't multiplied by its columns: each
    column has its own score expression over the row's vector with that one value
    changed, and one aggregate counts for all columns.  Without training or
    validation rows there is nothing to measure: no rows (D6).
    """
    from pyspark.ml.functions import array_to_vector

    spark, out = df.sparkSession, "feature string, importance double"
    est = RandomForestClassifier(featuresCol="features", labelCol=label, weightCol="class_weight",
                                 numTrees=trees, maxDepth=depth, seed=seed)
    data = stratified_split(prepared(df, label, features, key), label, key, seed=seed).checkpoint(eager=True)
    rows = _rows_by_split(data)
    if rows.get("train", 0) < 2 or not rows.get("validation", 0):
        warnings.warn(f"permutation importance: {rows} rows are too few", stacklevel=2)
        return spark.createDataFrame([], out)
    train = class_weights(data.where("split = 'train'"), label)
    val = data.where("split = 'validation'").drop("split")
    forest = Pipeline(stages=[assembler(features), est]).fit(train).stages[-1]

    def scored(frame, of, name):
        to = {forest.featuresCol: of, forest.probabilityCol: name, forest.rawPredictionCol: "", forest.predictionCol: ""}
        return forest.copy(to).transform(frame)

    both = cyclic_donors(val, key, columns, repeats, seed).withColumn("_x", F.array(*[F.col(c).cast("double") for c in features]))
    both = both.select(F.col(label).alias("_y"), "repeat", "donor", "_x", array_to_vector("_x").alias("_v"))
    both = scored(both, "_v", "_p")

    def changed(i, c):
        return array_to_vector(F.transform("_x", lambda v, j: F.when(j == features.index(c), F.get("donor", F.lit(i))).otherwise(v)))

    for i, c in enumerate(columns):
        both = scored(both.withColumn(f"_v{i}", changed(i, c)), f"_v{i}", f"_p{i}").drop(f"_v{i}")
    names = ["_p", *[f"_p{i}" for i in range(len(columns))]]
    y = F.col("_y") == 1
    yes = both.select(y.alias("_y"), "repeat", *[(vector_to_array(p)[1] >= 0.5).alias(p) for p in names])
    # F1 = 2 tp / (predicted + positives)
    counts = yes.groupBy("repeat").agg(F.count_if("_y").alias("_pos"), *[F.struct(
        F.count_if(F.col("_y") & F.col(p)).alias("tp"), F.count_if(F.col(p)).alias("all")).alias(p) for p in names])
    f1 = lambda p: F.when(p["all"] + F.col("_pos") > 0, 2 * p["tp"] / (p["all"] + F.col("_pos"))).otherwise(F.lit(0.0))
    drops = F.array(*[F.struct(F.lit(c).alias("feature"), (f1(F.col("_p")) - f1(F.col(f"_p{i}"))).alias("drop")) for i, c in enumerate(columns)])
    return (counts.select(F.explode(drops).alias("d")).groupBy(F.col("d.feature").alias("feature"))
            .agg(F.avg("d.drop").alias("importance")))


def fit_all_phases(long: DataFrame, label: str, features: list[str], key: str, phase_col: str = "phase",
                   phases=("open", "mid", "final"), models=("linear",), parallelism: int = 3) -> DataFrame:
    """The same fits for every phase of a long (key, phase, features, label)
    table; one result row per phase x model.  Checkpoint ``long`` first when it
    is expensive: each fit reads it once per phase.  The fits don't depend on
    each other: ``parallelism`` of them submit their jobs at a time, as Spark's
    own cross-validator does."""
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target

    fits = {"linear": linear_phase, "logistic": logistic_phase, "forest": forest_phase,
            "boosting": boosting_phase}
    spark = long.sparkSession

    @inheritable_thread_target(spark)
    def fit(job):
        phase, model = job
        return fits[model](long.where(F.col(phase_col) == phase).drop(phase_col), label, features, key, phase)

    # the long fits first
    order = sorted([(p, m) for p in phases for m in models], key=lambda job: job[1] != "boosting")
    with ThreadPool(min(parallelism, len(order))) as pool:
        return metrics_table(pool.map(fit, order, chunksize=1))


#: Name of each model family's list in the report.
REPORT_LISTS = {"linear": "linear_regression", "logistic": "logistic_regression", "boosting": "hist_gradient_boosting",
                "forest": "random_forest"}


def metrics_report(table: DataFrame, dataset_rows: int) -> DataFrame:
    """The fit results as one record: when it was made, rows of the data set, and a list of results per model
    family.  As many entries as fits; a family without fits has an empty list."""
    rest = F.struct(*[c for c in table.columns if c != "model"])
    lists = [F.sort_array(F.collect_list(F.when(F.col("model") == m, rest))).alias(name) for m, name in REPORT_LISTS.items()]
    return table.agg(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("generated_at"),
                     F.lit(dataset_rows).cast("long").alias("dataset_rows"), *lists)


def report_rows(report: DataFrame) -> DataFrame:
    """The results of a report as a table again, a row per phase and model."""
    parts = [report.select("generated_at", "dataset_rows", F.lit(m).alias("model"), F.explode(name).alias("_r"))
             for m, name in REPORT_LISTS.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("generated_at", "dataset_rows", "model", "_r.*")


def metrics_table(results: list[DataFrame]) -> DataFrame:
    """All fit results as one table (one row per phase x model)."""
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return out
