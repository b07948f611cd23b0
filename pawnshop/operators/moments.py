"""Linear models of all phases from one mergeable table of moments.

The sums of all products of two columns (with a constant one among them) are
everything that means, deviations, ridge coefficients, intercept, RMSE and R²
need.  They are plain partial aggregates, grouped by phase and split: one pass
over the data fits and tests the linear models of every phase, and sums of new
rows can be added to old ones (``merged``).  What reaches the driver grows with
the square of the number of features, not with the data.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from pawnshop.operators.reshape import complete_cases
from pawnshop.operators.sampling import hash_split

ONE = "1"


def _columns(label: str, features: list[str]) -> list[str]:
    return [ONE, *features, label]


def moment_pairs(label: str, features: list[str]) -> list[tuple[str, str]]:
    """The pairs whose products are summed, in the order of ``moments``."""
    names = _columns(label, features)
    return [(a, b) for i, a in enumerate(names) for b in names[i:]]


def moment_matrix(df: DataFrame, label: str, features: list[str], by: list[str]) -> DataFrame:
    """(by..., moments): sums of the products of every two columns per group; rows with nulls must be gone."""
    col = {c: F.col(c).cast("double") for c in (*features, label)} | {ONE: F.lit(1.0)}
    sums = [F.sum(col[a] * col[b]).alias(f"_p{i}") for i, (a, b) in enumerate(moment_pairs(label, features))]
    grouped = df.groupBy(*by).agg(*sums)
    return grouped.select(*by, F.array(*[f"_p{i}" for i in range(len(sums))]).alias("moments"))


def merged(parts: DataFrame, by: list[str]) -> DataFrame:
    """One row per group from the moments of several batches."""
    x = parts.select(*by, F.posexplode("moments").alias("_i", "_v")).groupBy(*by, "_i").agg(F.sum("_v").alias("_v"))
    return x.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_v"))), lambda s: s["_v"]).alias("moments"))


def long_moments(moments: DataFrame, label: str, features: list[str], by: list[str]) -> DataFrame:
    """(by..., a, b, total): one row per pair."""
    pairs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in moment_pairs(label, features)])
    z = F.explode(F.arrays_zip(pairs.alias("p"), F.col("moments").alias("m"))).alias("z")
    return moments.select(*by, z).select(*by, "z.p.a", "z.p.b", F.col("z.m").alias("total"))


class Moments:
    """The symmetric matrix of one group."""

    def __init__(self, values: list[float], size: int):
        self.m = np.zeros((size, size))
        self.m[np.triu_indices(size)] = values
        self.m = np.triu(self.m) + np.triu(self.m, 1).T
        self.n = self.m[0, 0]

    def ridge(self, reg: float) -> tuple[float, np.ndarray]:
        """(intercept, coefficients in the features' own units) of least squares on standardized columns and label
        with the penalty reg / deviation of the label; a column without spread gets 0."""
        mean = self.m[0, 1:] / self.n
        cov = self.m[1:, 1:] / self.n - np.outer(mean, mean)
        spread = np.sqrt(np.maximum(np.diag(cov), 0))
        # what rounding leaves of a constant column's variance is no spread
        spread[np.diag(cov) <= 1e-12 * np.maximum(np.diag(self.m)[1:] / self.n, 1e-300)] = 0
        x, y = spread[:-1], spread[-1]
        w = np.zeros(len(x))
        live = np.flatnonzero(x > 0)
        if y > 0 and len(live):
            corr = cov[np.ix_(live, live)] / np.outer(x[live], x[live])
            w[live] = np.linalg.solve(corr + reg / y * np.eye(len(live)), cov[live, -1] / (x[live] * y)) * y / x[live]
        return float(mean[-1] - w @ mean[:-1]), w

    def deviations(self) -> np.ndarray:
        """Sample standard deviation of each feature."""
        mean = self.m[0, 1:-1] / self.n
        return np.sqrt(np.maximum(np.diag(self.m)[1:-1] - self.n * mean * mean, 0) / max(self.n - 1, 1))

    def errors(self, intercept: float, w: np.ndarray) -> tuple[float, float | None]:
        """(RMSE, R²) of a linear score on this group's rows; no R² where the label doesn't vary."""
        v = np.concatenate([[-intercept], -w, [1.0]])
        sse = max(float(v @ self.m @ v), 0.0)
        sst = float(self.m[-1, -1] - self.m[0, -1] ** 2 / self.n)
        return float(np.sqrt(sse / self.n)), (1 - sse / sst if sst > 0 else None)


def phase_moments(long: DataFrame, label: str, features: list[str], key: str, phase_col: str = "phase", seed: int = 42) -> DataFrame:
    """(phase, split, moments) of the complete cases of every phase; the split is the one of ``linear_phase``."""
    rows = hash_split(complete_cases(long, label, features, [key, phase_col]), key, seed=seed)
    return moment_matrix(rows, label, features, [phase_col, "split"])


def _fits(moments: DataFrame, features: list[str], phase_col: str, reg: float):
    """(phase, training moments, test moments or None, intercept, coefficients) of each phase; two small rows a phase."""
    size = len(features) + 2
    found: dict = {}
    for r in moments.collect():
        found.setdefault(r[phase_col], {})[r["split"]] = Moments(r["moments"], size)
    for phase, parts in sorted(found.items(), key=lambda p: str(p[0])):
        if "train" in parts and parts["train"].n >= 2:
            yield phase, parts["train"], parts.get("test"), *parts["train"].ridge(reg)
        else:
            yield phase, None, parts.get("test"), None, None


def linear_summary(moments: DataFrame, features: list[str], phase_col: str = "phase", reg: float = 0.1) -> DataFrame:
    """(phase, train_rows, test_rows, intercept, rmse, r2, error): L3 for every phase; a phase with fewer than two
    training rows or no test rows has an error record."""
    rows = []
    for phase, train, test, intercept, w in _fits(moments, features, phase_col, reg):
        few = train is None
        error = "too few training rows" if few else "no test rows" if test is None else None
        rmse, r2 = (None, None) if error else test.errors(intercept, w)
        rows.append((phase, 0 if few else int(train.n), int(test.n) if test else 0, intercept, rmse, r2, error))
    return moments.sparkSession.createDataFrame(rows, "phase string, train_rows long, test_rows long, intercept double, rmse double, r2 double, error string")


def linear_weights(moments: DataFrame, features: list[str], phase_col: str = "phase", reg: float = 0.1) -> DataFrame:
    """(phase, feature, weight, standardized): L8 for every phase, weights per unit and per deviation; the intercept
    is a row of its own."""
    rows = []
    for phase, train, _, intercept, w in _fits(moments, features, phase_col, reg):
        if train is not None:
            rows += [(phase, "intercept", intercept, float(train.m[0, -1] / train.n))]
            rows += [(phase, f, float(a), float(a * s)) for f, a, s in zip(features, w, train.deviations(), strict=True)]
    return moments.sparkSession.createDataFrame(rows, "phase string, feature string, weight double, standardized double")
