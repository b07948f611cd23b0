"""Reproducible sampling, balancing and splitting.

Randomness comes from a hash of each row's key (``hash_unit``), never from
``rand``: results do not depend on partitioning, retries or cluster size.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from pawnshop.functions.scalar import hash_unit
from pawnshop.operators.ranking import row_position
from pawnshop.operators.selection import order_statistics


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Keep rows whose key hash falls below ``fraction``."""
    return df.where(hash_unit(key, seed) < F.lit(fraction))


def hash_split(df: DataFrame, key: str, weights=(0.8, 0.2), names=("train", "test"),
               seed: int = 42, name: str = "split") -> DataFrame:
    """Split by cumulative weights of the key hash (one pass, no shuffle)."""
    total = float(sum(weights))
    u = hash_unit(key, seed, "split")
    expr, acc = None, 0.0
    for w, n in zip(weights[:-1], names[:-1]):
        acc += w / total
        expr = (F.when(u < F.lit(acc), F.lit(n)) if expr is None else expr.when(u < F.lit(acc), F.lit(n)))
    expr = F.lit(names[-1]) if expr is None else expr.otherwise(F.lit(names[-1]))
    return df.withColumn(name, expr)


def hash_shuffle(df: DataFrame, key: str, seed: int = 42, name: str = "position") -> DataFrame:
    """O3: a seeded permutation - each row's exact 0-based position in hash order."""
    h = df.withColumn("_h", hash_unit(key, seed, "shuffle"))
    return row_position(h, ["_h", key], name=name, uniform=True).drop("_h", f"{name}_n")


def head_by_key(df: DataFrame, key: str, n: int) -> DataFrame:
    """O2: the first n rows by key (deterministic ``limit``)."""
    return df.orderBy(F.asc_nulls_last(key)).limit(n)


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_cnt"))


def balance_classes(df: DataFrame, label: str, key: str, ratio: float = 1.0,
                    seed: int = 42) -> DataFrame:
    """Down-sample the majority class to ``ratio`` x minority.

    Rows with a null label are dropped; if a class is missing the labelled rows
    are returned unchanged.  The per-class table has one row per label value,
    so broadcasting it is bounded.
    """
    counts = class_counts(df, label)
    classes, least = counts.agg(F.count(F.lit(1))).scalar(), counts.agg(F.min("_cnt")).scalar()
    frac = counts.select(
        label,
        F.when(classes < 2, F.lit(1.0)).when(F.col("_cnt") == least, F.lit(1.0))
         .otherwise(F.least(F.lit(1.0), F.lit(ratio) * least / F.col("_cnt"))).alias("_frac"))
    return (df.join(frac, label)
              .where(hash_unit(key, seed, "balance") < F.col("_frac")).drop("_frac"))


def class_weights(df: DataFrame, label: str, positive=1, name: str = "class_weight") -> DataFrame:
    """D3: positive weight = negatives / positives (1.0 without positives), others 1.0."""
    counts = class_counts(df, label)
    pos = counts.agg(F.sum(F.when(F.col(label) == positive, F.col("_cnt")))).scalar()
    neg = counts.agg(F.sum(F.when(F.col(label) != positive, F.col("_cnt")))).scalar()
    weights = counts.select(
        label,
        F.when(F.col(label) == positive,
               F.when(F.coalesce(pos, F.lit(0)) > 0, F.coalesce(neg, F.lit(0)) / pos).otherwise(F.lit(1.0)))
         .otherwise(F.lit(1.0)).cast("double").alias(name))
    return df.join(weights, label, "left").withColumn(
        name, F.coalesce(F.col(name), F.lit(1.0)))


def stratified_split(df: DataFrame, label: str, key: str, test: float = 0.2,
                     validation: float = 0.25, seed: int = 42, name: str = "split") -> DataFrame:
    """Exact stratified train/validation/test split.

    Within each label, rows are ordered by key hash, then key; the first
    ceil(test*n) go to test, the next ceil(validation * rest) to validation, the
    others to train.  The two cuts of each label are found by counting
    (``order_statistics``), so no row is shuffled: a row's split follows from its
    own hash and key.  Rows that repeat a key stay together, on the later side of
    a cut that would part them; rows without label or key are left out.
    """
    keyed = df.where(F.col(label).isNotNull() & F.col(key).isNotNull()).withColumn("_h", hash_unit(key, seed, "split"))

    def cuts(n: int) -> list[int]:
        n_test = math.ceil(n * test)
        return [n_test, n_test + math.ceil((n - n_test) * validation)]

    groups = [(group[label], cuts(n), at) for group, n, at in
              order_statistics(keyed, "_h", lambda n: [c for c in cuts(n) if c < n], [label])]
    tied = {(y, i): (at[c][0], c - at[c][1]) for y, own, at in groups for i, c in enumerate(own) if c in at and c > at[c][1]}
    keys = _tied_keys(keyed, label, key, tied)

    def before(y, i, cut, at):
        if cut not in at:  # the cut lies behind the last row
            return F.lit(True)
        below = F.col("_h") < at[cut][0]
        return below | ((F.col("_h") == at[cut][0]) & (F.col(key) < F.lit(keys[y, i]))) if (y, i) in keys else below

    expr = F
    for y, own, at in groups:
        first, second = (before(y, i, c, at) for i, c in enumerate(own))
        expr = expr.when(F.col(label) == F.lit(y), F.when(first, F.lit("test")).when(second, F.lit("validation")).otherwise(F.lit("train")))
    return keyed.withColumn(name, F.lit(None).cast("string") if expr is F else expr).drop("_h")


def _tied_keys(keyed: DataFrame, label: str, key: str, tied: dict) -> dict:
    """The first key behind each cut that falls among rows of one hash: {(label, cut): key}.

    ``tied`` tells the hash and how many of its rows lie before the cut.  Keys
    that share one 32-bit hash are few; a key that many rows repeat is one row here.
    """
    out = {}
    for (y, i), (h, n) in tied.items():
        same = keyed.where((F.col(label) == F.lit(y)) & (F.col("_h") == h)).groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_n"))
        upto = same.withColumn("_upto", F.sum("_n").over(Window.orderBy("_k")))
        out[y, i] = upto.where(F.col("_upto") > n).agg(F.min("_k")).first()[0]
    return out
