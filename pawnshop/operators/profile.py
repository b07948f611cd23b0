"""Profiles of categories and entities.

All aggregates are algebraic (count/sum/avg/min/max), so Spark combines them
map-side before the shuffle; a key that holds a third of all rows costs one
partial row per input partition, not a third of the data in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pawnshop.functions.scalar import outcome_flag, safe_cast, hash_unit
from pawnshop.operators.ranking import exact_quantiles
from pawnshop.operators.selection import EXACT, inlined, selected_quantiles


# --------------------------------------------------------------------------- A1-A5

def category_count(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """A1/A2: rows per category, null category included."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name))


def top_k_categories(df: DataFrame, col: str, k: int = 20, name: str = "n") -> DataFrame:
    """A3: the k most frequent categories; ties by category (nulls first)."""
    return (category_count(df, col, name)
            .orderBy(F.desc(name), F.asc_nulls_first(col)).limit(k))


def distinct_values(df: DataFrame, col: str, trim: bool = True) -> DataFrame:
    """A14 (+P7): distinct (trimmed) values."""
    c = F.trim(F.col(col)) if trim else F.col(col)
    return df.select(c.alias(col)).distinct()


def heavy_hitters(df: DataFrame, col: str, k: int = 20, tracked: int = 4096, buckets: int = 4096) -> DataFrame:
    """A2/A3 for columns of very many values: the exact top k (``top_k_categories``) without counting every value.

    A mergeable sketch of ``tracked`` counters names up to 4 k candidates.  One pass
    then counts these exactly and all other rows by hash bucket, at most
    ``4 k + buckets + 1`` groups a task.  A value that is no candidate has at most its bucket's rows,
    so a bucket below the k-th count is proven to hold none of the top k; only
    values of the buckets that prove nothing are counted one by one.  Null is a
    value of its own, ties go to the smaller value, nulls first.  The sketch
    decides only how much is left to count, never the result.
    """
    k, tracked = int(k), max(int(tracked), int(k))
    found = df.agg(F.expr(f"approx_top_k(`{col}`, {min(4 * k, tracked)}, {tracked})").alias("top")).first()["top"] or []
    candidates = [r["item"] for r in found if r["item"] is not None]
    known = F.col(col).isNull() | F.col(col).isin(candidates)
    bucket = F.pmod(F.xxhash64(col), F.lit(int(buckets)))
    counts = (df.groupBy(F.when(known, F.col(col)).alias(col), F.when(~known, bucket).alias("_bucket"))
                .agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True))
    exact = counts.where("_bucket IS NULL").select(col, "n")
    order = [F.desc("n"), F.asc_nulls_first(col)]
    least = exact.orderBy(*order).limit(k).agg(F.when(F.count(F.lit(1)) == k, F.min("n")).otherwise(F.lit(0)).alias("n")).first()["n"]
    open_buckets = [r["_bucket"] for r in counts.where(F.col("_bucket").isNotNull() & (F.col("n") >= least)).select("_bucket").collect()]
    if open_buckets:
        rest = df.where(~known & bucket.isin(open_buckets)).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
        exact = exact.unionByName(rest)
    return exact.orderBy(*order).limit(k)


def filtered_count(df: DataFrame, col: str, value, name: str = "n") -> DataFrame:
    """Rows where col == value (case-sensitive), as a one-row table."""
    return df.where(F.col(col) == F.lit(value)).agg(F.count(F.lit(1)).alias(name))


def global_means(df: DataFrame, cols: list[str], casts: dict | None = None) -> DataFrame:
    """A4/A5: means of several columns in one pass (`avg_<col>`)."""
    casts = casts or {}
    return df.agg(*[
        F.avg(safe_cast(c, casts[c]) if c in casts else F.col(c)).alias(f"avg_{c}") for c in cols])


# --------------------------------------------------------------------------- A6-A11, J2-J4

def valid_entity_rows(df: DataFrame, entity: str, rating: str, category: str) -> DataFrame:
    """(Player, Elo, Opening) rows where all three are present."""
    return (df.where(F.col(entity).isNotNull() & F.col(rating).isNotNull() & F.col(category).isNotNull())
              .select(F.col(entity).alias("Player"), F.col(rating).alias("Elo"),
                      F.col(category).alias("Opening")))


def entity_mean_count(df: DataFrame, entity: str, rating: str, category: str) -> DataFrame:
    """Mean rating and games per entity over complete rows."""
    rows = valid_entity_rows(df, entity, rating, category)
    return rows.groupBy("Player").agg(F.avg("Elo").alias("AvgElo"), F.count(F.lit(1)).alias("Games"))


def pair_frequency(df: DataFrame, entity: str, rating: str, category: str) -> DataFrame:
    """Count per (entity, category) over complete rows."""
    rows = valid_entity_rows(df, entity, rating, category)
    return rows.groupBy("Player", "Opening").agg(F.count(F.lit(1)).alias("freq_abs"))


def relative_frequency(df: DataFrame, entity: str, rating: str, category: str) -> DataFrame:
    """Share of each category in the entity's total.

    Totals come from a second partial aggregate joined back on the entity; a
    hot entity is split by AQE's skew-join handling instead of landing in one
    window partition.
    """
    pairs = pair_frequency(df, entity, rating, category)
    totals = pairs.groupBy("Player").agg(F.sum("freq_abs").alias("total"))
    return (pairs.join(totals, "Player")
                 .withColumn("freq_rel", F.col("freq_abs") / F.col("total")))


def _entropy_from_counts(n, s):
    """H = log2(N) - sum(c*log2 c)/N, the same as -sum(p log2 p) with p = c/N."""
    return F.log2(n) - s / n


def shannon_entropy(df: DataFrame, entity: str, rating: str, category: str) -> DataFrame:
    """Shannon entropy (bits) of each entity's category distribution.

    Two partial aggregates and no join: per (entity, category) counts, then per
    entity N = sum(c) and S = sum(c log2 c).
    """
    pairs = pair_frequency(df, entity, rating, category)
    per = pairs.groupBy("Player").agg(
        F.sum("freq_abs").alias("_n"),
        F.sum(F.col("freq_abs") * F.log2(F.col("freq_abs"))).alias("_s"))
    return per.select("Player", _entropy_from_counts(F.col("_n"), F.col("_s")).alias("ShannonEntropy"))


def entity_profile(df: DataFrame, entity: str, rating: str, category: str,
                   outcome: str, win_value: str = "White") -> DataFrame:
    """Mean rating, games, entropy and wins per entity in one plan.

    Wins are counted over all rows of the entity (also those with a missing
    rating or category); the other measures over complete rows only.  Entities
    without a complete row are dropped (inner-join semantics), and an entity
    with none won gets 0 wins.
    """
    return profile_from_state(profile_state(df, entity, rating, category, outcome, win_value))


def profile_state(df: DataFrame, entity: str, rating: str, category: str, outcome: str, win_value: str = "White") -> DataFrame:
    """A10/A11/J3/J4 as a state that batches can be added to: counts and sums per (entity, category).

    A row of a state: player, opening, complete games, their rating sum (null
    without one) and all wins.  Sums of whole ratings are exact, so a merged
    state equals the state of all rows.
    """
    return df.where(F.col(entity).isNotNull()).groupBy(F.col(entity).alias("Player"), F.col(category).alias("Opening")).agg(
        F.count_if(F.col(rating).isNotNull() & F.col(category).isNotNull()).alias("games"),
        F.sum(F.when(F.col(category).isNotNull(), F.col(rating))).alias("rating_sum"),
        F.sum(outcome_flag(outcome, win_value)).alias("wins"))


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of the rows of all ``states``; null openings stay a key of their own."""
    whole = states[0]
    for s in states[1:]:
        whole = whole.unionByName(s)
    return whole.groupBy("Player", "Opening").agg(
        F.sum("games").alias("games"), F.sum("rating_sum").alias("rating_sum"), F.sum("wins").alias("wins"))


def profile_from_state(state: DataFrame) -> DataFrame:
    """``entity_profile`` read from a state: one pass over players' openings, none over games."""
    per = state.groupBy("Player").agg(
        F.sum("games").alias("_n"), F.sum("rating_sum").alias("_e"), F.sum("wins").alias("_w"),
        F.sum(F.when(F.col("games") > 0, F.col("games") * F.log2(F.col("games")))).alias("_s"))
    return per.where(F.col("_n") > 0).select(
        "Player",
        (F.col("_e") / F.col("_n")).alias("AvgWhiteElo"),
        F.col("_n").alias("GamesAsWhite"),
        _entropy_from_counts(F.col("_n"), F.coalesce(F.col("_s"), F.lit(0.0))).alias("ShannonEntropy"),
        F.coalesce(F.col("_w"), F.lit(0)).cast("bigint").alias("WinsAsWhite"))


# --------------------------------------------------------------------------- A12, A13

def group_outcome_profile(df: DataFrame, group: str, outcome: str, length: str) -> DataFrame:
    """A12 (P6-P8): games, mean length and outcome shares per trimmed group."""
    return (df.withColumn(group, F.trim(F.col(group)))
              .groupBy(group).agg(
                  F.count(F.lit(1)).alias("games"),
                  F.avg(safe_cast(length, "int")).alias("avg_moves"),
                  F.avg(outcome_flag(outcome, "White")).alias("prop_white_win"),
                  F.avg(outcome_flag(outcome, "Black")).alias("prop_black_win"),
                  F.avg(outcome_flag(outcome, "Draw")).alias("prop_draw")))


def conditional_means(df: DataFrame, label: str | list[str], cols: list[str]) -> DataFrame:
    """Mean of each column per label value (or combination of values)."""
    return df.groupBy(*([label] if isinstance(label, str) else label)).agg(*[F.avg(c).alias(f"avg_{c}") for c in cols])


# --------------------------------------------------------------------------- A18-A21

def quantile_bins(df: DataFrame, col: str, labels: list[str], name: str = "bin") -> DataFrame:
    """Equal-frequency bins, right-closed, lowest edge included.

    Edges are exact quantiles, found by counting where a double holds the
    values; the handful of edges is then inlined as literals.
    """
    k = len(labels)
    probs = [i / k for i in range(k + 1)]
    if isinstance(df.schema[col].dataType, EXACT):
        edges = next(iter(selected_quantiles(df, col, probs)), None)
    else:
        edges = exact_quantiles(df, col, probs).first()
    if edges is None or edges["q0"] is None:
        return df.withColumn(name, F.lit(None).cast("string"))
    e = [edges[f"q{i}"] for i in range(k + 1)]
    expr = F.when(F.col(col).isNull(), F.lit(None).cast("string"))
    expr = expr.when((F.col(col) >= F.lit(e[0])) & (F.col(col) <= F.lit(e[1])), F.lit(labels[0]))
    for i in range(1, k):
        expr = expr.when((F.col(col) > F.lit(e[i])) & (F.col(col) <= F.lit(e[i + 1])), F.lit(labels[i]))
    return df.withColumn(name, expr)


def bin_summary(df: DataFrame, bin_col: str, value: str) -> DataFrame:
    """The numbers a box plot draws per bin: quartiles, whiskers, outliers.

    Whiskers are the most extreme values within 1.5 IQR of the box.
    """
    probs = [0.25, 0.5, 0.75]
    if isinstance(df.schema[value].dataType, EXACT):
        kind = df.schema[bin_col].dataType.simpleString()
        q = inlined(df, selected_quantiles(df, value, probs, [bin_col]), f"`{bin_col}`:{kind},q0:double,q1:double,q2:double")
    else:
        q = exact_quantiles(df, value, probs, [bin_col])
    q = q.select(bin_col, F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    j = df.where(F.col(value).isNotNull()).join(q, bin_col)
    iqr = F.col("q3") - F.col("q1")
    lo_fence, hi_fence = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    inside = (F.col(value) >= lo_fence) & (F.col(value) <= hi_fence)
    return j.groupBy(bin_col, "q1", "median", "q3").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"))


def histogram(df: DataFrame, col: str, bins: int = 40) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed on the right."""
    mm = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo, hi = mm["lo"], mm["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, n bigint")
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return (df.where(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
              .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
                      (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"), "n"))


def sampled_category_count(df: DataFrame, key: str, col: str, fraction: float = 0.1,
                           seed: int = 42) -> DataFrame:
    """Category counts over a reproducible key-hash sample."""
    return category_count(df.where(hash_unit(key, seed) < F.lit(fraction)), col)


def scatter_sample(df: DataFrame, key: str, cols: list[str], fraction: float = 0.1,
                   seed: int = 42) -> DataFrame:
    """V3: reproducible sample of a few columns for a scatter plot."""
    return df.where(hash_unit(key, seed) < F.lit(fraction)).select(key, *cols)
