"""Row selection and reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def complete_cases(df: DataFrame, label: str, features: list[str], keep: list[str] = (),
                   labels=(0, 1)) -> DataFrame:
    """Keep + label + features, rows with no null and a known label."""
    cols = [*keep, label, *features]
    return df.select(*cols).dropna().where(F.col(label).isin(*labels))


def expand_struct(df: DataFrame, struct_col: str, prefix: str = "") -> DataFrame:
    """Replace a struct column by its fields (optionally prefixed) in ONE select."""
    fields = df.schema[struct_col].dataType.fieldNames()
    others = [F.col(f"`{c}`") for c in df.columns if c != struct_col]
    return df.select(*others, *[F.col(f"`{struct_col}`.`{f}`").alias(f"{prefix}{f}") for f in fields])


def side_differences(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """``name = white - black`` for each (white, black) column pair."""
    return df.select("*", *[(F.col(w) - F.col(b)).alias(n) for n, (w, b) in pairs.items()])


def phase_pivot(long: DataFrame, keys: list[str], phase_col: str, features: list[str],
                prefixes: dict[str, str]) -> DataFrame:
    """Long (key, phase, features...) -> one wide row per key with a prefix per phase.

    A single grouped aggregation with the phase values listed, so Spark does
    not run a distinct pass to discover them.  Each (key, phase) is one row, so
    ``first`` is exact.
    """
    aggs = [F.first(F.when(F.col(phase_col) == F.lit(ph), F.col(f)), ignorenulls=True).alias(f"{pre}{f}")
            for ph, pre in prefixes.items() for f in features]
    return long.groupBy(*keys).agg(*aggs)
