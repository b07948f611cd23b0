"""Helpers shared by the query catalog and its SQL oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

from pawnshop.functions.scalar import clean_round

DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every floating column (and clear -0.0) so results compare exactly."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(clean_round(f.name, digits).alias(f.name))
        else:
            cols.append(f"`{f.name}`")
    return df.select(*cols)


def R(expr: str, digits: int = DIGITS) -> str:
    """SQL twin of ``rounded`` for one expression."""
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + CAST(0 AS DOUBLE))"
