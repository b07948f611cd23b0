"""Column expressions (no Python UDFs): everything stays in whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def binary_label(winner) -> Column:
    """P5: outcome with surrounding whitespace (any kind) removed, compared
    case-insensitively -> 1 (white), 0 (black/draw), else null."""
    w = F.lower(F.regexp_replace(_c(winner), r"^\s+|\s+$", ""))
    return (F.when(w == "white", F.lit(1))
            .when(w.isin("black", "draw"), F.lit(0))
            .otherwise(F.lit(None).cast("int")))


def outcome_flag(winner, value: str) -> Column:
    """Case-sensitive 0/1 flag; null compares false -> 0."""
    return F.when(_c(winner) == F.lit(value), F.lit(1)).otherwise(F.lit(0))


def safe_cast(col, to: str = "int") -> Column:
    """Text that does not parse becomes null (ANSI mode would raise on cast)."""
    return F.expr(f"try_cast({col} as {to})") if isinstance(col, str) else _c(col).try_cast(to)


def hash_unit(key, seed: int = 42, purpose: str = "sample") -> Column:
    """Deterministic uniform [0, 1) number per key: md5("purpose:seed:key") first 32 bits / 2^32.

    ``purpose`` separates the streams: rows kept by a sample or a balance are
    still spread evenly over a split or a shuffle with the same seed.  Unlike ``rand``/``sample`` it does not depend on partitioning, so samples and
    splits are reproducible on any cluster (and in any SQL engine with md5).
    """
    text = F.concat(F.lit(f"{purpose}:{seed}:"), _c(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def text_quality(col, pattern: str = r"^\s*1\.") -> Column:
    """Not null, non-empty and matching the movetext start pattern."""
    c = _c(col)
    return c.isNotNull() & (F.length(c) > 0) & c.rlike(pattern)


def clean_round(col, digits: int = 6) -> Column:
    """Round and turn -0.0 into 0.0 (stable output for hashing and comparison)."""
    return F.round(_c(col), digits) + F.lit(0.0)
