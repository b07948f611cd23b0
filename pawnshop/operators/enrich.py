"""The enriched game table: metadata, label, length and the features of every snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pawnshop.functions.scalar import binary_label
from pawnshop.operators import movefold as M
from pawnshop.operators.moves import DEFAULT_PHASES
from pawnshop.schema import FEATURE_KEYS
from pawnshop.session import scratch_path


def folded_games(games: DataFrame, text: str, phases=DEFAULT_PHASES) -> DataFrame:
    """``movefold.folded`` written once to the shared folder: the texts are read once, whatever is made of them."""
    spark = games.sparkSession
    path = scratch_path(spark, "folded")
    narrow = M.folded(games, text, phases)
    narrow.write.parquet(path)
    return spark.read.schema(narrow.schema).parquet(path)


def enriched_games(games: DataFrame, key: str, text: str, winner: str, phases=DEFAULT_PHASES) -> DataFrame:
    """One row per game and snapshot: the columns of ``games`` without the text,
    ``label_white_win``, ``total_moves`` and the position features.

    ``key`` must be unique.  Write it once, partitioned by phase, and let every
    fit and profile read the columns and the phase it needs.
    """
    return enriched(folded_games(games, text, phases), key, winner)


def enriched(games: DataFrame, key: str, winner: str) -> DataFrame:
    """``enriched_games`` from a folded table: only a few numbers a game are joined, and the features are worked out
    after that."""
    length = games.select(key, "total_moves")
    about = games.drop("snaps", "total_moves").withColumn("label_white_win", binary_label(winner)).join(length, key)
    rest = [c for c in about.columns if c != key]
    x = M.snapshot_features(M.snapshot_rows(games, [key]).join(about, key), [key, *rest])
    return x.select(key, "phase", *FEATURE_KEYS, *rest)
