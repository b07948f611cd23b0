"""Registered queries, group 11: file sources and sinks.

Each query writes test-table rows to a fresh folder under the session's
checkpoint directory, then reads them back through the operator under test;
the SQL oracle computes the expected rows straight from the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pawnshop import sources as S
from pawnshop.plans import adapters as ad
from pawnshop.plans.common import R, rounded
from pawnshop.schema import GAME_COLUMNS
from pawnshop.session import scratch_path

Q: dict = {}
SQL: dict = {}
G = ad.with_ctes(ad.GAMES_SQL)


def register(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _games_csv(spark, d, header: bool, extra_col: bool = True) -> str:
    """Games as CSV text files in game order (16 columns + game_id [+ a 17th]): a file for each range of the sort,
    as many as the games' bytes ask for."""
    g = ad.games(spark, d)
    cols = [F.col(c).cast("string").alias(c) for c in GAME_COLUMNS] + [F.col("game_id").cast("string")]
    if extra_col:
        cols.append(F.lit("extra").alias("c18"))
    out = scratch_path(spark, "games-csv")
    g.orderBy("game_id").select(*cols).write.options(**S.files.CSV_OPTS).option("header", header).csv(out)
    return out


_GAMES_OUT = f"SELECT game_id, WhiteName, Winner, Opening, TimeControl, {R('WhiteElo')} AS WhiteElo FROM games"


def _games_back(df):
    return rounded(df.select(F.col("game_id").cast("bigint").alias("game_id"),
                             "WhiteName", "Winner", "Opening", "TimeControl",
                             F.col("WhiteElo").try_cast("double").alias("WhiteElo")))


@register("csv_positional_schema", G + "\n" + _GAMES_OUT)
def q_csv_positional(spark, d):
    path = _games_csv(spark, d, header=False)
    df = S.csv_positional_schema(spark, path, GAME_COLUMNS + ["game_id"])
    return _games_back(df)


@register("drop_header_rows", G + "\n" + _GAMES_OUT)
def q_drop_header(spark, d):
    path = _games_csv(spark, d, header=True)
    df = S.csv_positional_schema(spark, path, GAME_COLUMNS + ["game_id"])  # header lines read as data
    return _games_back(S.drop_header_rows(df, "Winner"))


@register("read_games", G + "\n" + _GAMES_OUT)
def q_read_games(spark, d):
    from pyspark.sql import types as T
    path = _games_csv(spark, d, header=True, extra_col=False)
    df = S.read_games(spark, path, header=True, raw=True, extra_fields=[T.StructField("game_id", T.LongType())])
    return _games_back(df)


_TYPED = ["WhiteElo", "BlackElo", "WhiteName", "BlackName", "Winner", "Day", "Month", "Year", "InitialTime", "Increment", "Number_of_Moves"]
_TYPED_OUT = ("SELECT game_id, " + ", ".join(f"{R(c)} AS {c}" if c.endswith("Elo") else c for c in _TYPED) + " FROM games")


def _typed_back(df):
    return rounded(df.select("game_id", *_TYPED))


@register("read_games_typed", G + "\n" + _TYPED_OUT)
def q_read_games_typed(spark, d):
    """Typed columns by the declared schema, files chosen by a glob."""
    from pyspark.sql import types as T
    path = _games_csv(spark, d, header=True, extra_col=False)
    return _typed_back(S.read_games(spark, path + "/part-*.csv", header=True, extra_fields=[T.StructField("game_id", T.LongType())]))


@register("read_games_file", G + "\n" + _TYPED_OUT)
def q_read_games_file(spark, d):
    """The same read by the names of the files; one file would be written by one task, whatever its size."""
    from pyspark.sql import types as T
    path = _games_csv(spark, d, header=True, extra_col=False)
    files = sorted(spark.read.text(path).inputFiles())
    return _typed_back(S.read_games(spark, files, header=True, extra_fields=[T.StructField("game_id", T.LongType())]))


def _docs_csv(spark, d) -> str:
    out = scratch_path(spark, "docs-csv")
    (ad.table(spark, d, "documents").orderBy("doc_id").select("text", F.col("doc_id").cast("string"))
       .write.options(**S.files.CSV_OPTS).option("header", False).csv(out))
    return out


@register("csv_multiline", "SELECT text AS PGN FROM documents")
def q_csv_multiline(spark, d):
    return S.csv_multiline(spark, _docs_csv(spark, d))


@register("align_by_ordinal", G + """,
gl AS (SELECT game_id, row_number() OVER (ORDER BY game_id) - 1 AS ordinal FROM games),
dl AS (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS ordinal FROM documents)
SELECT coalesce(gl.ordinal, dl.ordinal) AS ordinal, gl.game_id, dl.text AS PGN
FROM gl FULL JOIN dl ON gl.ordinal = dl.ordinal""")
def q_align_by_ordinal(spark, d):
    left = S.with_source(S.csv_positional_schema(spark, _games_csv(spark, d, header=False),
                                                 GAME_COLUMNS + ["game_id"]))
    right = S.csv_multiline(spark, _docs_csv(spark, d), keep_source=True)
    out = S.align_by_ordinal(left.select(F.col("game_id").cast("bigint").alias("game_id"), "_file", "_block"),
                             right)
    return out.select("ordinal", "game_id", "PGN")


@register("ordinal_report", G + """,
n AS (SELECT (SELECT count(*) FROM games) AS g, (SELECT count(*) FROM documents) AS t)
SELECT least(g, t) AS matched, greatest(g - t, 0) AS left_only, greatest(t - g, 0) AS right_only FROM n""")
def q_ordinal_report(spark, d):
    left = S.with_source(S.csv_positional_schema(spark, _games_csv(spark, d, header=True),
                                                 GAME_COLUMNS + ["game_id"]))
    left = S.drop_header_rows(left, "Winner").select("game_id", "_file", "_block")
    right = S.csv_multiline(spark, _docs_csv(spark, d), keep_source=True)
    return S.alignment_report(S.with_ordinal(left), S.with_ordinal(right), "ordinal")


@register("align_by_key", ad.with_ctes(ad.GAMES_SQL, ad.MOVETEXT_SQL) + """
SELECT g.game_id, g.Winner, CAST(length(m.movetext) AS INTEGER) AS n_chars FROM games g JOIN movetext m ON g.game_id = m.game_id""")
def q_align_by_key(spark, d):
    g = ad.games(spark, d).select("game_id", "Winner")
    m = ad.movetext(spark, d)
    return S.align_by_key(g, m, "game_id").select("game_id", "Winner", F.length("movetext").alias("n_chars"))


BUCKETS = 64


def _bucketed(spark, df, what: str) -> str:
    """Written under a fresh name and place; returns the name."""
    path = scratch_path(spark, what)
    name = "pawnshop_" + path.rpartition("/")[2].replace("-", "_")
    S.write_bucketed(df, name, ["game_id"], BUCKETS, path)
    return name


@register("align_bucketed", ad.with_ctes(ad.GAMES_SQL, ad.MOVETEXT_SQL) + """
SELECT g.game_id, g.Winner, CAST(length(m.movetext) AS INTEGER) AS n_chars FROM games g JOIN movetext m ON g.game_id = m.game_id""")
def q_align_bucketed(spark, d):
    """Both tables bucketed and sorted by the game once; the alignment then shuffles nothing."""
    games = _bucketed(spark, ad.games(spark, d).select("game_id", "Winner"), "games")
    moves = _bucketed(spark, ad.movetext(spark, d), "moves")
    return S.align_bucketed(spark, games, moves, "game_id").select("game_id", "Winner", F.length("movetext").alias("n_chars"))


@register("alignment_report", ad.with_ctes(ad.GAMES_SQL, ad.MOVETEXT_SQL) + """
SELECT count(*) FILTER (WHERE g.game_id IS NOT NULL AND m.game_id IS NOT NULL) AS matched,
       count(*) FILTER (WHERE m.game_id IS NULL) AS left_only,
       count(*) FILTER (WHERE g.game_id IS NULL) AS right_only
FROM games g FULL JOIN movetext m ON g.game_id = m.game_id""")
def q_alignment_report(spark, d):
    return S.alignment_report(ad.games(spark, d), ad.movetext(spark, d), "game_id")


@register("parquet_roundtrip", G + f"""
SELECT game_id, {R('WhiteElo')} AS WhiteElo FROM games WHERE Winner = 'White'""")
def q_parquet_roundtrip(spark, d):
    path = scratch_path(spark, "games-parquet")
    S.write_parquet(ad.games(spark, d), path, partition_by=["Winner"])
    back = S.read_parquet(spark, path).where(F.col("Winner") == "White").select("game_id", "WhiteElo")
    return rounded(back)
