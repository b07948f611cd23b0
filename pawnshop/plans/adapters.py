"""Stand-in inputs built from the driver's star-schema tables.

The test tables hold orders, customers and documents, not chess.  These views
only give rows in the schema the operators expect (games, boards, scores,
movetext); all analysis happens in the operators, which know nothing of how
the rows were made.  Each view has a DuckDB SQL twin (``*_SQL``) so the oracle
queries read exactly the same input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pawnshop.operators.enrich import folded_games
from pawnshop.operators.moves import DEFAULT_PHASES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------- games

def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: the 16 game columns plus ``game_id``.

    White = the ordering customer, Black = the first line's supplier, Opening =
    the brand of the first line's part, Winner from the order status
    (F/O/P -> White/Black/Draw), Number_of_Moves = line count as text.
    """
    first = (table(spark, sf_dir, "lineitem")
             .groupBy("l_orderkey")
             .agg(F.min("l_partkey").alias("first_part"), F.min("l_suppkey").alias("first_supp"),
                  F.count(F.lit(1)).alias("n_lines")))
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    p = table(spark, sf_dir, "part")
    s = table(spark, sf_dir, "supplier")
    g = (o.join(c, o.o_custkey == c.c_custkey)
          .join(first, o.o_orderkey == first.l_orderkey, "left")
          .join(p, F.col("first_part") == p.p_partkey, "left")
          .join(s, F.col("first_supp") == s.s_suppkey, "left"))
    return g.select(
        F.col("o_orderkey").alias("game_id"),
        F.col("c_acctbal").alias("WhiteElo"),
        F.col("s_acctbal").alias("BlackElo"),
        F.col("c_name").alias("WhiteName"),
        F.col("s_name").alias("BlackName"),
        F.when(F.col("o_orderstatus") == "F", "White").when(F.col("o_orderstatus") == "O", "Black")
         .when(F.col("o_orderstatus") == "P", "Draw").alias("Winner"),
        F.col("c_mktsegment").alias("Termination"),
        F.col("p_name").alias("Site"),
        F.dayofmonth("o_orderdate").alias("Day"),
        F.month("o_orderdate").alias("Month"),
        F.year("o_orderdate").alias("Year"),
        F.col("p_size").alias("InitialTime"),
        F.col("n_lines").cast("int").alias("Increment"),
        F.col("o_orderpriority").alias("TimeControl"),
        F.col("p_brand").alias("Opening"),
        F.col("p_type").alias("ECO"),
        F.col("n_lines").cast("string").alias("Number_of_Moves"),
    )


GAMES_SQL = """
first_line AS (
  SELECT l_orderkey, min(l_partkey) AS first_part, min(l_suppkey) AS first_supp, count(*) AS n_lines
  FROM lineitem GROUP BY l_orderkey),
games AS (
  SELECT o.o_orderkey AS game_id, c.c_acctbal AS WhiteElo, s.s_acctbal AS BlackElo,
         c.c_name AS WhiteName, s.s_name AS BlackName,
         CASE o.o_orderstatus WHEN 'F' THEN 'White' WHEN 'O' THEN 'Black' WHEN 'P' THEN 'Draw' END AS Winner,
         c.c_mktsegment AS Termination, p.p_name AS Site,
         CAST(day(o.o_orderdate) AS INTEGER) AS Day, CAST(month(o.o_orderdate) AS INTEGER) AS Month,
         CAST(year(o.o_orderdate) AS INTEGER) AS Year, p.p_size AS InitialTime,
         CAST(f.n_lines AS INTEGER) AS Increment, o.o_orderpriority AS TimeControl,
         p.p_brand AS Opening, p.p_type AS ECO, CAST(f.n_lines AS VARCHAR) AS Number_of_Moves
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN first_line f ON o.o_orderkey = f.l_orderkey
  LEFT JOIN part p ON f.first_part = p.p_partkey
  LEFT JOIN supplier s ON f.first_supp = s.s_suppkey)"""


# --------------------------------------------------------------------------- scores

def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(game_id, label, prob1): label = order fulfilled, score = price / max price."""
    o = table(spark, sf_dir, "orders")
    top = o.select(F.max("o_totalprice")).scalar()
    return o.select(F.col("o_orderkey").alias("game_id"),
                    F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("label"),
                    (F.col("o_totalprice") / top).alias("prob1"))


SCORES_SQL = """
scores AS (
  SELECT o_orderkey AS game_id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
         o_totalprice / (SELECT max(o_totalprice) FROM orders) AS prob1
  FROM orders)"""


# --------------------------------------------------------------------------- boards

PIECE_CODES = "PNBRQKpnbrqk"


def boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece placements (board_id, file, rank, piece): one board per customer,
    square = part key mod 64, piece letter from the supplier key, one piece per
    square (the smallest code).
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    sq = (li.join(o, li.l_orderkey == o.o_orderkey)
            .groupBy(F.col("o_custkey").alias("board_id"), (F.col("l_partkey") % 64).cast("int").alias("square"))
            .agg(F.min(F.col("l_suppkey") % 12).cast("int").alias("code")))
    return sq.select("board_id", (F.col("square") % 8).alias("file"),
                     (F.col("square") / 8).cast("int").alias("rank"),
                     F.substring(F.lit(PIECE_CODES), F.col("code") + 1, 1).alias("piece"))


BOARDS_SQL = """
board_squares AS (
  SELECT o.o_custkey AS board_id, CAST(l.l_partkey % 64 AS INTEGER) AS square,
         CAST(min(l.l_suppkey % 12) AS INTEGER) AS code
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2),
pieces AS (
  SELECT board_id, square % 8 AS file, CAST(square // 8 AS INTEGER) AS rank,
         substr('PNBRQKpnbrqk', code + 1, 1) AS piece
  FROM board_squares)"""


# --------------------------------------------------------------------------- movetext

def _token_expr(w: str, i: str) -> str:
    """SAN-shaped token for word ``w`` at 0-based position ``i`` (shared by both dialects)."""
    a, z, n = f"ascii({w})", f"ascii(right({w}, 1))", f"length({w})"
    k = f"(({a} + {n}) % 16)"
    cap = f"({a} % 5 = 0)"
    file_ = f"chr(97 + {z} % 8)"
    tok = (f"CASE WHEN {k} < 8 THEN "
           f"(CASE WHEN {cap} THEN chr(97 + CASE WHEN {z} % 8 = 7 THEN 6 ELSE {z} % 8 + 1 END) || 'x' ELSE '' END)"
           f" || {file_} || CAST(3 + ({a} + {z}) % 4 AS STRING) "
           f"WHEN {k} < 15 THEN substr('NNBBRQK', {k} - 7, 1) || (CASE WHEN {cap} THEN 'x' ELSE '' END)"
           f" || {file_} || CAST(1 + ({a} + {z}) % 8 AS STRING) "
           f"WHEN {z} % 2 = 0 THEN 'O-O' ELSE 'O-O-O' END"
           f" || (CASE WHEN {n} % 11 = 0 THEN '+' ELSE '' END)")
    return (f"(CASE WHEN {i} % 2 = 0 THEN CAST(CAST(floor({i} / 2) AS INT) + 1 AS STRING) || '. ' ELSE '' END)"
            f" || {tok}"
            f" || (CASE WHEN contains({w}, ',') THEN ' {{' || replace(replace({w}, '{{', ''), '}}', '') || '}}' ELSE '' END)"
            f" || (CASE WHEN right({w}, 1) = '.' THEN ' (' || chr(97 + {a} % 8) || '4 ' || chr(97 + {a} % 8) || '5)' ELSE '' END)"
            f" || (CASE WHEN {n} = 1 THEN ' $1' ELSE '' END)")


_RESULT = "CASE lang WHEN 'en' THEN '1-0' WHEN 'de' THEN '0-1' WHEN 'fr' THEN '1/2-1/2' ELSE '*' END"
_HEADER = "CASE WHEN source = 'src0' THEN '[Event \"' || source || '\"] ' ELSE '' END"


def _half_move(x: Column, i: Column) -> Column:
    """``_token_expr`` of a word (w, a: its first character, z: its last, n: its length): each half-move is looked up
    in a list of all that there are."""
    files = "abcdefgh"
    pawns = [("" if not cap else files[6 if z == 7 else z + 1] + "x") + f"{files[z]}{3 + r}" for cap in (0, 1) for z in range(8) for r in range(4)]
    pieces = [f"{p}{'x' * cap}{files[z]}{1 + r}" for p in "NNBBRQK" for cap in (0, 1) for z in range(8) for r in range(8)]
    a, z, w, n = x["a"], x["z"], x["w"], x["n"]
    k, cap = (a + n) % 16, (a % 5 == 0).cast("int")
    at = (F.when(k < 8, (cap * 8 + z % 8) * 4 + (a + z) % 4)
          .when(k < 15, len(pawns) + (((k - 8) * 2 + cap) * 8 + z % 8) * 8 + (a + z) % 8).otherwise(len(pawns) + len(pieces) + z % 2))
    token = F.get(F.array(*map(F.lit, [*pawns, *pieces, "O-O", "O-O-O"])), at)
    push = F.get(F.array(*[F.lit(f" ({f}4 {f}5)") for f in files]), a % 8)
    return F.concat(F.when(i % 2 == 0, F.concat((F.floor(i / 2) + 1).cast("string"), F.lit(". "))).otherwise(""), token, F.when(n % 11 == 0, "+").otherwise(""),
                    F.when(w.contains(","), F.concat(F.lit(" {"), F.translate(w, "{}", ""), F.lit("}"))).otherwise(""),
                    F.when(z == ord("."), push).otherwise(""), F.when(n == 1, " $1").otherwise(""))


def spread(df: DataFrame) -> DataFrame:
    """``df``'s rows over all cores where it has fewer files than these: work within
    rows is not shuffled later, and a file of one row group is read by one task."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def movetext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(game_id, movetext): every word of a document becomes one SAN-shaped
    half-move, with move numbers, comments, variations, annotations, a result
    token and, for one source, a header tag.  Whole texts, no prefixes.
    """
    words = r"filter(split(text, '\\s+'), w -> w != '')"
    told = F.expr(f"transform({words}, w -> named_struct('w', w, 'a', ascii(w), 'z', ascii(right(w, 1)), 'n', length(w)))")
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return docs.select(
        F.col("doc_id").alias("game_id"),
        F.concat(F.expr(_HEADER), F.array_join(F.transform(told, _half_move), " "), F.lit(" "), F.expr(_RESULT)).alias("movetext"))


def _winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    winner = F.expr("CASE lang WHEN 'en' THEN 'White' WHEN 'de' THEN 'Black' WHEN 'fr' THEN 'Draw' END")
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("game_id"), winner.alias("Winner"))


def chess_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(game_id, movetext, Winner): the movetext view plus the outcome its
    result token states (unknown '*' results stay null)."""
    return movetext(spark, sf_dir).join(_winners(spark, sf_dir), "game_id")


def chess_folded(spark: SparkSession, sf_dir: str, phases=DEFAULT_PHASES) -> DataFrame:
    """``folded_games`` of ``chess_games``: the texts are folded where they are read, and what is joined is narrow."""
    return folded_games(movetext(spark, sf_dir), "movetext", phases).join(_winners(spark, sf_dir), "game_id")


_WORDS_SQL = r"list_filter(string_split_regex(text, '\s+'), lambda w: w <> '')"
MOVETEXT_SQL = f"""
movetext AS (
  SELECT doc_id AS game_id,
         {_HEADER} || array_to_string(list_transform({_WORDS_SQL}, lambda w, i: {_token_expr('w', '(i - 1)')}), ' ')
         || ' ' || {_RESULT} AS movetext
  FROM documents)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)
