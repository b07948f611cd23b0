"""Registered queries, group 8: position features over the boards view."""

from __future__ import annotations

from pawnshop.operators import board as B
from pawnshop.operators.reshape import side_differences
from pawnshop.plans import adapters as ad
from pawnshop.plans.common import R, rounded
from pawnshop.schema import FEATURE_KEYS

Q: dict = {}
SQL: dict = {}
K = ["board_id"]


def register(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _pieces(spark, d):
    return ad.boards(spark, d)


# ----------------------------------------------------------------- SQL twin of the features

_PC = """pc AS (SELECT board_id, file, rank, CASE WHEN piece = upper(piece) THEN 'w' ELSE 'b' END AS side,
               upper(piece) AS kind FROM pieces),
pw AS (SELECT * FROM pc WHERE kind = 'P'),
pf AS (SELECT board_id, side, file, count(*) AS n FROM pw GROUP BY board_id, side, file),
kg AS (SELECT board_id, side, max(rank * 8 + file) AS sq FROM pc WHERE kind = 'K' GROUP BY board_id, side),
sides AS (SELECT DISTINCT board_id, t.side FROM pieces, (VALUES ('w'), ('b')) t(side))"""

_SAME = "p.board_id = s.board_id AND p.side = s.side"
_PER_SIDE = f"""per_side AS (
 SELECT s.board_id, s.side,
  coalesce((SELECT sum(CASE kind WHEN 'P' THEN 1 WHEN 'N' THEN 3 WHEN 'B' THEN 3 WHEN 'R' THEN 5
            WHEN 'Q' THEN 9 ELSE 0 END) FROM pc p WHERE {_SAME}), 0) AS material,
  (SELECT count(*) FROM pw p WHERE {_SAME}) AS pawns,
  (SELECT count(*) FROM pf p WHERE {_SAME} AND p.n >= 2) AS doubled_pawns,
  (SELECT count(*) FROM pw p WHERE {_SAME} AND NOT EXISTS (SELECT 1 FROM pw q
     WHERE q.board_id = p.board_id AND q.side = p.side AND abs(q.file - p.file) = 1)) AS isolated_pawns,
  (SELECT count(*) FROM pw p WHERE {_SAME} AND NOT EXISTS (SELECT 1 FROM pw e
     WHERE e.board_id = p.board_id AND e.side <> p.side AND abs(e.file - p.file) <= 1
       AND CASE WHEN p.side = 'w' THEN e.rank > p.rank ELSE e.rank < p.rank END)) AS passed_pawns,
  (SELECT count(*) FROM pw p WHERE {_SAME} AND CASE WHEN p.side = 'w' THEN p.rank >= 4 ELSE p.rank <= 3 END)
     AS advanced_pawns,
  (SELECT count(*) FROM pf p WHERE {_SAME} AND NOT EXISTS (SELECT 1 FROM pf q
     WHERE q.board_id = p.board_id AND q.side = p.side AND q.file = p.file - 1)) AS pawn_islands,
  coalesce((SELECT count(*) FROM pw p JOIN kg k ON p.board_id = k.board_id AND p.side = k.side
     WHERE {_SAME} AND abs(p.file - k.sq % 8) <= 1
       AND CASE WHEN p.side = 'w' THEN p.rank - k.sq // 8 IN (1, 2) ELSE k.sq // 8 - p.rank IN (1, 2) END), 0)
     AS king_pawn_shield,
  coalesce((SELECT count(*) FROM pw p JOIN kg k ON p.board_id = k.board_id AND p.side = k.side
     WHERE {_SAME} AND greatest(abs(p.file - k.sq % 8), abs(p.rank - k.sq // 8)) <= 2), 0) AS king_pawns_near,
  coalesce((SELECT avg(file) FROM pw p WHERE {_SAME}), 0) AS pawn_file_mean,
  coalesce((SELECT stddev_pop(file) FROM pw p WHERE {_SAME}), 0) AS pawn_file_std,
  coalesce((SELECT avg(rank) FROM pw p WHERE {_SAME}), 0) AS pawn_rank_mean,
  coalesce((SELECT stddev_pop(rank) FROM pw p WHERE {_SAME}), 0) AS pawn_rank_std,
  coalesce((SELECT max(file) - min(file) FROM pw p WHERE {_SAME}), 0) AS pawn_file_span,
  coalesce((SELECT max(rank) - min(rank) FROM pw p WHERE {_SAME}), 0) AS pawn_rank_span
 FROM sides s)"""


def _patterns() -> list[tuple]:
    """(color, kind, direction, step, files, ranks, mode, start rank or -1) of every way a piece can go."""
    straight, slant = [(0, 1), (0, -1), (1, 0), (-1, 0)], [(1, 1), (1, -1), (-1, 1), (-1, -1)]
    jumps = [(a, b) for a in (-2, -1, 1, 2) for b in (-2, -1, 1, 2) if abs(a) != abs(b)]
    out = []
    for color, fwd, start in (("w", 1, 1), ("b", -1, 6)):
        for kind, ways, far in (("R", straight, 8), ("B", slant, 8), ("Q", straight + slant, 8), ("K", straight + slant, 2), ("N", jumps, 2)):
            out += [(color, kind, d, s, a * s, b * s, "ray", -1) for d, (a, b) in enumerate(ways) for s in range(1, far)]
        out += [(color, "P", 0, 1, 0, fwd, "push", -1), (color, "P", 0, 2, 0, 2 * fwd, "push", start),
                (color, "P", 1, 1, -1, fwd, "hit", -1), (color, "P", 2, 1, 1, fwd, "hit", -1)]
    return out


def _pattern_values() -> str:
    rows = ", ".join(f"('{c}', '{k}', {d}, {s}, {a}, {b}, '{m}', {st})" for c, k, d, s, a, b, m, st in _patterns())
    return f"pat AS (SELECT * FROM (VALUES {rows}) t(color, kind, dir, step, df, dr, mode, start))"


_REACH = _pattern_values() + """,
cand AS (SELECT p.board_id, p.file, p.rank, p.side, p.kind, t.dir, t.step, t.mode,
                p.file + t.df AS tf, p.rank + t.dr AS tr
         FROM pc p JOIN pat t ON p.side = t.color AND p.kind = t.kind
         WHERE p.file + t.df BETWEEN 0 AND 7 AND p.rank + t.dr BETWEEN 0 AND 7
           AND (t.start < 0 OR t.start = p.rank)),
occ AS (SELECT c.*, o.side AS occ_side FROM cand c
        LEFT JOIN pc o ON o.board_id = c.board_id AND o.file = c.tf AND o.rank = c.tr),
reach_ok AS (SELECT * FROM occ c WHERE NOT EXISTS (
    SELECT 1 FROM occ b WHERE b.board_id = c.board_id AND b.file = c.file AND b.rank = c.rank
      AND b.kind = c.kind AND b.dir = c.dir AND b.mode = c.mode AND b.step < c.step AND b.occ_side IS NOT NULL)
  AND CASE c.mode WHEN 'hit' THEN c.occ_side IS NOT NULL AND c.occ_side <> c.side
                  WHEN 'push' THEN c.occ_side IS NULL
                  ELSE c.occ_side IS NULL OR c.occ_side <> c.side END),
reach AS (SELECT b.board_id,
    CAST(count(r.side) FILTER (WHERE r.side = 'w') AS DOUBLE) AS white_piece_reach,
    CAST(count(r.side) FILTER (WHERE r.side = 'b') AS DOUBLE) AS black_piece_reach
  FROM (SELECT DISTINCT board_id FROM pieces) b LEFT JOIN reach_ok r ON r.board_id = b.board_id
  GROUP BY b.board_id)"""

_BASE = ad.with_ctes(ad.BOARDS_SQL, _PC, _PER_SIDE)
_SIDE_COLS = ["pawns", "doubled_pawns", "isolated_pawns", "passed_pawns", "advanced_pawns", "pawn_islands",
              "king_pawn_shield", "king_pawns_near", "pawn_file_mean", "pawn_file_std", "pawn_rank_mean",
              "pawn_rank_std", "pawn_file_span", "pawn_rank_span"]
_DIFF_SQL = {"pawns_diff": "pawns", "passed_pawns_diff": "passed_pawns", "advanced_pawns_diff": "advanced_pawns",
             "isolated_pawns_diff": "isolated_pawns", "pawn_islands_diff": "pawn_islands",
             "king_pawn_shield_diff": "king_pawn_shield", "king_pawns_near_diff": "king_pawns_near",
             "pawn_file_std_diff": "pawn_file_std", "pawn_rank_std_diff": "pawn_rank_std"}


def feature_exprs() -> dict:
    """Feature name -> SQL over the white (w) / black (b) rows of per_side and reach (r)."""
    expr = {"material_white": "w.material", "material_black": "b.material",
            "material_diff": "w.material - b.material"}
    for c in _SIDE_COLS:
        expr[f"white_{c}"] = f"w.{c}"
        expr[f"black_{c}"] = f"b.{c}"
    for n, c in _DIFF_SQL.items():
        expr[n] = f"w.{c} - b.{c}"
    expr["white_piece_reach"] = "r.white_piece_reach"
    expr["black_piece_reach"] = "r.black_piece_reach"
    expr["piece_reach_diff"] = "r.white_piece_reach - r.black_piece_reach"
    return expr


def _feature_sql(names: list[str], with_reach: bool = False) -> str:
    """SELECT of the named features from the white/black rows of per_side."""
    expr = feature_exprs()
    cols = ", ".join(f"{R(expr[n])} AS {n}" for n in names)
    src = ("per_side w JOIN per_side b ON w.board_id = b.board_id AND w.side = 'w' AND b.side = 'b'"
           + (" JOIN reach r ON r.board_id = w.board_id" if with_reach else ""))
    return f"SELECT w.board_id, {cols} FROM {src}"


def _group_names(groups) -> list[str]:
    side = B.side_feature_names(groups)
    out = [n for n in FEATURE_KEYS if n in side]
    if "material_white" in side:
        out.insert(2, "material_diff")
    for n, c in _DIFF_SQL.items():
        if f"white_{c}" in side:
            out.append(n)
    return out


def _feature_query(name, groups, fn):
    names = _group_names(groups)

    @register(name, _BASE + "\n" + _feature_sql(names))
    def q(spark, d):
        return rounded(fn(_pieces(spark, d), K))
    return q


_feature_query("board_material", ("material",), B.board_material)
_feature_query("pawn_structure", ("structure",), B.pawn_structure)
_feature_query("passed_pawns", ("passed",), B.passed_pawns)
_feature_query("king_geometry", ("king",), B.king_geometry)
_feature_query("pawn_dispersion", ("dispersion",), B.pawn_dispersion)


@register("position_features", ad.with_ctes(ad.BOARDS_SQL, _PC, _PER_SIDE, _REACH) + "\n"
          + _feature_sql(FEATURE_KEYS, with_reach=True))
def q_position_features(spark, d):
    return rounded(B.position_features(_pieces(spark, d), K))


@register("piece_reach", ad.with_ctes(ad.BOARDS_SQL, _PC, _REACH) + f"""
SELECT board_id, {R('white_piece_reach')} AS white_piece_reach, {R('black_piece_reach')} AS black_piece_reach,
  {R('white_piece_reach - black_piece_reach')} AS piece_reach_diff FROM reach""")
def q_piece_reach(spark, d):
    return rounded(B.piece_reach(_pieces(spark, d), K))


_PAIRS = {"material_diff": ("material_white", "material_black"),
          **{n: (f"white_{c}", f"black_{c}") for n, c in _DIFF_SQL.items()}}


@register("side_differences", _BASE + "\nSELECT w.board_id, " + ", ".join(
    f"{R(f'w.{c} - b.{c}' if n != 'material_diff' else 'w.material - b.material')} AS {n}"
    for n, c in [("material_diff", "material"), *_DIFF_SQL.items()])
    + " FROM per_side w JOIN per_side b ON w.board_id = b.board_id AND w.side = 'w' AND b.side = 'b'")
def q_side_differences(spark, d):
    per = B.board_features(_pieces(spark, d), K, ("material", "structure", "passed", "king", "dispersion"))
    sides = per.select(*K, *[c for pair in _PAIRS.values() for c in pair])
    return rounded(side_differences(sides, _PAIRS).select(*K, *_PAIRS.keys()))


# ----------------------------------------------------------------- FEN text

_FEN_SQL = """grid AS (SELECT b.board_id, g.sq FROM (SELECT DISTINCT board_id FROM pieces) b,
                      range(64) g(sq)),
cells AS (SELECT g.board_id, CAST(g.sq // 8 AS INTEGER) AS rank, g.sq % 8 AS file, coalesce(p.piece, '1') AS c
          FROM grid g LEFT JOIN pieces p ON p.board_id = g.board_id AND p.rank * 8 + p.file = g.sq),
ranks AS (SELECT board_id, rank, replace(replace(replace(replace(replace(replace(replace(
            string_agg(c, '' ORDER BY file), '11111111', '8'), '1111111', '7'), '111111', '6'), '11111', '5'),
            '1111', '4'), '111', '3'), '11', '2') AS t FROM cells GROUP BY board_id, rank),
fens AS (SELECT board_id, string_agg(t, '/' ORDER BY rank DESC) || ' w - - 0 1' AS fen FROM ranks GROUP BY board_id)"""


@register("fen_encode", ad.with_ctes(ad.BOARDS_SQL, _FEN_SQL) + "\nSELECT board_id, fen FROM fens")
def q_fen_encode(spark, d):
    return B.fen_encode(_pieces(spark, d), K)


@register("board_decode", ad.with_ctes(ad.BOARDS_SQL) + """
SELECT board_id, true AS valid, file, rank, piece FROM pieces""")
def q_board_decode(spark, d):
    fens = B.fen_encode(_pieces(spark, d), K)
    return B.board_decode(fens, "fen", K).select("board_id", "valid", "file", "rank", "piece")
