"""Registered queries, group 9-10: movetext, snapshots, reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from pawnshop.operators import movefold as MF, moves as M
from pawnshop.operators.reshape import expand_struct, phase_pivot
from pawnshop.plans import adapters as ad
from pawnshop.plans.common import R, rounded
from pawnshop.schema import FEATURE_KEYS, PHASES

Q: dict = {}
SQL: dict = {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _mt(spark, d):
    return ad.movetext(spark, d)


_SAN = M.SAN_PATTERN
_TOKENS_SQL = r"""clean AS (
  SELECT game_id, movetext IS NULL OR regexp_matches(movetext, '^\s*$') AS blank,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(movetext,
      '\{[^}]*\}', ' ', 'g'), ';[^\n]*', ' ', 'g'), '\[[^\]]*\]', ' ', 'g'), '\$[0-9]+', ' ', 'g'),
      '([()])', ' \1 ', 'g') AS s
  FROM movetext),
split AS (SELECT game_id, blank, string_split_regex(trim(s), '\s+') AS arr FROM clean),
toks AS (SELECT game_id, blank, unnest(arr) AS tok, unnest(range(len(arr))) AS pos FROM split),
t1 AS (SELECT *, regexp_replace(regexp_replace(tok, '^[0-9]+\.+', ''), '[+#!?]+$', '') AS san,
         CASE WHEN tok = '(' THEN 1 WHEN tok = ')' THEN -1 ELSE 0 END AS d FROM toks),
t2 AS (SELECT *, coalesce(sum(d) OVER (PARTITION BY game_id ORDER BY pos
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS depth FROM t1),
t3 AS (SELECT *, depth = 0 AND tok NOT IN ('(', ')') AND san <> '' AS top,
         regexp_matches(san, '""" + _SAN + r"""') AS is_move FROM t2),
t4 AS (SELECT *, min(CASE WHEN top AND tok IN ('1-0', '0-1', '1/2-1/2', '*') THEN pos END)
         OVER (PARTITION BY game_id) AS stop FROM t3),
main AS (SELECT game_id, pos, san FROM t4 WHERE top AND is_move AND (stop IS NULL OR pos < stop))"""
MT = ad.with_ctes(ad.MOVETEXT_SQL, _TOKENS_SQL)


@register("movetext_tokens", MT + """
SELECT game_id, CAST(row_number() OVER (PARTITION BY game_id ORDER BY pos) AS INTEGER) AS ply, san FROM main""")
def q_movetext_tokens(spark, d):
    return MF.movetext_tokens(_mt(spark, d), "game_id", "movetext")


@register("total_moves", MT + """
SELECT m.game_id, CASE WHEN m.movetext IS NULL OR regexp_matches(m.movetext, '^\\s*$') THEN NULL
  ELSE CAST(ceil(coalesce(c.n, 0) / 2) AS INTEGER) END AS total_moves
FROM movetext m LEFT JOIN (SELECT game_id, count(*) AS n FROM main GROUP BY game_id) c USING (game_id)""")
def q_total_moves(spark, d):
    return MF.total_moves(_mt(spark, d), "game_id", "movetext")


# generic as-of snapshots over an ordered event table (conversation turns)

@register("snapshot_at", """
SELECT conv_id, arg_max(text, turn) AS state, max(turn) AS state_turn
FROM conversations WHERE turn <= 3 GROUP BY conv_id""")
def q_snapshot_at(spark, d):
    ev = ad.table(spark, d, "conversations")
    return M.snapshot_at(ev, "conv_id", "turn", "text", 3)


@register("snapshot_final", """
SELECT conv_id, arg_max(text, turn) AS state, max(turn) AS state_turn FROM conversations GROUP BY conv_id""")
def q_snapshot_final(spark, d):
    ev = ad.table(spark, d, "conversations")
    return M.snapshot_final(ev, "conv_id", "turn", "text")


# chess state from the movetext view: SQL twin of the event windows

_FWD = "CASE WHEN side = 'w' THEN 1 ELSE -1 END"
_HOME = "CASE WHEN side = 'w' THEN 0 ELSE 7 END"
_SETUP = ", ".join(f"({f}, {r}, '{p}', '{c}')" for f, k in enumerate(M.BACK_RANK)
                   for r, p, c in ((0, k, "w"), (1, "P", "w"), (6, "P", "b"), (7, k, "b")))
_EVENTS_SQL = f"""mv AS (SELECT game_id, row_number() OVER (PARTITION BY game_id ORDER BY pos) AS ply, san FROM main),
pm AS (SELECT game_id, ply, CASE WHEN ply % 2 = 1 THEN 'w' ELSE 'b' END AS side,
         CASE WHEN regexp_matches(san, '^(O-O-O|0-0-0)$') THEN 'Q' WHEN regexp_matches(san, '^(O-O|0-0)$') THEN 'K' END AS castle,
         CASE WHEN substr(san, 1, 1) IN ('N', 'B', 'R', 'Q', 'K') THEN substr(san, 1, 1) ELSE 'P' END AS kind0,
         contains(san, 'x') AS capture,
         ascii(substr(regexp_extract(san, '([a-h])([1-8])(=?[NBRQ])?$', 0), 1, 1)) - 97 AS df0,
         TRY_CAST(substr(regexp_extract(san, '([a-h])([1-8])(=?[NBRQ])?$', 0), 2, 1) AS INTEGER) - 1 AS dr0,
         regexp_extract(san, '=?([NBRQ])$', 1) AS promo0, ascii(substr(san, 1, 1)) - 97 AS first_file
       FROM mv),
pm2 AS (SELECT game_id, ply, side, castle, capture,
         CASE WHEN castle IS NULL THEN kind0 ELSE 'K' END AS kind,
         CASE WHEN castle IS NULL THEN df0 END AS df, CASE WHEN castle IS NULL THEN dr0 END AS dr,
         CASE WHEN castle IS NULL AND kind0 = 'P' AND promo0 <> '' THEN promo0 END AS promo,
         CASE WHEN castle IS NULL AND kind0 = 'P' AND capture THEN first_file
              WHEN castle IS NULL AND kind0 = 'P' THEN df0 END AS ff
       FROM pm),
pm3 AS (SELECT *, coalesce(kind = 'P' AND capture AND dr = CASE WHEN side = 'w' THEN 5 ELSE 2 END
           AND lag(kind) OVER w = 'P' AND NOT lag(capture) OVER w AND lag(df) OVER w = df
           AND lag(dr) OVER w = dr - {_FWD}, false) AS ep
        FROM pm2 WINDOW w AS (PARTITION BY game_id ORDER BY ply)),
live AS (SELECT game_id FROM movetext WHERE movetext IS NOT NULL AND NOT regexp_matches(movetext, '^\\s*$')),
setup AS (SELECT * FROM (VALUES {_SETUP}) t(file, rank, piece, color)),
ev0 AS (
  SELECT game_id, ply, 2 AS seq, df AS file, dr AS rank, 'A' AS etype, coalesce(promo, kind) AS piece, side AS color,
         side, capture, promo, ep FROM pm3 WHERE castle IS NULL
  UNION ALL SELECT game_id, ply, 2, CASE castle WHEN 'K' THEN 6 ELSE 2 END, {_HOME}, 'A', 'K', side, side, capture, promo, ep
         FROM pm3 WHERE castle IS NOT NULL
  UNION ALL SELECT game_id, ply, 3, CASE castle WHEN 'K' THEN 5 ELSE 3 END, {_HOME}, 'A', 'R', side, side, capture, promo, ep
         FROM pm3 WHERE castle IS NOT NULL
  UNION ALL SELECT game_id, ply, 0, ff, dr - {_FWD}, 'D', NULL, side, side, capture, promo, ep
         FROM pm3 WHERE kind = 'P' AND castle IS NULL AND capture
  UNION ALL SELECT game_id, ply, 0, df, dr - {_FWD},
         CASE WHEN dr = CASE WHEN side = 'w' THEN 3 ELSE 4 END THEN 'Q' ELSE 'D' END, NULL, side, side, capture, promo, ep
         FROM pm3 WHERE kind = 'P' AND castle IS NULL AND NOT capture
  UNION ALL SELECT game_id, ply, 1, df, dr - {_FWD}, 'D', NULL, CASE WHEN side = 'w' THEN 'b' ELSE 'w' END,
         side, capture, promo, ep FROM pm3 WHERE ep
  UNION ALL SELECT l.game_id, 0, 0, s.file, s.rank, 'A', s.piece, s.color, NULL, false, NULL, false FROM live l, setup s),
ev1 AS (SELECT *,
    coalesce(lag(etype) OVER sq = 'A' AND lag(piece) OVER sq = 'P' AND lag(color) OVER sq = color, false) AS near,
    last_value(piece IGNORE NULLS) OVER (sq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS vp,
    last_value(CASE WHEN piece IS NOT NULL THEN color END IGNORE NULLS)
      OVER (sq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS vc
  FROM ev0 WHERE file BETWEEN 0 AND 7 AND rank BETWEEN 0 AND 7
  WINDOW sq AS (PARTITION BY game_id, file, rank ORDER BY ply, seq)),
ev AS (SELECT game_id, ply, seq, file,
    CASE WHEN etype = 'Q' AND NOT near THEN rank - CASE WHEN color = 'w' THEN 1 ELSE -1 END ELSE rank END AS rank,
    CASE WHEN etype = 'Q' THEN 'D' ELSE etype END AS etype, piece, color, side, capture, promo, ep, vp, vc FROM ev1)"""
_VAL = "CASE {c} WHEN 'P' THEN 1 WHEN 'N' THEN 3 WHEN 'B' THEN 3 WHEN 'R' THEN 5 WHEN 'Q' THEN 9 ELSE 0 END"
_DELTAS_SQL = f"""mover AS (SELECT game_id, ply, side,
    CASE WHEN ep THEN 1 WHEN capture THEN {_VAL.format(c='vp')} ELSE 0 END AS lost,
    CASE WHEN ep THEN CASE WHEN side = 'w' THEN 'b' ELSE 'w' END WHEN capture THEN vc END AS victim,
    CASE WHEN promo IS NOT NULL THEN {_VAL.format(c='promo')} - 1 ELSE 0 END AS gain
  FROM ev WHERE etype = 'A' AND ply > 0 AND seq = 2),
deltas AS (
  SELECT game_id, ply, (CASE WHEN side = 'w' THEN gain ELSE 0 END) - (CASE WHEN victim = 'w' THEN lost ELSE 0 END) AS dw,
         (CASE WHEN side = 'b' THEN gain ELSE 0 END) - (CASE WHEN victim = 'b' THEN lost ELSE 0 END) AS db FROM mover
  UNION ALL SELECT game_id, 0, 0, 0 FROM live)"""
CHESS = ad.with_ctes(ad.MOVETEXT_SQL, _TOKENS_SQL, _EVENTS_SQL)
_PHASES_SQL = [("open", "ply <= 20"), ("mid", "ply <= 40"), ("final", "true")]


@register("material_timeline", CHESS + ",\n" + _DELTAS_SQL + """
SELECT game_id, CAST(ply AS INTEGER) AS ply,
  CAST(39 + sum(dw) OVER (PARTITION BY game_id ORDER BY ply ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
    AS material_white,
  CAST(39 + sum(db) OVER (PARTITION BY game_id ORDER BY ply ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
    AS material_black
FROM deltas""")
def q_material_timeline(spark, d):
    return MF.material_timeline(_mt(spark, d), "game_id", "movetext")


@register("king_square_at", CHESS + ",\nk AS (" + "\nUNION ALL ".join(
    f"SELECT game_id, '{ph}' AS phase, color, arg_max(rank * 8 + file, ply * 4 + seq) FILTER (WHERE {cond}) AS sq "
    f"FROM ev WHERE etype = 'A' AND piece = 'K' GROUP BY game_id, color" for ph, cond in _PHASES_SQL) + """)
SELECT game_id, phase, color, CAST(sq % 8 AS INTEGER) AS file, CAST(sq // 8 AS INTEGER) AS rank
FROM k WHERE sq IS NOT NULL""")
def q_king_square_at(spark, d):
    return MF.king_squares(_mt(spark, d), "game_id", "movetext")


@register("pawn_squares_at", CHESS + ",\ns AS (" + "\nUNION ALL ".join(
    f"SELECT game_id, file, rank, '{ph}' AS phase, arg_max({{'etype': etype, 'piece': piece, 'color': color}}, "
    f"ply * 4 + seq) FILTER (WHERE {cond}) AS st FROM ev GROUP BY game_id, file, rank" for ph, cond in _PHASES_SQL)
    + """)
SELECT game_id, phase, st.color AS color, file, rank FROM s WHERE st.etype = 'A' AND st.piece = 'P'""")
def q_pawn_squares_at(spark, d):
    return MF.pawn_squares(_mt(spark, d), "game_id", "movetext")


def _game_features_sql() -> str:
    from pawnshop.plans import catalog_board as cb
    codes = {"open": 1, "mid": 2, "final": 3}
    snaps = []
    for ph, cond in _PHASES_SQL:
        snaps.append(
            f"SELECT game_id * 10 + {codes[ph]} AS board_id, file, rank, CASE WHEN st.color = 'w' THEN 'P' ELSE 'p' END"
            f" AS piece FROM (SELECT game_id, file, rank, arg_max({{'etype': etype, 'piece': piece, 'color': color}},"
            f" ply * 4 + seq) FILTER (WHERE {cond}) AS st FROM ev GROUP BY game_id, file, rank) x"
            f" WHERE st.etype = 'A' AND st.piece = 'P'")
        snaps.append(
            f"SELECT game_id * 10 + {codes[ph]}, CAST(sq % 8 AS INTEGER), CAST(sq // 8 AS INTEGER),"
            f" CASE WHEN color = 'w' THEN 'K' ELSE 'k' END FROM (SELECT game_id, color, arg_max(rank * 8 + file,"
            f" ply * 4 + seq) FILTER (WHERE {cond}) AS sq FROM ev WHERE etype = 'A' AND piece = 'K'"
            f" GROUP BY game_id, color) y WHERE sq IS NOT NULL")
    pieces = "pieces AS (" + "\nUNION ALL ".join(snaps) + ")"
    mat = "mat AS (" + "\nUNION ALL ".join(
        f"SELECT game_id * 10 + {codes[ph]} AS board_id, 39 + sum(dw) FILTER (WHERE {cond}) AS mw,"
        f" 39 + sum(db) FILTER (WHERE {cond}) AS mb FROM deltas GROUP BY game_id" for ph, cond in _PHASES_SQL) + ")"
    expr = cb.feature_exprs()
    expr.update({"material_white": "m.mw", "material_black": "m.mb", "material_diff": "m.mw - m.mb",
                 "white_piece_reach": "NULL", "black_piece_reach": "NULL", "piece_reach_diff": "NULL"})
    cols = ", ".join(f"{R(expr[n])} AS {n}" for n in FEATURE_KEYS)
    phase = "CASE w.board_id % 10 WHEN 1 THEN 'open' WHEN 2 THEN 'mid' ELSE 'final' END"
    return (CHESS + ",\n" + _DELTAS_SQL + ",\n" + pieces + ",\n" + mat + ",\n" + cb._PC + ",\n" + cb._PER_SIDE
            + f""",
long AS (SELECT w.board_id // 10 AS game_id, {phase} AS phase, {cols}
  FROM per_side w JOIN per_side b ON w.board_id = b.board_id AND w.side = 'w' AND b.side = 'b'
  JOIN mat m ON m.board_id = w.board_id)""")


GAME_FEATURES_SQL = _game_features_sql()


@register("game_position_features", GAME_FEATURES_SQL + "\nSELECT * FROM long")
def q_game_position_features(spark, d):
    return rounded(MF.game_position_features(_mt(spark, d), "game_id", "movetext"))


@register("phase_pivot", GAME_FEATURES_SQL + "\nSELECT game_id, " + ", ".join(
    f"max({n}) FILTER (WHERE phase = '{ph}') AS {pre}{n}" for ph, pre in PHASES.items() for n in FEATURE_KEYS)
    + " FROM long GROUP BY game_id")
def q_phase_pivot(spark, d):
    long = MF.game_position_features(_mt(spark, d), "game_id", "movetext")
    wide = phase_pivot(long, ["game_id"], "phase", FEATURE_KEYS, PHASES)
    return rounded(wide)


# ----------------------------------------------------------------- group 10 on games

@register("expand_struct", ad.with_ctes(ad.GAMES_SQL) + f"""
SELECT game_id, {R('WhiteElo')} AS rating_WhiteElo, {R('BlackElo')} AS rating_BlackElo FROM games""")
def q_expand_struct(spark, d):
    g = ad.games(spark, d).select("game_id", F.struct("WhiteElo", "BlackElo").alias("r"))
    return rounded(expand_struct(g, "r", "rating_"))


@register("expand_struct_plain", ad.with_ctes(ad.GAMES_SQL) + f"""
SELECT game_id, {R('WhiteElo')} AS WhiteElo, {R('BlackElo')} AS BlackElo FROM games""")
def q_expand_struct_plain(spark, d):
    """A struct's fields under their own names."""
    g = ad.games(spark, d).select("game_id", F.struct("WhiteElo", "BlackElo").alias("r"))
    return rounded(expand_struct(g, "r"))


@register("standardize", ad.with_ctes(ad.GAMES_SQL) + f""",
st AS (SELECT avg(WhiteElo) AS mw, stddev_samp(WhiteElo) AS sw, avg(BlackElo) AS mb, stddev_samp(BlackElo) AS sb
       FROM games WHERE WhiteElo IS NOT NULL AND BlackElo IS NOT NULL)
SELECT game_id, {R('(WhiteElo - mw) / sw')} AS z_WhiteElo, {R('(BlackElo - mb) / sb')} AS z_BlackElo
FROM games, st WHERE WhiteElo IS NOT NULL AND BlackElo IS NOT NULL""")
def q_standardize(spark, d):
    from pawnshop.operators.learn import standardize
    g = ad.games(spark, d).where(F.col("WhiteElo").isNotNull() & F.col("BlackElo").isNotNull())
    return rounded(standardize(g, ["WhiteElo", "BlackElo"], keep=["game_id"], prefix="z_"))


# ----------------------------------------------------------------- A13 / V8 on the game features

PAWN_EFFECTS = ["material_diff", "pawns_diff", "passed_pawns_diff", "advanced_pawns_diff", "isolated_pawns_diff",
                "pawn_islands_diff", "king_pawn_shield_diff", "king_pawns_near_diff", "pawn_file_std_diff",
                "pawn_rank_std_diff"]
_LABEL_SQL = ("CASE lang WHEN 'en' THEN 1 WHEN 'de' THEN 0 WHEN 'fr' THEN 0 END")


@register("pawn_effects_by_result", GAME_FEATURES_SQL + ",\nlab AS (SELECT doc_id AS game_id, " + _LABEL_SQL
          + " AS label_white_win FROM documents)\nSELECT lab.label_white_win, "
          + ", ".join(f"{R(f'avg(l.{c})')} AS avg_{c}" for c in PAWN_EFFECTS)
          + " FROM long l JOIN lab USING (game_id) WHERE l.phase = 'final' GROUP BY lab.label_white_win")
def q_pawn_effects_by_result(spark, d):
    from pawnshop.functions.scalar import binary_label
    from pawnshop.operators.profile import conditional_means
    games = ad.chess_folded(spark, d, {"final": None})
    feats = MF.snapshot_features(MF.snapshot_rows(games, ["game_id"]), ["game_id"])
    lab = games.select("game_id", binary_label("Winner").alias("label_white_win"))
    return rounded(conditional_means(feats.join(lab, "game_id"), "label_white_win", PAWN_EFFECTS))


@register("pawn_effects_by_phase", GAME_FEATURES_SQL + ",\nlab AS (SELECT doc_id AS game_id, " + _LABEL_SQL
          + " AS label_white_win FROM documents)\nSELECT l.phase, lab.label_white_win, "
          + ", ".join(f"{R(f'avg(l.{c})', 4)} AS avg_{c}" for c in PAWN_EFFECTS)
          + " FROM long l JOIN lab USING (game_id) GROUP BY l.phase, lab.label_white_win")
def q_pawn_effects_by_phase(spark, d):
    """Class means of all three snapshots, from the enriched table."""
    from pawnshop.operators.enrich import enriched
    from pawnshop.operators.profile import conditional_means
    table = enriched(ad.chess_folded(spark, d), "game_id", "Winner")
    return rounded(conditional_means(table, ["phase", "label_white_win"], PAWN_EFFECTS), 4)


_WINNER_SQL = "CASE d.lang WHEN 'en' THEN 'White' WHEN 'de' THEN 'Black' WHEN 'fr' THEN 'Draw' END"


@register("enriched_games", GAME_FEATURES_SQL + ",\ncounted AS (SELECT game_id, count(*) AS n FROM main GROUP BY game_id)\n"
          + f"SELECT l.*, {_WINNER_SQL} AS Winner, " + _LABEL_SQL.replace("lang", "d.lang") + """ AS label_white_win,
  CAST(ceil(coalesce(c.n, 0) / 2) AS INTEGER) AS total_moves
FROM long l JOIN documents d ON d.doc_id = l.game_id LEFT JOIN counted c ON c.game_id = l.game_id""")
def q_enriched_games(spark, d):
    """Written once as Parquet by phase and read back, as every later step does."""
    from pawnshop import sources as S
    from pawnshop.operators.enrich import enriched
    from pawnshop.session import scratch_path
    path = scratch_path(spark, "enriched")
    S.write_parquet(enriched(ad.chess_folded(spark, d), "game_id", "Winner"), path, partition_by=["phase"])
    return rounded(S.read_parquet(spark, path))
