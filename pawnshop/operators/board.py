"""Position features from piece placements.

Input contract: a ``pieces`` table ``(*keys, file, rank, piece[, value])`` with files
0-7 (a-h), ranks 0-7 (1-8) and ``piece`` a FEN letter (upper case = white),
at most one piece per square.  An optional boolean ``valid`` column marks
boards whose text did not parse: their features are all null.  A board with a
row whose ``piece`` is null is an empty (but valid) board.

Every feature of one board comes from ONE grouped aggregation on the board
keys: per file, a bitmask of the ranks holding a pawn of each side, plus
min/max ranks, king squares, material and pawn moments.  Doubled, isolated,
passed and advanced pawns, islands and king shelter are then plain expressions
over that row (bit_count / shifts), so there is one shuffle and no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pawnshop.schema import FEATURE_KEYS, PIECE_VALUE

SIDES = {"white": "w", "black": "b"}


def _shl(a, b):
    return F.call_function("shiftleft", a, b if not isinstance(b, int) else F.lit(b))


def _shr(a, b):
    return F.call_function("shiftright", a, b if not isinstance(b, int) else F.lit(b))


# --------------------------------------------------------------------------- decode / encode

def board_decode(df: DataFrame, fen_col: str, keys: list[str]) -> DataFrame:
    """B1: FEN text -> pieces.  Placement must have 8 rows of 8 squares each;
    otherwise (null, empty, malformed) the board gets ``valid = false``.
    Valid boards always keep one row (``piece`` null when the board is empty).
    """
    # each step is a column of its own, so that no square works out the whole text again
    text = df.select(*keys, _expand_digits(F.split(F.trim(F.col(fen_col)), " ").getItem(0)).alias("_text"))
    rows = F.split("_text", "/")
    ok = F.coalesce((F.size(rows) == 8) & F.forall(rows, lambda r: r.rlike("^[pnbrqkPNBRQK.]{8}$")), F.lit(False))
    b = text.select(*keys, ok.alias("valid"), F.replace("_text", F.lit("/"), F.lit("")).alias("_flat"))
    b = b.select(*keys, "valid", "_flat", (F.col("valid") & (F.translate("_flat", ".", "") != "")).alias("_some"))
    x = b.select(*keys, "valid", "_flat", "_some", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("_i"))
    square = F.substring("_flat", F.col("_i") + 1, F.lit(1))
    # an empty or invalid board keeps one row without a piece
    x = x.where(F.when(F.col("_some"), square != ".").otherwise(F.col("_i") == 0))
    held = lambda v: F.when(F.col("_some"), v)
    return x.select(*keys, "valid", held(F.col("_i") % 8).cast("int").alias("file"),
                    held(F.lit(7) - F.floor(F.col("_i") / 8)).cast("int").alias("rank"), held(square).alias("piece"))


def _expand_digits(r):
    for n in range(8, 0, -1):
        r = F.replace(r, F.lit(str(n)), F.lit("." * n))
    return r


def fen_encode(pieces: DataFrame, keys: list[str], suffix: str = " w - - 0 1") -> DataFrame:
    """Pieces -> FEN text (placement plus a fixed suffix), one row per board.

    Each board is at most 64 squares, so gathering its pieces into one row is
    bounded by construction.  Of several pieces on a square the first letter
    counts.
    """
    sq = F.col("rank") * 8 + F.col("file")
    placed = (pieces.where(F.col("piece").isNotNull()).repartition(*keys)
              .select(*keys, F.floor(sq / 8).cast("int").alias("_rank"), F.pmod(sq, F.lit(8)).cast("int").alias("_file"), "piece"))
    per_rank = placed.groupBy(*keys, "_rank").agg(*[F.min(F.when(F.col("_file") == f, F.col("piece"))).alias(f"_p{f}") for f in range(8)])
    cells = F.concat(*[F.coalesce(F.col(f"_p{f}"), F.lit("1")) for f in range(8)])
    per = per_rank.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(F.col("_rank").alias("k"), cells.alias("v")))).alias("_m"))
    # one text of all squares; runs of empty squares end at the "/" between ranks
    grid = F.concat_ws("/", *[F.coalesce(F.element_at("_m", F.lit(rank)), F.lit("1" * 8)) for rank in range(7, -1, -1)])
    for n in range(8, 1, -1):
        grid = F.replace(grid, F.lit("1" * n), F.lit(str(n)))
    return per.select(*keys, F.concat(grid, F.lit(suffix)).alias("fen"))


# --------------------------------------------------------------------------- the one aggregation

def _is(color: str, kind: str | None = None):
    p = F.col("piece")
    side = (p == F.upper(p)) if color == "w" else (p == F.lower(p))
    return side if kind is None else side & (F.upper(p) == kind)


def _board_aggs() -> list:
    aggs = [F.min("_ok").alias("_valid")]
    for c in ("w", "b"):
        mine = F.col("_side") == c
        pawn = mine & (F.col("_kind") == "P")
        aggs.append(F.sum(F.when(mine, F.col("_val")).otherwise(0)).alias(f"_mat_{c}"))
        aggs.append(F.max(F.when(mine & (F.col("_kind") == "K"), F.col("_sq"))).alias(f"_k_{c}"))
        for f in range(8):
            on_f = pawn & (F.col("file") == f)
            aggs.append(F.bit_or(F.when(on_f, F.col("_rbit"))).alias(f"_m_{c}{f}"))
        for axis in ("file", "rank"):
            v = F.when(pawn, F.col(axis))
            aggs += [F.avg(v).alias(f"_avg_{c}_{axis}"), F.stddev_pop(v).alias(f"_std_{c}_{axis}"),
                     (F.max(v) - F.min(v)).alias(f"_span_{c}_{axis}")]
    return aggs


def _reach_aggs() -> list:
    return [F.sum(F.when(F.col("_side") == c, F.col("_reach")).otherwise(0)).alias(f"_reach_{c}")
            for c in ("w", "b")]


def board_aggregate(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """One row per board with per-file pawn masks, king squares, material and
    pawn moments; then a projection of per-file intermediates that the
    feature expressions share (kept as its own step so generated code stays
    small)."""
    if "valid" not in pieces.columns:
        pieces = pieces.withColumn("valid", F.lit(True))
    value = F.lit(0)
    for k, v in PIECE_VALUE.items():
        if v:
            value = F.when(F.upper(F.col("piece")) == k, F.lit(v)).otherwise(value)
    if "value" in pieces.columns:  # explicit material per row (e.g. snapshot material rows)
        value = F.coalesce(F.col("value"), value)
    pre = pieces.select(
        *keys, "file", "rank", F.coalesce(F.col("valid"), F.lit(True)).alias("_ok"),
        F.when(F.col("piece") == F.upper(F.col("piece")), "w")
         .when(F.col("piece") == F.lower(F.col("piece")), "b").alias("_side"),
        F.upper(F.col("piece")).alias("_kind"), value.alias("_val"),
        (F.col("rank") * 8 + F.col("file")).alias("_sq"),
        _shl(F.lit(1), F.col("rank")).alias("_rbit"),
        *([F.col("_reach")] if "_reach" in pieces.columns else []))
    aggs = _board_aggs() + (_reach_aggs() if "_reach" in pieces.columns else [])
    return _shared(pre.groupBy(*keys).agg(*aggs))


def _shared(agg: DataFrame) -> DataFrame:
    """Per-file intermediates that the feature expressions share."""
    mid = [F.col("*")]
    for c in ("w", "b"):
        for f in range(8):
            mid.append(F.coalesce(F.col(f"_m_{c}{f}"), F.lit(0)).alias(f"_mm_{c}{f}"))
        mid.append((F.col(f"_k_{c}") % 8).alias(f"_kf_{c}"))
        mid.append(F.floor(F.col(f"_k_{c}") / 8).cast("int").alias(f"_kr_{c}"))
    agg = agg.select(*mid)
    nxt = [F.col("*")]
    for c in ("w", "b"):
        for f in range(8):
            nxt.append(F.bit_count(F.col(f"_mm_{c}{f}")).alias(f"_cn_{c}{f}"))
            # ranks held by this side's pawns on files f-1..f+1
            near = [F.col(f"_mm_{c}{x}") for x in (f - 1, f, f + 1) if 0 <= x <= 7]
            u = near[0]
            for x in near[1:]:
                u = u.bitwiseOR(x)
            nxt.append(u.alias(f"_nu_{c}{f}"))
        for d in (-2, -1, 0, 1, 2):
            kf = F.col(f"_kf_{c}") + d
            e = F.lit(0)
            for f in range(8):
                e = F.when(kf == f, F.col(f"_mm_{c}{f}")).otherwise(e)
            nxt.append(e.alias(f"_km_{c}{d + 2}"))
    return agg.select(*nxt)


# --------------------------------------------------------------------------- feature expressions

def _m(c, f):
    """Rank bitmask of side c's pawns on file f (0 when none / off board)."""
    return F.col(f"_mm_{c}{f}") if 0 <= f <= 7 else F.lit(0)


def _cnt(c, f):
    return F.col(f"_cn_{c}{f}") if 0 <= f <= 7 else F.lit(0)


def _sum(cols):
    out = F.lit(0)
    for x in cols:
        out = out + x
    return out


def _range_mask(lo, hi):
    """Bits lo..hi (inclusive, clipped to 0..7) as an int mask; 0 when empty."""
    lo_c, hi_c = F.greatest(lo, F.lit(0)), F.least(hi, F.lit(7))
    return F.when(hi_c >= lo_c, _shl(F.lit(1), hi_c + 1) - _shl(F.lit(1), lo_c)).otherwise(F.lit(0))


def _pawn_structure_exprs(c: str) -> dict:
    occ = [(_cnt(c, f) > 0) for f in range(8)]
    occ_at = lambda f: occ[f] if 0 <= f <= 7 else F.lit(False)
    pawns = _sum(_cnt(c, f) for f in range(8))
    doubled = _sum(F.when(_cnt(c, f) >= 2, 1).otherwise(0) for f in range(8))
    islands = _sum(F.when(occ[f] & ~occ_at(f - 1), 1).otherwise(0) for f in range(8))
    isolated = _sum(F.when(~occ_at(f - 1) & ~occ_at(f + 1), _cnt(c, f)).otherwise(0) for f in range(8))
    adv_mask = 0xF0 if c == "w" else 0x0F
    advanced = _sum(F.bit_count(_m(c, f).bitwiseAND(F.lit(adv_mask))) for f in range(8))
    return {"pawns": pawns, "doubled_pawns": doubled, "isolated_pawns": isolated,
            "advanced_pawns": advanced, "pawn_islands": islands}


def _high_bit(m):
    """Index of the highest set bit of an 8-bit mask (-1 when 0)."""
    smear = m.bitwiseOR(_shr(m, 1))
    smear = smear.bitwiseOR(_shr(smear, 2))
    smear = smear.bitwiseOR(_shr(smear, 4))
    return F.bit_count(smear) - 1


def _low_bit(m):
    """Index of the lowest set bit of an 8-bit mask (8 when 0)."""
    return F.when(m == 0, F.lit(8)).otherwise(F.bit_count(m.bitwiseAND(-m) - 1))


def _passed_expr(c: str):
    e = "b" if c == "w" else "w"
    total = []
    for f in range(8):
        enemy = F.col(f"_nu_{e}{f}")
        if c == "w":
            # no black pawn strictly ahead on near files: every white rank >= max black rank
            total.append(F.bit_count(_shr(_m(c, f), F.greatest(_high_bit(enemy), F.lit(0)))))
        else:
            total.append(F.bit_count(_m(c, f).bitwiseAND(_shl(F.lit(1), _low_bit(enemy) + 1) - 1)))
    return _sum(total)


def _king_exprs(c: str) -> dict:
    k = F.col(f"_k_{c}")
    kr = F.col(f"_kr_{c}")
    shield_ranks = _range_mask(kr + 1, kr + 2) if c == "w" else _range_mask(kr - 2, kr - 1)
    near_ranks = _range_mask(kr - 2, kr + 2)
    shield = _sum(F.bit_count(F.col(f"_km_{c}{d + 2}").bitwiseAND(shield_ranks)) for d in (-1, 0, 1))
    near = _sum(F.bit_count(F.col(f"_km_{c}{d + 2}").bitwiseAND(near_ranks)) for d in (-2, -1, 0, 1, 2))
    return {"king_pawn_shield": F.when(k.isNull(), 0).otherwise(shield),
            "king_pawns_near": F.when(k.isNull(), 0).otherwise(near)}


def _dispersion_exprs(c: str) -> dict:
    out = {}
    for axis in ("file", "rank"):
        out[f"pawn_{axis}_mean"] = F.coalesce(F.col(f"_avg_{c}_{axis}"), F.lit(0.0))
        out[f"pawn_{axis}_std"] = F.coalesce(F.col(f"_std_{c}_{axis}"), F.lit(0.0))
        out[f"pawn_{axis}_span"] = F.coalesce(F.col(f"_span_{c}_{axis}"), F.lit(0))
    return out


_DIFFS = {"pawns_diff": "pawns", "passed_pawns_diff": "passed_pawns",
          "advanced_pawns_diff": "advanced_pawns", "isolated_pawns_diff": "isolated_pawns",
          "pawn_islands_diff": "pawn_islands", "king_pawn_shield_diff": "king_pawn_shield",
          "king_pawns_near_diff": "king_pawns_near", "pawn_file_std_diff": "pawn_file_std",
          "pawn_rank_std_diff": "pawn_rank_std"}


_GROUP_FEATURES = {
    "structure": ["pawns", "doubled_pawns", "isolated_pawns", "advanced_pawns", "pawn_islands"],
    "passed": ["passed_pawns"],
    "king": ["king_pawn_shield", "king_pawns_near"],
    "dispersion": ["pawn_file_mean", "pawn_file_std", "pawn_file_span", "pawn_rank_mean", "pawn_rank_std",
                   "pawn_rank_span"],
}


def side_feature_names(groups=("material", "structure", "passed", "king", "dispersion")) -> list[str]:
    """Names produced by ``side_feature_columns`` (no Spark session needed)."""
    out = []
    if "material" in groups:
        out += ["material_white", "material_black"]
    if "reach" in groups:
        out += ["white_piece_reach", "black_piece_reach"]
    for side in SIDES:
        for g in ("structure", "passed", "king", "dispersion"):
            if g in groups:
                out += [f"{side}_{n}" for n in _GROUP_FEATURES[g]]
    return out


def side_feature_columns(groups=("material", "structure", "passed", "king", "dispersion")) -> dict:
    """Per-side feature name -> expression over ``board_aggregate`` output."""
    out = {}
    if "material" in groups:
        out["material_white"] = F.col("_mat_w")
        out["material_black"] = F.col("_mat_b")
    if "reach" in groups:
        out["white_piece_reach"] = F.col("_reach_w")
        out["black_piece_reach"] = F.col("_reach_b")
    for side, c in SIDES.items():
        d = {}
        if "structure" in groups:
            d.update(_pawn_structure_exprs(c))
        if "passed" in groups:
            d["passed_pawns"] = _passed_expr(c)
        if "king" in groups:
            d.update(_king_exprs(c))
        if "dispersion" in groups:
            d.update(_dispersion_exprs(c))
        for name, e in d.items():
            out[f"{side}_{name}"] = e
    return out


def _select_features(agg: DataFrame, keys: list[str], groups, order: list[str] | None = None) -> DataFrame:
    side = side_feature_columns(groups)
    step1 = agg.select(*keys, "_valid", *[e.cast("double").alias(n) for n, e in side.items()])
    exprs = {n: F.col(n) for n in side}
    if "material_white" in side:
        exprs["material_diff"] = F.col("material_white") - F.col("material_black")
    for name, base in _DIFFS.items():
        if f"white_{base}" in side:
            exprs[name] = F.col(f"white_{base}") - F.col(f"black_{base}")
    if "white_piece_reach" in side:
        exprs["piece_reach_diff"] = F.col("white_piece_reach") - F.col("black_piece_reach")
    order = order or FEATURE_KEYS
    names = [n for n in order if n in exprs] + [n for n in exprs if n not in order]
    return step1.select(*keys, *[F.when(F.col("_valid"), exprs[n]).alias(n) for n in names])


def board_features(pieces: DataFrame, keys: list[str], groups) -> DataFrame:
    return _select_features(board_aggregate(pieces, keys), keys, groups)


def mask_features(boards: DataFrame, keys: list[str], groups) -> DataFrame:
    """Features of boards given as one row each: ``white_pawns``/``black_pawns``
    (a bit for each square, rank * 8 + file), ``white_king``/``black_king``
    (squares) and ``material_white``/``material_black``.  Nothing is grouped or
    shuffled; the moments come from whole counts."""
    step = [*keys, F.lit(True).alias("_valid")]
    for side, c in SIDES.items():
        mask = F.col(f"{side}_pawns")
        bit = lambda r, f: _shr(mask, r * 8 + f).bitwiseAND(F.lit(1).cast("bigint")).cast("int")  # noqa: B023, E731
        step += [F.col(f"material_{side}").alias(f"_mat_{c}"), F.col(f"{side}_king").alias(f"_k_{c}")]
        step += [_sum(_shl(bit(r, f), r) for r in range(8)).alias(f"_m_{c}{f}") for f in range(8)]
        step += [F.bit_count(mask.bitwiseAND(_shl(F.lit(255).cast("bigint"), r * 8))).alias(f"_r_{c}{r}") for r in range(8)]
    x = boards.select(*step)
    counted = [F.col("*")]
    for c in SIDES.values():
        for axis, counts in (("file", [F.bit_count(f"_m_{c}{f}") for f in range(8)]), ("rank", [F.col(f"_r_{c}{r}") for r in range(8)])):
            held = F.array(*counts)
            counted.append(F.struct(
                _sum(counts).alias("n"), _sum(n * i for i, n in enumerate(counts)).alias("s"), _sum(n * (i * i) for i, n in enumerate(counts)).alias("q"),
                F.array_max(F.transform(held, lambda n, i: F.when(n > 0, i))).alias("hi"),
                F.array_min(F.transform(held, lambda n, i: F.when(n > 0, i))).alias("lo")).alias(f"_t_{c}_{axis}"))
    x = x.select(*counted)
    moments = [F.col("*")]
    for c in SIDES.values():
        for axis in ("file", "rank"):
            t = F.col(f"_t_{c}_{axis}")
            some = t["n"] > 0
            moments += [F.when(some, t["s"] / t["n"]).alias(f"_avg_{c}_{axis}"),
                        F.when(some, F.sqrt(t["n"] * t["q"] - t["s"] * t["s"]) / t["n"]).alias(f"_std_{c}_{axis}"),
                        F.when(some, t["hi"] - t["lo"]).alias(f"_span_{c}_{axis}")]
    return _select_features(_shared(x.select(*moments)), keys, groups)


def board_material(pieces, keys):
    """B2: material per side (P1 N3 B3 R5 Q9, king 0) and white - black."""
    return board_features(pieces, keys, ("material",))


def pawn_structure(pieces, keys):
    """Pawns, doubled (files), isolated (pawns), advanced, islands per side."""
    return board_features(pieces, keys, ("structure",))


def passed_pawns(pieces, keys):
    """Pawns with no enemy pawn ahead on their own or a neighbouring file."""
    return board_features(pieces, keys, ("passed",))


def king_geometry(pieces, keys):
    """Own pawns in the 3x2 block ahead of the king, and within distance 2."""
    return board_features(pieces, keys, ("king",))


def pawn_dispersion(pieces, keys):
    """Mean, population std and span of pawn files and ranks (0.0 without pawns)."""
    return board_features(pieces, keys, ("dispersion",))


# --------------------------------------------------------------------------- piece reach

_DIRS = {"R": [(1, 0), (-1, 0), (0, 1), (0, -1)], "B": [(1, 1), (1, -1), (-1, 1), (-1, -1)]}
_DIRS["Q"] = _DIRS["R"] + _DIRS["B"]
_KNIGHT = [(1, 2), (2, 1), (2, -1), (1, -2), (-1, -2), (-2, -1), (-2, 1), (-1, 2)]
_KING = _DIRS["Q"]


def _squares(steps) -> list[int]:
    """For each square the mask of the squares that the steps reach, as a signed 64-bit number."""
    out = []
    for square in range(64):
        mask = 0
        for df_, dr in steps:
            f, r = square % 8 + df_, square // 8 + dr
            if 0 <= f < 8 and 0 <= r < 8:
                mask |= 1 << (r * 8 + f)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def _at(masks: list[int], square) -> Column:
    return F.element_at(F.expr(f"array({', '.join(f'{m}L' for m in masks)})"), square.cast("int") + 1)


def _lowest(x) -> Column:
    """Place of the lowest 1; the top bit alone is looked at first, since its negative overflows."""
    return F.when(x == F.lit(-(1 << 63)), F.lit(63)).otherwise(F.bit_count(x.bitwiseAND(-x) - 1))


def _highest(x) -> Column:
    """Place of the highest 1: the binary digits have no leading zeros."""
    return F.length(F.bin(x)) - 1


def _ray(direction, square, occupied, own) -> Column:
    """Squares a slider reaches one way: up to the first piece, which counts unless it is its own."""
    df_, dr = direction
    masks = _squares([(df_ * k, dr * k) for k in range(1, 8)])
    ray = _at(masks, square)
    hit = ray.bitwiseAND(occupied)
    first = _lowest(hit) if dr * 8 + df_ > 0 else _highest(hit)
    blocked = _shr(own, first.cast("int")).bitwiseAND(F.lit(1).cast("long"))
    return F.when(hit == 0, F.bit_count(ray)).otherwise(F.bit_count(ray) - F.bit_count(_at(masks, first)) - blocked)


def reach_per_piece(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """Every input row plus ``_reach``: its piece's pseudo-legal destination
    count (0 for rows without a piece).

    Sliders move along a ray up to the first occupied square (included when it
    holds an enemy piece); knights and kings to any square not held by their
    own side; pawns push one square (two from the start rank) onto empty
    squares and capture diagonally onto enemy pieces.  No check, pin,
    castling or en passant rules: this is piece activity, not the legal move
    count.  Occupancy is a 64-bit mask from a window over the board (at most 64
    rows); each piece's reach is arithmetic on that mask and constant masks, so
    there is one row per piece, no join and no further aggregate.
    """
    if "valid" not in pieces.columns:
        pieces = pieces.withColumn("valid", F.lit(True))
    board = Window.partitionBy(*keys)
    zero = F.lit(0).cast("long")
    bit = _shl(F.lit(1).cast("long"), F.col("rank") * 8 + F.col("file"))
    p = pieces.select(
        *keys, "file", "rank", "piece", "valid", (F.col("rank") * 8 + F.col("file")).alias("_at"),
        (F.col("piece") == F.upper("piece")).alias("_white"), F.upper(F.col("piece")).alias("_kind"),
        F.coalesce(F.bit_or(F.when(_is("w"), bit)).over(board), zero).alias("_occ_w"),
        F.coalesce(F.bit_or(F.when(_is("b"), bit)).over(board), zero).alias("_occ_b"))
    p = p.select("*", F.when(F.col("_white"), F.col("_occ_w")).otherwise(F.col("_occ_b")).alias("_own"),
                 F.when(F.col("_white"), F.col("_occ_b")).otherwise(F.col("_occ_w")).alias("_foe"),
                 F.col("_occ_w").bitwiseOR(F.col("_occ_b")).alias("_occ"))
    square, own, foe, occ, kind = (F.col(c) for c in ("_at", "_own", "_foe", "_occ", "_kind"))
    free = lambda steps: F.bit_count(_at(_squares(steps), square).bitwiseAND(F.bitwise_not(own)))
    rays = lambda k: sum((_ray(d, square, occ, own) for d in _DIRS[k]), F.lit(0))

    def pawn(fwd: int, start: int) -> Column:
        one = _at(_squares([(0, fwd)]), square)
        two = _at(_squares([(0, 2 * fwd)]), square)
        open_ = (one != 0) & (one.bitwiseAND(occ) == 0)
        push = F.when(open_ & (F.col("rank") == start) & (two.bitwiseAND(occ) == 0), 2).when(open_, 1).otherwise(0)
        return push + F.bit_count(_at(_squares([(-1, fwd), (1, fwd)]), square).bitwiseAND(foe))

    reach = (F.when(kind.isin("R", "Q"), rays("R")).otherwise(0) + F.when(kind.isin("B", "Q"), rays("B")).otherwise(0)
             + F.when(kind == "N", free(_KNIGHT)).when(kind == "K", free(_KING))
                .when((kind == "P") & F.col("_white"), pawn(1, 1)).when(kind == "P", pawn(-1, 6)).otherwise(0))
    return p.select(*keys, "file", "rank", "piece", "valid", reach.cast("long").alias("_reach"))


def piece_reach(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """B12 (re-aimed): pseudo-legal destination count per side (see
    ``reach_per_piece``); null for boards whose text did not parse."""
    per = reach_per_piece(pieces, keys)
    side = F.when(F.col("piece") == F.upper(F.col("piece")), "w").when(F.col("piece") == F.lower(F.col("piece")), "b")
    a = per.groupBy(*keys).agg(
        F.min(F.coalesce(F.col("valid"), F.lit(True))).alias("_valid"),
        F.sum(F.when(side == "w", F.col("_reach")).otherwise(0)).cast("double").alias("_w"),
        F.sum(F.when(side == "b", F.col("_reach")).otherwise(0)).cast("double").alias("_b"))
    return a.select(*keys, F.when(F.col("_valid"), F.col("_w")).alias("white_piece_reach"),
                    F.when(F.col("_valid"), F.col("_b")).alias("black_piece_reach"),
                    F.when(F.col("_valid"), F.col("_w") - F.col("_b")).alias("piece_reach_diff"))


# --------------------------------------------------------------------------- all 43

def position_features(pieces: DataFrame, keys: list[str], with_reach: bool = True) -> DataFrame:
    """All features in FEATURE_KEYS order; null for invalid boards.

    One chain on one shuffle by board: piece reach per piece, then the single
    grouped pass that also sums reach per side.  No join between branches.
    """
    groups = ("material", "structure", "passed", "king", "dispersion")
    if not with_reach:
        feats = _select_features(board_aggregate(pieces, keys), keys, groups, FEATURE_KEYS)
        return feats.select(*keys, *[F.col(n) if n in feats.columns else F.lit(None).cast("double").alias(n)
                                     for n in FEATURE_KEYS])
    per_piece = reach_per_piece(pieces.repartition(*keys), keys)
    return _select_features(board_aggregate(per_piece, keys), keys, groups + ("reach",), FEATURE_KEYS)
