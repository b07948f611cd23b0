"""Game state from movetext without replaying games (M1-M6).

A game's text is split into half-moves (one row each); everything else is
windows and aggregates keyed by the game:

* the piece taken by a capture is the last piece that arrived on that square
  (``lag`` over the square's arrivals, starting from the initial set-up);
* en passant is a pawn capture onto the 6th/3rd rank right after an enemy pawn
  push to the square behind it;
* a pawn push to the 4th/5th rank came from the 3rd/6th rank iff the last
  event on that square is an own pawn arrival, else from the start rank;
* a square holds a pawn at ply p iff its last event up to p is a pawn arrival;
* the king stands where it last arrived; material is 39 plus the sum of
  capture and promotion deltas up to p.

Every window is partitioned by the game key (plus square), so after one
shuffle by game all of them run without further exchanges.  A game is one
text, so its group is bounded by that text.  Legality is not validated:
moves are taken as written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pawnshop.schema import PIECE_VALUE

# --- fixed values: PGN result tokens and SAN shape ----------------------------
RESULTS = ["1-0", "0-1", "1/2-1/2", "*"]
SAN_PATTERN = (r"^(?:[NBRQK][a-h]?[1-8]?x?[a-h][1-8]|[a-h](?:x[a-h])?[1-8](?:=?[NBRQ])?"
               r"|O-O(?:-O)?|0-0(?:-0)?)$")
# initial set-up, ranks 1 and 8 from the a-file
BACK_RANK = "RNBQKBNR"


def _clean_body(col):
    """Text without comments, tag pairs and numeric annotations."""
    s = F.regexp_replace(col, r"\{[^}]*\}", " ")        # comments
    s = F.regexp_replace(s, r";[^\n]*", " ")             # rest-of-line comments
    s = F.regexp_replace(s, r"\[[^\]]*\]", " ")          # tag pairs
    return F.regexp_replace(s, r"\$[0-9]+", " ")         # numeric annotations


def _clean_text(col):
    return F.regexp_replace(_clean_body(col), r"([()])", " $1 ")  # variations as own tokens


def token_rows(df: DataFrame, key: str, text: str, context: bool = False, by: str | None = None) -> DataFrame:
    """All tokens with flags: (key, blank, pos, tok, san, mainline, ply).

    ``by`` names a column that tells the texts apart (default: the key).
    Tokens that are no moves are passed over; the game ends at its result.

    Two window passes per game: the parenthesis depth, then - in one pass -
    the stop count, the ply number and (``context=True``) the kind, capture
    and destination of the previous main-line move.  Candidate moves before
    the first stop are exactly the main line, so all of these are running
    aggregates over the same ordering.
    """
    blank = F.col(text).isNull() | F.col(text).rlike(r"^\s*$")
    toks = F.split(F.trim(_clean_text(F.col(text))), r"\s+")
    # per-text values first: columns next to a generator are evaluated per output row
    # shuffle whole texts by game (few wide rows) rather than their tokens (many
    # narrow rows); explode keeps the partitioning, so the windows need no exchange
    keys = [key, by] if by else [key]
    by = by or key
    pre = df.select(*keys, blank.alias("blank"), toks.alias("_toks")).repartition(by)
    x = pre.select(*keys, "blank", F.posexplode_outer("_toks").alias("pos", "tok"))
    san = F.regexp_replace(F.regexp_replace(F.col("tok"), r"^[0-9]+\.+", ""), r"[+#!?]+$", "")
    delta = F.when(F.col("tok") == "(", 1).when(F.col("tok") == ")", -1).otherwise(0)
    x = x.select(*keys, "blank", "pos", "tok", san.alias("san"), delta.alias("_d"))
    ordered = Window.partitionBy(by).orderBy("pos")
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prior = ordered.rowsBetween(Window.unboundedPreceding, -1)
    depth = F.coalesce(F.sum("_d").over(prior), F.lit(0))
    x = x.withColumn("_depth", depth)
    top = (F.col("_depth") == 0) & ~F.col("tok").isin("(", ")") & (F.col("san") != "")
    is_move = F.col("san").rlike(SAN_PATTERN)
    x = x.withColumn("_cand", F.coalesce(top & is_move, F.lit(False))).withColumn(
        "_stop", F.coalesce(top & F.col("tok").isin(*RESULTS), F.lit(False)))
    cand = F.col("_cand")
    extra = []
    if context:
        parsed = _parsed(F.col("san"), F.lit(1))
        for n in ("kind", "capture", "df", "dr"):
            x = x.withColumn(f"_c_{n}", F.when(cand, parsed[n]))
            extra.append(F.last(f"_c_{n}", ignorenulls=True).over(prior).alias(f"prev_{n}"))
    # the game ends at its first result
    x = x.select("*", F.sum(F.col("_stop").cast("int")).over(upto).alias("_stops"),
                 F.sum(cand.cast("int")).over(upto).alias("_n"), *extra)
    main = cand & (F.col("_stops") == 0)
    x = x.withColumn("mainline", main).withColumn("ply", F.when(main, F.col("_n").cast("int")))
    return x.drop("_d", "_depth", "_cand", "_stop", "_stops", "_n", *[f"_c_{n}" for n in
                                                                      ("kind", "capture", "df", "dr")])


def _numbered(df: DataFrame) -> DataFrame:
    return df.withColumn("_row", F.monotonically_increasing_id())


def movetext_tokens(df: DataFrame, key: str, text: str) -> DataFrame:
    """M1: main-line half-moves (key, ply, san) of each row's text; comments,
    variations, annotations, move numbers, unknown tokens and the result are not
    moves.  Rows may share a key or have none: each text is a game of its own."""
    return token_rows(_numbered(df), key, text, by="_row").where("mainline").select(key, "ply", "san")


def total_moves(df: DataFrame, key: str, text: str) -> DataFrame:
    """M2: ceil(half-moves / 2); 0 without moves; null for null/blank text."""
    t = token_rows(_numbered(df), key, text, by="_row")
    a = t.groupBy("_row", key).agg(F.count_if("mainline").alias("_n"), F.max("blank").alias("_blank"))
    return a.select(key, F.when(~F.col("_blank"), F.ceil(F.col("_n") / 2).cast("int")).alias("total_moves"))


# --------------------------------------------------------------------------- generic snapshots

def snapshot_at(events: DataFrame, key: str, order: str, state: str, limit: int | None,
                name: str = "state") -> DataFrame:
    """M3/M4: per key, the state of the last event with order <= limit
    (the last event overall when limit is None).  ``max_by`` is a partial
    aggregate, so a hot key costs one row per input partition.
    """
    ev = events if limit is None else events.where(F.col(order) <= F.lit(limit))
    return ev.groupBy(key).agg(F.max_by(F.col(state), F.col(order)).alias(name),
                               F.max(order).alias(f"{name}_{order}"))


def snapshot_final(events: DataFrame, key: str, order: str, state: str, name: str = "state") -> DataFrame:
    return snapshot_at(events, key, order, state, None, name)


# --------------------------------------------------------------------------- SAN -> events

def _parsed(san, ply) -> dict:
    castle = F.when(san.rlike(r"^(O-O-O|0-0-0)$"), "Q").when(san.rlike(r"^(O-O|0-0)$"), "K")
    first = F.substring(san, 1, 1)
    kind = F.when(first.isin("N", "B", "R", "Q", "K"), first).otherwise("P")
    dest = F.regexp_extract(san, r"([a-h])([1-8])(=?[NBRQ])?$", 0)
    df_ = F.ascii(F.substring(dest, 1, 1)) - 97
    dr_ = F.substring(dest, 2, 1).cast("int") - 1
    promo = F.regexp_extract(san, r"=?([NBRQ])$", 1)
    return {
        "side": F.when(ply % 2 == 1, "w").otherwise("b"),
        "castle": castle,
        "kind": F.when(castle.isNull(), kind).otherwise("K"),
        "capture": san.contains("x"),
        "df": F.when(castle.isNull(), df_),
        "dr": F.when(castle.isNull(), dr_),
        "promo": F.when(castle.isNull() & (kind == "P") & (promo != ""), promo),
        "ff": F.when(castle.isNull() & (kind == "P") & san.contains("x"), F.ascii(first) - 97)
               .when(castle.isNull() & (kind == "P"), df_),
    }


def parse_moves(moves: DataFrame, key: str) -> DataFrame:
    """Adds side, castle, kind, capture, destination, promotion and pawn origin file."""
    cols = _parsed(F.col("san"), F.col("ply"))
    return moves.select(key, "ply", "san", *[c.alias(n) for n, c in cols.items()])


EVENT_TYPE = "array<struct<ply:int,seq:int,file:int,rank:int,etype:string,piece:string,color:string>>"


def _ev(seq, file, rank, etype, piece, color, ply=None):
    ply = F.col("ply") if ply is None else ply
    return F.struct(ply.cast("int").alias("ply"), F.lit(seq).alias("seq"), file.cast("int").alias("file"), rank.cast("int").alias("rank"),
                    F.lit(etype).alias("etype"), piece.cast("string").alias("piece"), color.alias("color"))


def _move_items(prev_kind, prev_capture, prev_df, prev_dr):
    """Events of one half-move as an array of nullable structs, and the en
    passant flag (given the previous half-move's kind/capture/destination)."""
    fwd = F.when(F.col("side") == "w", 1).otherwise(-1)
    opp = F.when(F.col("side") == "w", "b").otherwise("w")
    home = F.when(F.col("side") == "w", 0).otherwise(7)
    pawn = F.col("kind") == "P"
    # en passant: pawn capture onto rank 6 (3) right after an enemy pawn push to the square behind it
    ep = F.coalesce(pawn & F.col("capture")
                    & (F.col("dr") == F.when(F.col("side") == "w", 5).otherwise(2))
                    & (prev_kind == "P") & ~prev_capture
                    & (prev_df == F.col("df")) & (prev_dr == F.col("dr") - fwd), F.lit(False))
    double_rank = F.when(F.col("side") == "w", 3).otherwise(4)
    arrive = F.coalesce(F.col("promo"), F.col("kind"))
    items = [
        F.when(F.col("castle").isNull(), _ev(2, F.col("df"), F.col("dr"), "A", arrive, F.col("side"))),
        F.when(F.col("castle") == "K", _ev(2, F.lit(6), home, "A", F.lit("K"), F.col("side"))),
        F.when(F.col("castle") == "K", _ev(3, F.lit(5), home, "A", F.lit("R"), F.col("side"))),
        F.when(F.col("castle") == "Q", _ev(2, F.lit(2), home, "A", F.lit("K"), F.col("side"))),
        F.when(F.col("castle") == "Q", _ev(3, F.lit(3), home, "A", F.lit("R"), F.col("side"))),
        F.when(pawn & F.col("capture"),
               _ev(0, F.col("ff"), F.col("dr") - fwd, "D", F.lit(None), F.col("side"))),
        F.when(pawn & ~F.col("capture") & (F.col("dr") == double_rank),
               _ev(0, F.col("df"), F.col("dr") - fwd, "Q", F.lit(None), F.col("side"))),
        F.when(pawn & ~F.col("capture") & (F.col("dr") != double_rank),
               _ev(0, F.col("df"), F.col("dr") - fwd, "D", F.lit(None), F.col("side"))),
        F.when(F.col("_ep"), _ev(1, F.col("df"), F.col("dr") - fwd, "D", F.lit(None), opp)),
    ]
    return items, ep


def _setup_items():
    cells, z = [], F.lit(0)
    for f, k in enumerate(BACK_RANK):
        cells += [_ev(0, F.lit(f), F.lit(0), "A", F.lit(k), F.lit("w"), z),
                  _ev(0, F.lit(f), F.lit(1), "A", F.lit("P"), F.lit("w"), z),
                  _ev(0, F.lit(f), F.lit(6), "A", F.lit("P"), F.lit("b"), z),
                  _ev(0, F.lit(f), F.lit(7), "A", F.lit(k), F.lit("b"), z)]
    return cells


def move_events(moves: DataFrame, key: str) -> DataFrame:
    """Board events of a (key, ply, san) table: 'A' arrival, 'D' departure,
    'Q' pawn push whose origin is resolved later (see ``resolved_events``)."""
    m = parse_moves(moves, key)
    prev = Window.partitionBy(key).orderBy("ply")
    items, ep = _move_items(F.lag("kind").over(prev), F.lag("capture").over(prev),
                            F.lag("df").over(prev), F.lag("dr").over(prev))
    m = m.withColumn("_ep", ep)
    ev = m.select(key, "side", "capture", "promo", "_ep",
                  F.explode(F.filter(F.array(*items), lambda e: e.isNotNull())).alias("e"))
    ev = ev.select(key, "e.ply", "side", "capture", "promo", "_ep", "e.seq", "e.file", "e.rank", "e.etype",
                   "e.piece", "e.color")
    return ev.where((F.col("file").between(0, 7)) & (F.col("rank").between(0, 7)))


def initial_events(games: DataFrame, key: str) -> DataFrame:
    """The 32 arrivals of the starting position for each game (ply 0)."""
    return games.select(key, F.lit(None).cast("string").alias("side"),
                        F.lit(False).alias("capture"), F.lit(None).cast("string").alias("promo"),
                        F.lit(False).alias("_ep"), F.explode(F.array(*_setup_items())).alias("e")).select(
        key, "e.ply", "side", "capture", "promo", "_ep", "e.seq", "e.file", "e.rank", "e.etype", "e.piece",
        "e.color")


def resolved_events(games: DataFrame, key: str, text: str) -> DataFrame:
    """All events incl. set-up, with each ambiguous pawn push resolved to a
    departure from the 3rd/6th rank (own pawn there) or the start rank, and
    for every arrival the piece and colour that stood there before it.

    One generator over all token rows emits both the set-up (on a game's first
    token) and each half-move's events, so every later window and aggregate
    keeps the single partitioning by game.
    """
    rows = token_rows(games, key, text, context=True)
    main = F.col("mainline")
    parsed = _parsed(F.col("san"), F.col("ply"))
    rows = rows.select("*", *[F.when(main, c).alias(n) for n, c in parsed.items()])
    items, ep = _move_items(F.col("prev_kind"), F.col("prev_capture"), F.col("prev_df"), F.col("prev_dr"))
    rows = rows.withColumn("_ep", F.when(main, ep).otherwise(F.lit(False)))
    empty = F.array().cast(EVENT_TYPE)
    setup = F.when(~F.col("blank") & (F.col("pos") == 0), F.array(*_setup_items())).otherwise(empty)
    # entries of events that do not apply are null; they are dropped after the explode
    # by a plain filter (no higher-order function on this hot path)
    moves_arr = F.when(main, F.array(*items)).otherwise(empty)
    ev = rows.select(key, "side", "capture", "promo", "_ep", F.explode(F.concat(setup, moves_arr)).alias("e"))
    ev = ev.where(F.col("e").isNotNull()).select(
        key, "e.ply", "side", "capture", "promo", "_ep", "e.seq", "e.file", "e.rank", "e.etype", "e.piece", "e.color")
    ev = ev.where((F.col("file").between(0, 7)) & (F.col("rank").between(0, 7)))
    sq = Window.partitionBy(key, "file", "rank").orderBy("ply", "seq")
    before = sq.rowsBetween(Window.unboundedPreceding, -1)
    own_pawn_before = ((F.lag("etype").over(sq) == "A") & (F.lag("piece").over(sq) == "P")
                       & (F.lag("color").over(sq) == F.col("color")))
    fwd = F.when(F.col("color") == "w", 1).otherwise(-1)
    ev = ev.select("*", F.coalesce(own_pawn_before, F.lit(False)).alias("_near"),
                   F.last("piece", ignorenulls=True).over(before).alias("_vp"),
                   F.last(F.when(F.col("piece").isNotNull(), F.col("color")), ignorenulls=True)
                    .over(before).alias("_vc"))
    return ev.select(
        key, "ply", "seq", "file",
        F.when((F.col("etype") == "Q") & ~F.col("_near"), F.col("rank") - fwd).otherwise(F.col("rank")).alias("rank"),
        F.when(F.col("etype") == "Q", "D").otherwise(F.col("etype")).alias("etype"),
        "piece", "color", "side", "capture", "promo", "_ep", "_vp", "_vc")


def _value(col):
    out = F.lit(0)
    for k, v in PIECE_VALUE.items():
        if v:
            out = F.when(col == k, F.lit(v)).otherwise(out)
    return out


def _deltas(events: DataFrame) -> DataFrame:
    """Adds d_white / d_black: material change caused by each event row
    (non-zero only on the mover's arrival: capture victim, promotion gain)."""
    mover = (F.col("etype") == "A") & (F.col("ply") > 0) & (F.col("seq") == 2)
    lost = F.when(F.col("_ep"), F.lit(1)).when(F.col("capture"), _value(F.col("_vp"))).otherwise(0)
    victim = F.when(F.col("_ep"), F.when(F.col("side") == "w", "b").otherwise("w")) \
              .when(F.col("capture"), F.col("_vc"))
    gain = F.when(F.col("promo").isNotNull(), _value(F.col("promo")) - 1).otherwise(0)
    dw = F.when(F.col("side") == "w", gain).otherwise(0) - F.when(victim == "w", lost).otherwise(0)
    db = F.when(F.col("side") == "b", gain).otherwise(0) - F.when(victim == "b", lost).otherwise(0)
    return events.select("*", F.when(mover, dw).otherwise(0).alias("d_white"),
                         F.when(mover, db).otherwise(0).alias("d_black"))


def material_deltas(events: DataFrame, key: str) -> DataFrame:
    """Per half-move (and one set-up row per game): change of white and black material."""
    d = _deltas(events)
    keep = (((F.col("ply") > 0) & (F.col("seq") == 2) & (F.col("etype") == "A"))
            | ((F.col("ply") == 0) & (F.col("file") == 0) & (F.col("rank") == 0)))
    return d.where(keep).select(key, "ply", "d_white", "d_black")


DEFAULT_PHASES = {"open": 20, "mid": 40, "final": None}


def material_timeline(games: DataFrame, key: str, text: str) -> DataFrame:
    """M5: (key, ply, material_white, material_black) after every half-move."""
    d = material_deltas(resolved_events(games, key, text), key)
    run = Window.partitionBy(key).orderBy("ply").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return d.select(key, "ply", (F.lit(39) + F.sum("d_white").over(run)).alias("material_white"),
                    (F.lit(39) + F.sum("d_black").over(run)).alias("material_black"))


def _limit(ply_col, limit):
    return F.lit(True) if limit is None else (ply_col <= F.lit(limit))


def snapshot_material(events: DataFrame, key: str, phases=DEFAULT_PHASES) -> DataFrame:
    """(key, phase, material_white, material_black) at each snapshot."""
    d = material_deltas(events, key)
    aggs = []
    for ph, lim in phases.items():
        aggs += [F.sum(F.when(_limit(F.col("ply"), lim), F.col("d_white")).otherwise(0)).alias(f"w_{ph}"),
                 F.sum(F.when(_limit(F.col("ply"), lim), F.col("d_black")).otherwise(0)).alias(f"b_{ph}")]
    a = d.groupBy(key).agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(ph).alias("phase"), (39 + F.col(f"w_{ph}")).alias("material_white"),
                                        (39 + F.col(f"b_{ph}")).alias("material_black")) for ph in phases]))
    return a.select(key, rows.alias("r")).select(key, "r.*")


def king_square_at(events: DataFrame, key: str, phases=DEFAULT_PHASES) -> DataFrame:
    """M6: (key, phase, color, file, rank) of each king: its last arrival."""
    k = events.where((F.col("etype") == "A") & (F.col("piece") == "K"))
    o = F.col("ply") * 4 + F.col("seq")
    aggs = [F.max_by(F.col("rank") * 8 + F.col("file"), F.when(_limit(F.col("ply"), lim), o)).alias(ph)
            for ph, lim in phases.items()]
    a = k.groupBy(key, "color").agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(ph).alias("phase"), F.col(ph).alias("sq")) for ph in phases]))
    x = a.select(key, "color", rows.alias("r")).where(F.col("r.sq").isNotNull())
    return x.select(key, F.col("r.phase").alias("phase"), "color",
                    (F.col("r.sq") % 8).cast("int").alias("file"), F.floor(F.col("r.sq") / 8).cast("int").alias("rank"))


def pawn_squares_at(events: DataFrame, key: str, phases=DEFAULT_PHASES) -> DataFrame:
    """M6: (key, phase, color, file, rank) of every pawn: squares whose last
    event up to the snapshot is a pawn arrival."""
    o = F.col("ply") * 4 + F.col("seq")
    last = F.struct("etype", "piece", "color")
    aggs = [F.max_by(last, F.when(_limit(F.col("ply"), lim), o)).alias(ph) for ph, lim in phases.items()]
    a = events.groupBy(key, "file", "rank").agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(ph).alias("phase"), F.col(ph).alias("s")) for ph in phases]))
    x = a.select(key, "file", "rank", rows.alias("r"))
    x = x.where((F.col("r.s.etype") == "A") & (F.col("r.s.piece") == "P"))
    return x.select(key, F.col("r.phase").alias("phase"), F.col("r.s.color").alias("color"), "file", "rank")


def snapshot_pieces(events: DataFrame, key: str, phases=DEFAULT_PHASES) -> DataFrame:
    """Pawns and kings at each snapshot as a pieces table (key, phase, file, rank, piece)."""
    letter = lambda kind: F.when(F.col("color") == "w", kind).otherwise(F.lower(F.lit(kind)))
    p = pawn_squares_at(events, key, phases).select(key, "phase", "file", "rank", letter("P").alias("piece"))
    k = king_square_at(events, key, phases).select(key, "phase", "file", "rank", letter("K").alias("piece"))
    return p.unionByName(k)


def game_snapshots(games: DataFrame, key: str, text: str, phases=DEFAULT_PHASES) -> DataFrame:
    """Pieces table (key, phase, file, rank, piece, value) of every snapshot:
    pawns, kings and two material rows per snapshot (piece 'X'/'x', value =
    side material; pawns and kings carry value 0).

    One chain on the game partitioning: events -> one aggregate per (game,
    square) -> one per game (at most 64 squares per snapshot, bounded) ->
    explode.  No branch re-reads the events.
    """
    ev = _deltas(resolved_events(games, key, text))
    o = F.col("ply") * 4 + F.col("seq")
    state = F.struct("etype", "piece", "color")
    per_sq = []
    for ph, lim in phases.items():
        upto = _limit(F.col("ply"), lim)
        per_sq.append(F.max_by(state, F.when(upto, o)).alias(f"s_{ph}"))
        for c in ("w", "b"):
            king = (F.col("etype") == "A") & (F.col("piece") == "K") & (F.col("color") == c) & upto
            per_sq.append(F.max(F.when(king, o)).alias(f"k_{ph}_{c}"))
        per_sq.append(F.sum(F.when(upto, F.col("d_white")).otherwise(0)).alias(f"dw_{ph}"))
        per_sq.append(F.sum(F.when(upto, F.col("d_black")).otherwise(0)).alias(f"db_{ph}"))
    sq = ev.groupBy(key, "file", "rank").agg(*per_sq)
    cell = F.struct("file", "rank")
    per_game = []
    for ph in phases:
        s_ = F.col(f"s_{ph}")
        pawn = (s_.etype == "A") & (s_.piece == "P")
        per_game.append(F.collect_list(F.when(pawn, F.struct("file", "rank", s_.color.alias("color"))))
                        .alias(f"p_{ph}"))
        for c in ("w", "b"):
            per_game.append(F.max_by(cell, F.col(f"k_{ph}_{c}")).alias(f"k_{ph}_{c}"))
        per_game.append((39 + F.sum(f"dw_{ph}")).alias(f"mw_{ph}"))
        per_game.append((39 + F.sum(f"db_{ph}")).alias(f"mb_{ph}"))
    g = sq.groupBy(key).agg(*per_game)

    def piece(file, rank, letter, value):
        return F.struct(file.cast("int").alias("file"), rank.cast("int").alias("rank"),
                        letter.alias("piece"), value.cast("int").alias("value"))

    items = []
    for ph in phases:
        pawns = F.transform(F.col(f"p_{ph}"), lambda p: piece(
            p.file, p.rank, F.when(p.color == "w", F.lit("P")).otherwise(F.lit("p")), F.lit(0)))
        kings = F.filter(F.array(*[
            F.when(F.col(f"k_{ph}_{c}").isNotNull(),
                   piece(F.col(f"k_{ph}_{c}.file"), F.col(f"k_{ph}_{c}.rank"), F.lit("K" if c == "w" else "k"),
                         F.lit(0))) for c in ("w", "b")]), lambda x: x.isNotNull())
        marks = F.array(piece(F.lit(None), F.lit(None), F.lit("X"), F.col(f"mw_{ph}")),
                        piece(F.lit(None), F.lit(None), F.lit("x"), F.col(f"mb_{ph}")))
        items.append(F.struct(F.lit(ph).alias("phase"), F.concat(pawns, kings, marks).alias("pieces")))
    x = g.select(key, F.explode(F.array(*items)).alias("snap"))
    x = x.select(key, F.col("snap.phase").alias("phase"), F.explode("snap.pieces").alias("pc"))
    return x.select(key, "phase", "pc.file", "pc.rank", "pc.piece", "pc.value")


def game_position_features(games: DataFrame, key: str, text: str, phases=DEFAULT_PHASES) -> DataFrame:
    """Long table (key, phase, 43 features) for the snapshots of each game.

    Material comes from the capture/promotion deltas, pawn and king features
    from the board operators applied to the snapshot placements.  Piece reach
    needs every piece's square, which movetext does not give without a
    legality solver, so those three slots stay null.
    """
    from pawnshop.operators import board as B
    from pawnshop.schema import FEATURE_KEYS

    pieces = game_snapshots(games, key, text, phases)
    feats = B.board_features(pieces, [key, "phase"], ("material", "structure", "passed", "king", "dispersion"))
    return feats.select(key, "phase", *[F.col(n) if n in feats.columns else F.lit(None).cast("double").alias(n)
                                        for n in FEATURE_KEYS])
