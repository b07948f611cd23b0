"""Movetext read within its row: main line, material and snapshots (M1, M2, M5, M6).

A game's text is one row already, so nothing is shuffled.  The text is cut at
parentheses, their running depth leaves the main line, and its half-moves are a
list of strings.  These lists go to numpy in Arrow batches, some games at a
time: what happens on a square doesn't depend on the rest of the board, so all
games of a batch are worked out at once from one table of events sorted by
(game, square, half-move):

* an arrival of a piece, a square that a pawn leaves or that is taken in
  passing, and the square of a capture, which reads the last arrival before it;
* a pawn push to the 4th / 5th rank names both squares that it may come from;
  the last event on the nearer one tells which of them is left;
* a pawn stands where the last event up to a half-move is a pawn's arrival.

A game of n half-moves takes time in proportion to n log n.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pawnshop.operators.moves import BACK_RANK, DEFAULT_PHASES, RESULTS, SAN_PATTERN, _clean_body
from pawnshop.schema import PIECE_VALUE

#: Entries by which running lists grow.
PIECE = 64
_CODES = ["P", "N", "B", "R", "Q", "K"]  # code of a piece: its place here, from 1
#: Events of squares that are sorted at a time.
EVENTS = 1 << 19


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _pieces(items: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the list of consecutive slices of at most ``PIECE`` items."""
    last = F.floor((F.size(items) - 1) / PIECE).cast("int")
    at = F.when(F.size(items) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return let(F.transform(at, lambda j: F.slice(items, j * PIECE + 1, F.lit(PIECE))), body)


def _running_sum(deltas: Column) -> Column:
    """Sum of all entries up to each one."""
    empty = F.array().cast("array<int>")

    def after(piece: Column, start: Column) -> Column:
        grown = F.aggregate(piece, F.struct(start.alias("s"), empty.alias("a")),
                            lambda acc, v: F.struct((acc["s"] + v).alias("s"), F.concat(acc["a"], F.array(acc["s"] + v)).alias("a")))
        return grown["a"]

    def joined(pieces: Column) -> Column:
        totals = F.transform(pieces, lambda p: F.aggregate(p, F.lit(0), lambda s, v: s + v))
        starts = F.aggregate(totals, F.struct(F.lit(0).alias("s"), empty.alias("a")),
                             lambda acc, v: F.struct((acc["s"] + v).alias("s"), F.concat(acc["a"], F.array(acc["s"])).alias("a")))["a"]
        return F.flatten(F.zip_with(pieces, starts, after))

    return let(deltas, lambda d: _pieces(d, joined))


def _top_level(text: Column) -> Column:
    """What stands outside parentheses: where as many have been opened as closed."""

    def outside(parts: Column) -> Column:
        deltas = F.transform(parts, lambda p: F.when(p.startswith("("), 1).when(p.startswith(")"), -1).otherwise(0))
        bare = lambda p: F.when(p.startswith("(") | p.startswith(")"), F.substr(p, F.lit(2))).otherwise(p)
        return F.array_join(F.zip_with(parts, _running_sum(deltas), lambda p, d: F.when(d == 0, bare(p)).otherwise(F.lit(""))), " ")

    return let(text, lambda t: F.when(t.contains("(") | t.contains(")"), let(F.split(t, "(?=[()])"), outside)).otherwise(t))


_RESULT = r"(?<!\S)(?:" + "|".join(r.replace("*", r"\*") for r in RESULTS) + r")(?!\S)"
_MOVE = r"(?<!\S)(?:[0-9]+\.+)?(" + SAN_PATTERN.strip("^$") + r")[+#!?]*(?!\S)"


def main_line(text: Column) -> Column:
    """The main line's half-moves as a list; null for null text.

    Comments, variations, annotations, move numbers and unknown tokens are
    passed over; the first result outside variations ends the game.
    """
    ended = lambda t: let(F.regexp_instr(t, F.lit(_RESULT)), lambda at: F.when(at > 0, F.left(t, at - 1)).otherwise(t))
    return F.regexp_extract_all(let(_top_level(_clean_body(text)), ended), F.lit(_MOVE), F.lit(1))


def is_blank(text: Column) -> Column:
    return text.isNull() | text.rlike(r"^\s*$")


def movetext_tokens(df: DataFrame, key: str, text: str) -> DataFrame:
    """M1: main-line half-moves (key, ply, san) of each row's text.  Rows may
    share a key or have none: each text is a game of its own."""
    return df.select(key, F.posexplode(main_line(F.col(text))).alias("_pos", "san")).select(key, (F.col("_pos") + 1).alias("ply"), "san")


def total_moves(df: DataFrame, key: str, text: str) -> DataFrame:
    """M2: ceil(half-moves / 2); 0 without moves; null for null or blank text."""
    n = F.ceil(F.size(main_line(F.col(text))) / 2).cast("int")
    return df.select(key, F.when(~is_blank(F.col(text)), n).alias("total_moves"))


# --------------------------------------------------------------------------- half-moves of many games

@lru_cache(maxsize=1 << 16)
def _read(san: str) -> tuple[int, ...]:
    """What a half-move's text says: code, castling (1 king's, 2 queen's side), capture, promotion's code, file and rank, origin file."""
    first, last, n = san[0], san[-1], len(san)
    castle = (2 if n >= 5 else 1) if first in "O0" else 0
    code = len(_CODES) if castle else _CODES.index(first) + 1 if first in _CODES else 1
    promo = _CODES.index(last) + 1 if code == 1 and last in "NBRQ" else 0
    end = n - (promo > 0) - ("=" in san)
    file, rank = ord(san[end - 2]) - 97, ord(san[end - 1]) - 49
    capture = "x" in san
    return code, castle, int(capture), promo, file, rank, ord(first) - 97 if code == 1 and capture else file


_ARRIVES, _GONE, _MAYBE, _START, _TAKES = range(5)  # events of a square; at one half-move they count in the order of _SEQ
_SEQ = np.array([2, 1, 1, 1, 0])
_VALUES = np.array([0] + [PIECE_VALUE.get(k, 0) for k in _CODES])


def _setup() -> np.ndarray:
    """(square, code, side) of the 32 pieces."""
    return np.array([(r * 8 + f, _CODES.index(k) + 1, dark) for f, piece in enumerate(BACK_RANK)
                     for r, k, dark in ((0, piece, 0), (1, "P", 0), (6, "P", 1), (7, piece, 1))])


class _Fold:
    """Half-moves of some games, given as one array of texts and the games' lengths."""

    def __init__(self, san: pa.Array, lengths: np.ndarray):
        told = san.dictionary_encode()
        m = np.array([_read(x) for x in told.dictionary.to_pylist()], dtype=np.int64).reshape(-1, 7)[told.indices.to_numpy(zero_copy_only=False)]
        self.lengths, self.start = lengths, np.cumsum(lengths) - lengths
        self.game = np.repeat(np.arange(len(lengths)), lengths)
        self.ply = np.arange(len(m)) - self.start[self.game] + 1
        self.side = (self.ply - 1) % 2
        self.code, self.castle, self.capture, self.promo, self.file, self.rank, self.origin = m.T
        home = self.side * 56
        self.square = np.where(self.castle == 1, home + 6, np.where(self.castle == 2, home + 2, self.rank * 8 + self.file))
        self._events()
        self._material()

    def _events(self) -> None:
        """The events of all squares in order: ``key`` holds (game, square) above half-move and order within it."""
        n, every = len(self.ply), np.arange(len(self.ply))
        pawn, forward, behind = self.code == 1, 1 - 2 * self.side, self.rank - (1 - 2 * self.side)
        before = np.maximum(every - 1, 0)
        self.passing = (pawn & (self.capture == 1) & (self.rank == np.where(self.side == 0, 5, 2)) & (self.ply > 1) & (self.code[before] == 1)
                        & (self.capture[before] == 0) & (self.file[before] == self.file) & (self.rank[before] == behind))
        left = pawn & (behind >= 0) & (behind <= 7)
        double = pawn & (self.capture == 0) & (self.rank == np.where(self.side == 0, 3, 4))
        comes = behind * 8 + self.origin
        home = self.side * 56
        setup, games = _setup(), len(self.lengths)
        parts = [(_ARRIVES, every, self.square, np.where(self.promo > 0, self.promo, self.code))]
        rook = every[self.castle > 0]
        parts.append((_ARRIVES, rook, (home + np.where(self.castle == 1, 5, 3))[rook], np.full(len(rook), _CODES.index("R") + 1)))
        for kind, where, square in ((_GONE, left & ~double, comes), (_GONE, self.passing, behind * 8 + self.file), (_MAYBE, double, comes),
                                    (_START, double, comes - forward * 8), (_TAKES, (self.capture == 1) & ~self.passing & (self.castle == 0), self.square)):
            at = every[where]
            parts.append((kind, at, square[at], np.zeros(len(at), dtype=np.int64)))
        kind = np.concatenate([np.full(games * len(setup), _ARRIVES), *[np.full(len(p[1]), p[0]) for p in parts]])
        move = np.concatenate([np.full(games * len(setup), -1), *[p[1] for p in parts]])
        square = np.concatenate([np.tile(setup[:, 0], games), *[p[2] for p in parts]])
        code = np.concatenate([np.tile(setup[:, 1], games), *[p[3] for p in parts]])
        of = lambda x, first: np.concatenate([first, x[move[games * len(setup):]]])
        side = of(self.side, np.tile(setup[:, 2], games))
        ply = of(self.ply, np.zeros(games * len(setup), dtype=np.int64))
        place = of(self.game, np.repeat(np.arange(games), len(setup))) * 64 + square
        order = np.argsort((place << 34) | (ply << 2) | _SEQ[kind], kind="stable")
        self.kind, self.move, self.held_code, self.held_side, self.at, self.place = kind[order], move[order], code[order], side[order], ply[order], place[order]
        arrival = self._earlier(self.kind == _ARRIVES)
        takes = np.flatnonzero(self.kind == _TAKES)
        found = arrival[takes]
        self.taken, self.from_black = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool)
        self.taken[self.move[takes]] = np.where(found >= 0, _VALUES[self.held_code[found]], 0)
        self.from_black[self.move[takes]] = (found >= 0) & (self.held_side[found] == 1)
        # a push of one rank if an own pawn came to the nearer square last
        maybe = np.flatnonzero(self.kind == _MAYBE)
        near = self._earlier(self.kind <= _MAYBE)[maybe]
        one = np.zeros(n, dtype=bool)
        one[self.move[maybe]] = ((near >= 0) & (self.kind[near] == _ARRIVES) & (self.held_code[near] == 1)
                                 & (self.held_side[near] == self.held_side[maybe]))
        self.counts = (self.kind <= _GONE) | (((self.kind == _MAYBE) & one[self.move]) if n else False) | (((self.kind == _START) & ~one[self.move]) if n else False)

    def _earlier(self, chosen: np.ndarray) -> np.ndarray:
        """For each event the last chosen one before it on its square, or -1."""
        last = np.maximum.accumulate(np.where(chosen, np.arange(len(chosen)), -1))
        last = np.concatenate([[-1], last[:-1]])
        return np.where((last >= 0) & (self.place[last] == self.place), last, -1)

    def _material(self) -> None:
        """Sums of what both sides have won or lost before each half-move, over all games."""
        white = self.side == 0
        lost = np.where(self.passing, np.where(white, -1, 1), np.where(self.from_black, -self.taken, self.taken))
        gain = np.maximum(_VALUES[self.promo] - 1, 0)
        first = np.zeros(1, dtype=np.int64)
        self.white = np.concatenate([first, np.cumsum(np.where(white, gain, 0) - np.maximum(lost, 0))])
        self.black = np.concatenate([first, np.cumsum(np.where(white, 0, gain) + np.minimum(lost, 0))])

    def material(self, game: np.ndarray, ply: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        since, whole = self.start[game], sum(PIECE_VALUE.get(k, 0) for k in BACK_RANK) + 8
        return tuple((whole + x[since + ply] - x[since]).astype(np.int32) for x in (self.white, self.black))

    def snapshot(self, limit: int | None) -> list[np.ndarray]:
        """The columns of ``_SNAPSHOT`` after half-move ``limit`` of each game or at the end of a shorter one."""
        games = np.arange(len(self.lengths))
        ply = self.lengths if limit is None else np.minimum(self.lengths, limit)
        chosen = self.counts if limit is None else self.counts & (self.at <= limit)
        ends = np.flatnonzero(np.concatenate([self.place[1:] != self.place[:-1], np.ones(min(len(self.place), 1), dtype=bool)]))
        last = np.maximum.accumulate(np.where(chosen, np.arange(len(chosen)), -1))[ends]
        last = last[(last >= 0) & (self.place[last] == self.place[ends])]
        last = last[(self.kind[last] == _ARRIVES) & (self.held_code[last] == 1)]
        out = []
        for side in (0, 1):
            own = self.place[last[self.held_side[last] == side]]
            mask = np.zeros(len(games), dtype=np.uint64)
            np.bitwise_or.at(mask, own >> 6, np.uint64(1) << (own & 63).astype(np.uint64))
            out.append(mask.view(np.int64))
        for side in (0, 1):
            king = (self.code == len(_CODES)) & (self.side == side)
            moved = np.concatenate([[-1], np.maximum.accumulate(np.where(king, np.arange(len(king)), -1))])[self.start + ply]
            home = BACK_RANK.index("K") + 56 * side
            out.append((np.where(moved >= self.start, self.square[moved], home) if len(king) else np.full(len(games), home)).astype(np.int32))
        return [*out, *self.material(games, ply)]


_SNAPSHOT = "white_pawns bigint, black_pawns bigint, white_king int, black_king int, material_white int, material_black int"


def _some_games(batch: pa.RecordBatch):
    """(columns without the last, the last one's lists) of consecutive games with about ``EVENTS`` events together."""
    line = batch.column(batch.num_columns - 1)
    lengths = pc.fill_null(pc.list_value_length(line), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(lengths * 3 + 32) - 1) // EVENTS
    first = np.flatnonzero(np.concatenate([np.ones(min(len(part), 1), dtype=bool), part[1:] != part[:-1]])).tolist()
    for a, b in zip(first, [*first[1:], len(part)], strict=True):
        some = batch.slice(a, b - a)
        line = some.column(some.num_columns - 1)
        yield some.columns[:-1], line, _Fold(line.flatten(), lengths[a:b].astype(np.int64))


def _with_line(games: DataFrame, text: str) -> DataFrame:
    """``games`` with the main line (null for a blank text) as last column instead of the text."""
    return games.select(*[c for c in games.columns if c != text], F.when(~is_blank(F.col(text)), main_line(F.col(text))).alias("_line"))


def folded(games: DataFrame, text: str, phases=DEFAULT_PHASES) -> DataFrame:
    """M2-M6: ``games`` without the text, with ``total_moves`` and ``snaps``: an entry (phase, pawn masks, king squares,
    material) for each phase, in the order of the half-moves; both are null for a blank text.

    The text is read once and doesn't leave its row; whatever is joined or
    shuffled afterwards is a few numbers a game."""
    order = sorted(phases, key=lambda p: (phases[p] is None, phases[p] or 0))
    lines = _with_line(games, text)
    schema = T.StructType([*lines.schema.fields[:-1], T.StructField("total_moves", T.IntegerType()),
                           T.StructField("snaps", T.ArrayType(T.DataType.fromDDL(f"phase string, {_SNAPSHOT}")))])
    names, entry = schema.names, ["phase", *[c.split()[0] for c in _SNAPSHOT.split(", ")]]

    def fold(batches):
        for batch in batches:
            for kept, line, f in _some_games(batch):
                n, blank = len(f.lengths), np.asarray(line.is_null())
                # the entries of a game stand together
                columns = [np.stack(c, axis=1).ravel() for c in zip(*[f.snapshot(phases[p]) for p in order], strict=True)]
                snaps = pa.StructArray.from_arrays([pa.array(order * n, pa.string()), *map(pa.array, columns)], entry)
                offsets = pa.array(np.arange(n + 1, dtype=np.int32) * len(order))
                yield pa.RecordBatch.from_arrays([*kept, pa.array(((f.lengths + 1) // 2).astype(np.int32), mask=blank),
                                                  pa.ListArray.from_arrays(offsets, snaps, mask=pa.array(blank))], names)

    return lines.mapInArrow(fold, schema)


def snapshot_rows(games: DataFrame, keep: list[str]) -> DataFrame:
    """(keep..., phase, white_pawns, ...): a row for each entry of a folded table's ``snaps``."""
    return games.select(*keep, F.explode("snaps").alias("_s")).select(*keep, "_s.*")


def snapshots(games: DataFrame, key: str, text: str, phases=DEFAULT_PHASES) -> DataFrame:
    """M3/M4/M6: (key, phase, white_pawns, black_pawns, white_king, black_king,
    material_white, material_black) of every game that isn't blank: pawn masks,
    king squares and material after the phase's half-move, or at the end of a
    shorter game."""
    return snapshot_rows(folded(games.select(key, text), text, phases), [key])


def _squares(x: DataFrame, key: str, white: Column, black: Column) -> DataFrame:
    """One row for each square of two lists."""
    placed = lambda squares, color: F.transform(squares, lambda s: F.struct(F.lit(color).alias("color"), s.alias("s")))
    x = x.select(key, "phase", F.explode(F.concat(placed(white, "w"), placed(black, "b"))).alias("p"))
    return x.select(key, "phase", "p.color", (F.col("p.s") % 8).cast("int").alias("file"), F.floor(F.col("p.s") / 8).cast("int").alias("rank"))


def king_squares(games: DataFrame, key: str, text: str, phases=DEFAULT_PHASES) -> DataFrame:
    """M6: (key, phase, color, file, rank) of each king."""
    return _squares(snapshots(games, key, text, phases), key, F.array("white_king"), F.array("black_king"))


def pawn_squares(games: DataFrame, key: str, text: str, phases=DEFAULT_PHASES) -> DataFrame:
    """M6: (key, phase, color, file, rank) of every pawn."""
    bits = lambda mask: F.filter(F.sequence(F.lit(0), F.lit(63)), lambda s: F.call_function("shiftright", F.col(mask), s).bitwiseAND(F.lit(1).cast("bigint")) == 1)
    return _squares(snapshots(games, key, text, phases), key, bits("white_pawns"), bits("black_pawns"))


def material_timeline(games: DataFrame, key: str, text: str) -> DataFrame:
    """M5: (key, ply, material_white, material_black) from the set-up (ply 0) on, after every half-move."""
    lines = _with_line(games.select(key, text), text)
    schema = T.StructType([lines.schema[key], *T.DataType.fromDDL("ply int, material_white int, material_black int").fields])

    def fold(batches):
        for batch in batches:
            for (keys,), line, f in _some_games(batch):
                rows = np.where(np.asarray(line.is_null()), 0, f.lengths + 1)
                game = np.repeat(np.arange(len(rows)), rows)
                ply = np.arange(len(game)) - (np.cumsum(rows) - rows)[game]
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(game)), *map(pa.array, (ply.astype(np.int32), *f.material(game, ply)))], schema.names)

    return lines.mapInArrow(fold, schema)


def game_position_features(games: DataFrame, key: str, text: str, phases=DEFAULT_PHASES) -> DataFrame:
    """Long table (key, phase, 43 features) for the snapshots of each game, computed within each game's row.

    Piece reach needs every piece's square, which movetext does not give without
    a legality solver, so those three slots stay null.
    """
    return snapshot_features(snapshots(games, key, text, phases), [key])


def snapshot_features(x: DataFrame, keep: list[str]) -> DataFrame:
    """(keep..., phase, 43 features) of rows of ``snapshots``."""
    from pawnshop.operators import board as B
    from pawnshop.schema import FEATURE_KEYS

    feats = B.mask_features(x, [*keep, "phase"], ("material", "structure", "passed", "king", "dispersion"))
    return feats.select(*keep, "phase", *[F.col(n) if n in feats.columns else F.lit(None).cast("double").alias(n) for n in FEATURE_KEYS])
