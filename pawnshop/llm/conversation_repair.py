"""Repair of conversation structure: the cheapest edits that make roles follow ``(s?(ua)+)?``, least audit first.

Every row is kept, given another role or deleted, and empty rows may be
inserted; ``COSTS`` says at what price.  Rows that must go (blank ones and
repetitions) don't change the state, so only the others enter the search.

The rows of all conversations are put in order by ranges and cut into blocks of
``BLOCK`` rows, whatever conversation they belong to.  In a block, the costs of
a row are a min-plus matrix over the four states of the role pattern; products
over power-of-two stretches give every node's cost to the end.  Arcs that keep
that cost are optimal.  Their nodes are ranked by the first letter of the least
audit from there on, then by 2, 4, 8 .. letters, where the next letters' rank
lies behind a pointer that doubles along; the ranks choose the arc of each node
and the doubled pointers mark the nodes of the least path.  A conversation that
spans blocks is handled in the same way one level up: joins at distances of 1,
2, 4 .. blocks multiply the matrices of its pieces and compose where each leads.

No task holds a conversation: even one with a third of all rows is spread over
blocks.  Its audit and hash are one value each, so their parts pass one task,
row by row, in the end.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pawnshop.llm.frames import settled

#: Rows of a block; a group of Python rows is never larger.
BLOCK = 4096
#: Price of each edit, and of a row that stays without its end.
COSTS = {"D": 3, "I": 2, "K": 0, "R": 2}
TRUNCATED = 1
# States of the role pattern: nothing yet, after the system row, after a user row, after an assistant row.
_STATES = range(4)
_NEXT = np.array([2, 2, 3, 2])  # the turn that may follow a state: the user's or the assistant's
_ROLE_INTO = {2: "user", 3: "assistant"}
_KEPT = {"s": [1, -1, -1, -1], "u": [2, 2, -1, 2], "a": [-1, -1, 3, -1]}
_ENDS = [True, False, False, True]
_FAR = np.int64(1) << 40
_OPS = "DKR"  # in a row's code: two bits of the edit, two of the state before it, then the insertions
#: Adjacent initials that are in order.
LEGAL = ("su", "ua", "au")

_WHITE = r"\x20\x09-\x0D"


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) with faults dealt by crc32(conv_id:turn) modulo 20; a null counts as one space there.

    0 drops the row, 1 empties its text, 2 removes its full stops, exclamation
    and question marks, 3 repeats it, 4 makes it the user's.
    """
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(or_space(conv_col), F.lit(":"), or_space(turn_col))), F.lit(20))
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(or_space(text_col), "[.!?]", "")).otherwise(or_space(text_col))
    return rows.filter(kind != 0).select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(or_space(role_col)).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy")).drop("copy")


# --- one block ----------------------------------------------------------------------------------------------------


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus products of stacked 4 x 4 matrices."""
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(-2), _FAR)


def _insertions() -> np.ndarray:
    """Cheapest way from state to state by insertions alone."""
    out = np.full((4, 4), _FAR)
    for s in _STATES:
        t, price = s, 0
        for _ in range(3):
            out[s, t] = min(out[s, t], price)
            t, price = int(_NEXT[t]), price + COSTS["I"]
    return out


_INSERT = _insertions()
#: Cost from each state after the last row.
_FINAL = np.array([min(int(_INSERT[s, t]) for t in _STATES if _ENDS[t]) for s in _STATES], np.int64)
_IDENTITY = np.where(np.eye(4, dtype=bool), 0, _FAR)


class Block:
    """Consecutive rows in order; a piece is what the block holds of one conversation."""

    def __init__(self, table: pa.Table):
        table = table.sort_by("ord")
        conv = table["conv_id"].combine_chunks().dictionary_encode()
        codes = conv.indices.fill_null(-1).to_numpy()
        self.table = table
        self.starts = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
        self.piece = np.cumsum(np.isin(np.arange(len(codes)), self.starts)) - 1
        self.initial = np.array(table["initial"].to_pylist())
        live = table["live"].to_numpy()
        self.rows = np.flatnonzero(live)
        self.of = self.piece[self.rows]
        self.extra = np.where(table["truncated"].to_numpy()[self.rows], TRUNCATED, 0)
        kept = np.full((len(self.rows), 4), -1)
        for letter, into in _KEPT.items():
            kept[self.initial[self.rows] == letter] = into
        self.kept = kept
        self.matrix = self._matrices()

    def _matrices(self) -> np.ndarray:
        m = np.full((len(self.rows), 4, 4), _FAR)
        for s in _STATES:
            m[:, s, s] = COSTS["D"]
            m[:, s, _NEXT[s]] = np.minimum(m[:, s, _NEXT[s]], COSTS["R"] + self.extra)
            ok = np.flatnonzero(self.kept[:, s] >= 0)
            to = self.kept[ok, s]
            m[ok, s, to] = np.minimum(m[ok, s, to], COSTS["K"] + self.extra[ok])
        return _times(np.broadcast_to(_INSERT, m.shape), m)

    def to_end(self) -> np.ndarray:
        """Product of the matrices from each live row to its piece's end, over stretches of 1, 2, 4 .. rows."""
        out, step = self.matrix.copy(), 1
        longest = np.bincount(self.of).max() if len(self.of) else 0
        while step < longest:
            i = np.flatnonzero(self.of[:-step] == self.of[step:])
            out[i] = _times(out[i], out[i + step])
            step *= 2
        return out

    def products(self) -> np.ndarray:
        """One matrix for each piece."""
        out = np.broadcast_to(_IDENTITY, (len(self.starts), 4, 4)).copy()
        first = np.flatnonzero(np.append(True, self.of[1:] != self.of[:-1])) if len(self.of) else np.zeros(0, int)
        out[self.of[first]] = self.to_end()[first]
        return out

    def least_paths(self, end: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(code of every row, state at the end) of the least cheapest path from each state in which a piece may begin.

        ``end`` is each piece's cost from the states at its end, ``last`` tells
        whether its conversation ends there.
        """
        n, pieces = len(self.rows), len(self.starts)
        level = np.arange(n) + self.of  # every piece has one more level than live rows
        count = np.bincount(self.of, minlength=pieces)
        end_level = np.cumsum(count + 1) - 1
        cost = np.zeros((n + pieces, 4), np.int64)
        cost[end_level] = end
        cost[level] = (self.to_end() + end[self.of][:, None, :]).min(-1)
        target, letter = self._optimal_arcs(cost, level, end_level[last])
        size = 4 * (n + pieces)
        own = np.arange(size)
        # ranks of the least audits of 1, 2, 4 .. letters; a node without an arc ends there and ranks first
        terminal = (target < 0).all(1)
        best = letter.min(1)
        rank = np.where(terminal, 0, best)
        step = np.where(terminal, own, target[own, np.argmin(letter, 1)])
        moves = int((np.bincount(self.of).max() if n else 0) * 3 + 4)
        for _ in range(moves.bit_length()):
            pair = rank * np.int64(size + 5) + np.where(terminal, 0, rank[step] + 1)
            rank = np.unique(pair, return_inverse=True)[1].astype(np.int64)
            step = step[step]
        # the arc of least letter, then of least rank behind it
        behind = np.where(target >= 0, letter * np.int64(size + 5) + rank[np.maximum(target, 0)], np.int64(1) << 60)
        chosen = np.argmin(behind, 1)
        doubled = [np.where(terminal, own, target[own, chosen])]
        while len(doubled) < moves.bit_length() + 1:
            doubled.append(doubled[-1][doubled[-1]])
        first_level = end_level - count
        start = (first_level[:, None] * 4 + np.arange(4)).ravel()
        exits = (doubled[-1][start] & 3).reshape(pieces, 4)
        path, entry = start[~terminal[start]], np.tile(np.arange(4), pieces)[~terminal[start]]
        for pointers in reversed(doubled[:-1]):
            further = pointers[path]
            go = ~terminal[further]
            path, entry = np.concatenate([path, further[go]]), np.concatenate([entry, entry[go]])
        return self._codes(path, entry, letter[path, chosen[path]], level), exits

    def _optimal_arcs(self, cost: np.ndarray, level: np.ndarray, last_levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(target, letter) of the four possible edits of each node; no target where an edit isn't optimal."""
        size = cost.size
        target = np.full((size, 4), -1, np.int64)
        for s in _STATES:
            here, below = level * 4 + s, (level + 1) * 4
            offers = [(0, below + s, COSTS["D"], True),
                      (2, below + self.kept[:, s], COSTS["K"] + self.extra, self.kept[:, s] >= 0),
                      (3, below + _NEXT[s], COSTS["R"] + self.extra, True)]
            for k, to, price, ok in offers:
                good = (cost.ravel()[np.minimum(np.maximum(to, 0), size - 1)] + price == cost.ravel()[here]) & ok
                target[here[good], k] = to[good]
            where = np.concatenate([level, last_levels])
            good = cost[where, _NEXT[s]] + COSTS["I"] == cost[where, s]
            target[where[good] * 4 + s, 1] = where[good] * 4 + _NEXT[s]
        # D, I, K, R are in ASCII order already
        letter = np.where(target >= 0, np.arange(1, 5), 9)
        return target, letter.astype(np.int64)

    def _codes(self, path: np.ndarray, entry: np.ndarray, letter: np.ndarray, level: np.ndarray) -> np.ndarray:
        """Code of each row for every state in which its piece may begin, a byte each."""
        n = len(self.rows)
        row_of = np.full(path.max() // 4 + 2 if len(path) else 1, -1)
        row_of[level[level < len(row_of)]] = np.flatnonzero(level < len(row_of))
        row = row_of[path >> 2]
        inside = row >= 0
        row, entry, letter, state = row[inside], entry[inside], letter[inside], path[inside] & 3
        codes = np.zeros((n, 4), np.int64)
        edit = letter != 2
        np.add.at(codes, (row[~edit], entry[~edit]), 16)
        op = np.array([0, 0, 0, 1, 2])[letter[edit]]
        codes[row[edit], entry[edit]] += state[edit] * 4 + op
        return (codes << (8 * np.arange(4))).sum(1)


def _pieces(table: pa.Table) -> pa.Table:
    """The first and the last piece of a block, which others may continue."""
    block = Block(table)
    m = block.products()
    ends = np.append(block.starts[1:], table.num_rows) - 1
    pick = np.unique([0, len(block.starts) - 1])
    at = block.starts[pick]
    return pa.table({"conv_id": block.table["conv_id"].take(at), "block": block.table["block"].take(at),
                     "m": pa.array(m[pick].reshape(-1, 16).tolist(), pa.list_(pa.int64())),
                     "last": pa.array(block.initial[ends[pick]].tolist(), pa.string())})


_CARRIED = ("conv_id", "turn", "role", "head", "digest", "n", "live", "truncated", "block")


def _coded(table: pa.Table, ends: pa.Table) -> pa.Table:
    """Codes of a block's rows, whether a row stands illegally behind another, and in a piece's first row where it leads."""
    block = Block(table)
    pieces = len(block.starts)
    end, last = np.broadcast_to(_FINAL, (pieces, 4)).copy(), np.ones(pieces, bool)
    before = np.full(pieces, None, object)
    # a cut conversation lies at the block's beginning or end
    convs = block.table["conv_id"].take(block.starts).to_pylist()
    for r in ends.to_pylist():
        k = 0 if convs[0] == r["conv_id"] else pieces - 1
        before[k] = r["before"]
        if r["after"] is not None:
            end[k], last[k] = r["after"], False
    codes = np.zeros(table.num_rows, np.int64)
    codes[block.rows], exits = block.least_paths(end, last)
    first = np.zeros(table.num_rows, bool)
    first[block.starts] = True
    previous = np.append([""], block.initial[:-1]).astype(object)
    previous[block.starts] = before
    pairs = [None if p is None else p + i for p, i in zip(previous.tolist(), block.initial.tolist(), strict=True)]
    n = block.table["n"].to_numpy()
    own = np.array([i + i in LEGAL for i in block.initial.tolist()])
    illegal = np.array([p is not None and p not in LEGAL for p in pairs]) + np.where(own, 0, n - 1)
    lead = np.full(table.num_rows, None, object)
    lead[block.starts] = (exits << (2 * np.arange(4))).sum(1)
    return pa.table({c: block.table[c] for c in _CARRIED} | {
        "codes": pa.array(codes, pa.int64()), "illegal": pa.array(illegal.astype(np.int64)), "leads": pa.array(lead.tolist(), pa.int64())})


# --- conversations over several blocks ----------------------------------------------------------------------------


def _product(a: Column, b: Column) -> Column:
    return F.array(*[F.least(*[a[4 * i + k] + b[4 * k + j] for k in _STATES], F.lit(int(_FAR))) for i in _STATES for j in _STATES])


def _rounds(spans: DataFrame) -> int:
    widest = spans.agg(F.max(F.col("to") - F.col("from"))).first()[0]
    return int(widest).bit_length() if widest else 0


def _far_blocks(cut: DataFrame, column: str, combine, rounds: int, sign: int) -> DataFrame:
    """``column`` of each piece combined with all pieces of its conversation behind it (``sign`` 1) or before it (-1)."""
    for k in range(rounds):
        other = cut.select(F.col("conv_id").alias("c"), (F.col("block") - sign * (1 << k)).alias("b"), F.col(column).alias("other"))
        cut = (cut.join(other, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")), "left")
               .withColumn(column, F.when(F.col("other").isNull(), F.col(column)).otherwise(combine(F.col(column), F.col("other"))))
               .drop("c", "b", "other"))
        cut = settled(cut, "doubled")
    return cut


def _neighbour(cut: DataFrame, columns: dict[str, Column], step: int) -> DataFrame:
    """``cut`` with values of the same conversation's piece ``step`` blocks on, null where there is none."""
    other = cut.select(F.col("conv_id").alias("c"), (F.col("block") - step).alias("b"), *[v.alias(k) for k, v in columns.items()])
    return cut.join(other, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")), "left").drop("c", "b")


def _bits(packed: Column, place: Column | int, width: int) -> Column:
    """The ``place``-th number of ``width`` bits."""
    shift = (F.lit(place) if isinstance(place, int) else place) * width
    return F.call_function("shiftright", packed, shift.cast("int")).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _through(first: Column, then: Column) -> Column:
    """States packed two bits each: where ``first`` leads, then ``then``."""
    return reduce(lambda a, b: a + b, [_bits(then, _bits(first, s, 2), 2) * (4 ** s) for s in _STATES])


# --- whole tables -------------------------------------------------------------------------------------------------


def _light(rows: DataFrame) -> DataFrame:
    """Rows without their texts, but with what the search needs of them."""
    text = F.col("text")
    blank = ~text.rlike(f"[^{_WHITE}]")
    return rows.select(
        "conv_id", "turn", "role", F.substring("text", 1, 64).alias("head"), F.unhex(F.sha2("text", 256)).alias("digest"),
        blank.alias("blank"), (~blank & ~text.rlike(f"[.!?][{_WHITE}]*\\z")).alias("truncated"))


_ORDER = ("conv_id", "turn", "role", "head", "digest")


def _ordered(rows: DataFrame) -> DataFrame:
    """One row for all copies, in order, with its dense block number; ``first``: nothing alike comes before it."""
    light = _light(rows)
    alike = ["conv_id", "role", "digest"]
    # the earliest of alike rows, marked by a row of no copies: no join on a key that may be hot
    earliest = (light.groupBy(*alike, "head", "blank", "truncated").agg(F.min(F.struct(F.col("turn").isNotNull().alias("is"), "turn")).alias("t"))
                .select("conv_id", F.col("t.turn").alias("turn"), "role", "head", "digest", "blank", "truncated",
                        F.lit(0).cast("long").alias("n"), F.lit(True).alias("first")))
    every = light.withColumns({"n": F.lit(1).cast("long"), "first": F.lit(False)})
    grouped = (every.unionByName(earliest).groupBy(*_ORDER, "blank", "truncated").agg(F.sum("n").alias("n"), F.max("first").alias("first")))
    ranged = grouped.repartitionByRange(*[F.col(c).asc_nulls_first() for c in _ORDER]).sortWithinPartitions(*_ORDER)
    put = settled(ranged.withColumn("ord", F.monotonically_increasing_id()), "ordered")
    part, inside = F.shiftright("ord", 33), (F.col("ord") % (1 << 33) / BLOCK).cast("long")
    put = put.withColumns({"part": part, "inside": inside})
    # one row for each partition of the ordered table
    sizes = put.groupBy("part").agg((F.max("inside") + 1).alias("blocks"))
    start = F.coalesce(F.sum("blocks").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("part", start.alias("start"))
    return put.join(offsets, "part").select(
        *_ORDER, "n", "blank", "first", "ord", (F.col("start") + F.col("inside")).alias("block"),
        (F.col("first") & ~F.col("blank")).alias("live"), "truncated", F.substring("role", 1, 1).alias("initial"))


def edits(rows: DataFrame) -> DataFrame:
    """The cheapest edits of every row of ``rows`` (conv_id, turn, role, text), least audit first among equals.

    Returns conv_id, turn, role, head (the text's first 64 characters), digest
    (its SHA-256), n (copies of the row), live (nothing alike came before it and it isn't blank),
    truncated, illegal (times that it stands illegally behind its
    predecessor) and code: the edit of the first copy (0 delete, 1 keep, 2 give
    the role that the state asks for), the state before it times 4, and 16 for
    each insertion before it.  All other copies are deleted.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    put = settled(_ordered(rows), "blocks")
    seen = put.select("conv_id", "ord", "block", "initial", "live", "truncated")
    pieces = settled(seen.groupBy("block").applyInArrow(_pieces, f"conv_id {kind}, block long, m array<long>, last string"), "pieces")
    spans = settled(pieces.groupBy("conv_id").agg(F.min("block").alias("from"), F.max("block").alias("to")).filter(F.col("to") > F.col("from")), "spans")
    rounds = _rounds(spans)
    cut = pieces.join(spans.select(F.col("conv_id").alias("c")), F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    cut = _far_blocks(cut, "m", _product, rounds, 1)
    rest = F.array(*[F.least(*[F.col("m")[4 * i + j] + int(_FINAL[j]) for j in _STATES]) for i in _STATES])
    ends = _neighbour(_neighbour(cut, {"after": rest}, 1), {"before": F.col("last")}, -1).select("conv_id", "block", "after", "before")
    fields = ", ".join(f"{c} {put.schema[c].dataType.simpleString()}" for c in _CARRIED)
    coded = settled(put.select(*_CARRIED, "ord", "initial").groupBy("block").cogroup(ends.groupBy("block"))
                    .applyInArrow(_coded, f"{fields}, codes long, illegal long, leads long"), "coded")
    # the state in which each piece of a cut conversation begins
    leads = coded.filter("leads is not null").select("conv_id", "block", "leads")
    leads = leads.join(spans.select(F.col("conv_id").alias("c")), F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    leads = _far_blocks(leads, "leads", lambda own, earlier: _through(earlier, own), rounds, -1)
    begin = _neighbour(leads, {"entry": _bits(F.col("leads"), 0, 2)}, -1).filter("entry is not null").select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "entry")
    found = coded.join(begin, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")), "left")
    entry = F.coalesce("entry", F.lit(0).cast("long"))
    code = _bits(F.col("codes"), entry, 8).cast("int")
    return found.select("conv_id", "turn", "role", "head", "digest", "n", "live", "truncated", "illegal", code.alias("code"))


def _stream(batches):
    """Rows sorted by conversation and order, the counts of a conversation first, each row's code before its texts."""
    state = None

    def close():
        if state is None:
            return None
        for role in _ENDING[state["at"]]:
            _put(state, role, "")
            state["cost"] += COSTS["I"]
            state["audit"].append("I")
        return [state["conv"], *state["counts"], state["cost"], "".join(state["audit"]), state["sha"].hexdigest()]

    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    for batch in batches:
        out = []
        cols = [batch.column(c).to_pylist() for c in ("conv_id", "kind", "code", "n", "live", "truncated", "role", "text", "counts")]
        for conv, kind, code, n, live, truncated, role, text, counts in zip(*cols, strict=True):
            if kind == 0:
                if (done := close()) is not None:
                    out.append(done)
                state = {"conv": conv, "counts": counts, "cost": 0, "audit": [], "sha": hashlib.sha256(), "at": 0, "any": False, "new": None}
            elif kind == 1:
                _edit(state, code, n, live, truncated, role)
            elif state["new"] is not None:
                _put(state, state["new"], text)
                state["new"] = None
        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], _schema(batch.schema))
        schema = batch.schema
    if state is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(names, close(), strict=True))], _schema(schema))


#: Roles to insert after the last row, by state.
_ENDING = {0: [], 1: ["user", "assistant"], 2: ["assistant"], 3: []}


def _schema(schema: pa.Schema) -> pa.Schema:
    long = [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return pa.schema([schema.field("conv_id"), *[pa.field(*x) for x in long], pa.field("audit", pa.string()), pa.field("repaired_sha256", pa.string())])


def _put(state: dict, role: str, text: str) -> None:
    state["sha"].update((("\n" if state["any"] else "") + f"{role}:{text}").encode())
    state["any"] = True


def _edit(state: dict, code: int, n: int, live: bool, truncated: bool, role: str) -> None:
    state["new"] = None
    if not live:
        state["audit"].append("D" * n)
        state["cost"] += COSTS["D"] * n
        return
    before, op, inserted = code >> 2 & 3, _OPS[code & 3], code >> 4
    for into in ([3, 2] if before == 2 else [2, 3])[2 - inserted:]:
        _put(state, _ROLE_INTO[into], "")
    state["audit"].append("I" * inserted + op + "D" * (n - 1))
    state["cost"] += COSTS["I"] * inserted + COSTS["D"] * (n - 1) + COSTS[op] + (TRUNCATED if truncated and op != "D" else 0)
    state["at"] = before
    if op != "D":
        new = role if op == "K" else _ROLE_INTO[int(_NEXT[before])]
        state["at"] = _KEPT[role[:1]][before] if op == "K" else int(_NEXT[before])
        state["new"] = new


def report(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """Faults, cost, audit and the repaired text's SHA-256 of every conversation of ``rows`` (conv_id, turn, role, text).

    Rows stand in the order of their turn (null turns first, a turn's rows by
    role, the text's first 64 characters and its SHA-256); copies follow each
    other.  A null role or text counts as one space, which makes the text
    blank; a null conv_id is a conversation of its own; texts of any length are
    only hashed; other columns are ignored.  Conversations of ``conversations``
    (conv_id) without rows have zeros, an empty audit and the hash of the empty
    string; empty tables give an empty result.
    """
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    found = settled(edits(rows), "edits")
    live = F.col("live")
    flags = _light(rows).select("conv_id", "turn", F.col("blank").cast("long").alias("blank"), F.lit(0).cast("long").alias("twice"),
                                F.lit(0).cast("long").alias("cut"), F.lit(0).cast("long").alias("illegal"), F.lit(1).cast("long").alias("rows"))
    tallies = found.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit(0).cast("long").alias("blank"),
                           live.cast("long").alias("twice"), (live & F.col("truncated")).cast("long").alias("cut"), "illegal", F.lit(0).cast("long").alias("rows"))
    every = flags.unionByName(tallies)
    if conversations is not None:
        every = every.unionByName(conversations.select("conv_id", *[F.lit(None).cast("long").alias("turn"),
                                  *[F.lit(0).cast("long").alias(c) for c in ("blank", "twice", "cut", "illegal", "rows")]]))
    counts = every.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0).cast("long")).alias("gaps"),
        F.sum("blank").alias("blank"), (F.sum("rows") - F.sum("blank") - F.sum("twice")).alias("duplicate"),
        F.sum("cut").alias("truncated"), F.sum("illegal").alias("illegal"))
    none = lambda t, c: F.lit(None).cast(t).alias(c)
    head = counts.select("conv_id", none("long", "turn"), F.lit("").alias("role"), F.lit("").alias("head"), F.unhex(F.lit("")).alias("digest"),
                         F.lit(0).alias("kind"), none("int", "code"), none("long", "n"), none("boolean", "live"), none("boolean", "truncated"),
                         none("string", "text"), F.array("gaps", "blank", "duplicate", "truncated", "illegal").alias("counts"))
    middle = found.select("conv_id", "turn", "role", "head", "digest", F.lit(1).alias("kind"), "code", "n", "live", "truncated",
                          none("string", "text"), none("array<long>", "counts"))
    tail = rows.select("conv_id", "turn", "role", F.substring("text", 1, 64).alias("head"), F.unhex(F.sha2("text", 256)).alias("digest"),
                       F.lit(2).alias("kind"), none("int", "code"), none("long", "n"), none("boolean", "live"), none("boolean", "truncated"),
                       "text", none("array<long>", "counts"))
    together = head.unionByName(middle).unionByName(tail).withColumn("follows", F.col("kind") > 0)
    dealt = together.repartition("conv_id").sortWithinPartitions("conv_id", "follows", "turn", "role", "head", "digest", "kind")
    columns = ", ".join(f"{c} long" for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    return dealt.mapInArrow(_stream, f"conv_id {kind}, {columns}, audit string, repaired_sha256 string")
