"""SentencePiece BPE with offsets: every piece is projected to the bytes of the original text.

A text is normalised by longest prefixes through the model's compiled character
map (a double-array trie and a pool of replacements).  Each normalised byte
remembers where the stretch began that made it, so the bounds of a piece in the
normalised text give its span in the original one.  Pieces never join two
characters that stand side by side in no piece, so the normalised text is cut
there into units; each unit is merged by score, leftmost first, and what is left
over falls back to byte pieces.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pawnshop.llm import text as tx
from pawnshop.llm.bpe import list_buffers

# --- fixed values of the model format ---
#: The visible space, and what an unknown id decodes to where the model doesn't say.
SPACE, UNKNOWN_SURFACE = "▁", " ⁇ "
#: Kinds of pieces.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Model type of byte-pair merges.
BPE = 2
_SPACE_BYTES = np.frombuffer(SPACE.encode(), np.uint8)

#: Bytes of text that are normalised together, or one text if it is longer.
RUN_BYTES = 1 << 20
#: A worker forgets its merged units when they have more characters than this.
CACHE_CHARACTERS = 1 << 21
#: Units up to this many characters are merged side by side, longer ones with a heap each.
LONG_UNIT = 64
_NO_MERGE = 1 << 30


def _fields(raw: bytes):
    """(number, value) of each field of a message: an int, or bytes for anything with a length or of fixed size."""
    at = 0

    def varint():
        nonlocal at
        value, shift = 0, 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7)
            size = varint() if size is None else size
            yield key >> 3, raw[at:at + size]
            at += size


class CharacterMap:
    """Longest-prefix replacements, read from the compiled form: the trie's size, the trie, and strings that end in zero bytes."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.unit = np.frombuffer(blob, np.uint32, size // 4, 4).astype(np.int64) if size else np.zeros(0, np.int64)
        self.pool = np.frombuffer(blob[4 + size:], np.uint8)
        stops = np.append(np.flatnonzero(self.pool == 0), len(self.pool))
        self.stop = stops[np.searchsorted(stops, np.arange(len(self.pool) + 1))] if len(self.pool) else stops

    @staticmethod
    def _offset(unit: np.ndarray) -> np.ndarray:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, data: np.ndarray, starts: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of the longest rule at each start or 0, place of its replacement in the pool)."""
        length, value = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        if not len(self.unit) or not len(starts):
            return length, value
        live, at = np.arange(len(starts)), starts.copy()
        node = np.broadcast_to(self._offset(self.unit[:1]), live.shape)
        depth = 0
        while len(live):
            go = at < limits[live]
            live, at, node = live[go], at[go], node[go]
            byte = data[at].astype(np.int64)
            node = node ^ byte
            unit = self.unit[np.minimum(node, len(self.unit) - 1)]
            go = (node < len(self.unit)) & (unit & (1 << 31 | 255) == byte)
            live, at, node, unit = live[go], at[go] + 1, node[go], unit[go]
            node = node ^ self._offset(unit)
            depth += 1
            leaf = (unit >> 8 & 1) == 1
            length[live[leaf]] = depth
            value[live[leaf]] = self.unit[node[leaf]] & 0x7FFFFFFF
        return length, value


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0] .. first[0] + size[0] - 1, then the same for each further pair."""
    start = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(first - start, size)


class Normalizer:
    """Normalised bytes of whole rows, with the original place of each."""

    def __init__(self, spec: bytes):
        found = dict(_fields(spec))
        self.map = CharacterMap(found.get(2, b""))
        self.prefix, self.squeeze, self.escape = (bool(found.get(k, 1)) for k in (3, 4, 5))

    def _replaced(self, data: np.ndarray, off: np.ndarray):
        """(bytes, original start of each, whether it opens a stretch): every character, or the longest rule there, replaced."""
        opens = (data & 0xC0) != 0x80
        chars = np.flatnonzero(opens)
        row_end = off[np.searchsorted(off, chars, "right")]
        length, value = self.map.longest(data, chars, row_end)
        after = np.append(chars[1:], len(data))
        hit = length > 0
        if not hit.any():
            at = np.maximum.accumulate(np.where(opens, np.arange(len(data)), 0)) if len(data) else np.zeros(0, np.int64)
            return data, at, opens, off
        keep = np.ones(len(chars), bool)
        end = 0  # rules that span characters cover what begins inside them
        for i in np.flatnonzero(hit & (length > after - chars)).tolist():
            if chars[i] >= end:
                end = int(chars[i] + length[i])
                keep[i + 1:np.searchsorted(chars, end)] = False
        chars, hit, length, value = chars[keep], hit[keep], length[keep], value[keep]
        size = np.where(hit, self.map.stop[np.where(hit, value, 0)] - value, np.append(chars[1:], len(data)) - chars)
        source = np.concatenate([data, self.map.pool])
        first = np.where(hit, len(data) + value, chars)
        total = np.concatenate([[0], np.cumsum(size)])
        out = source[_ranges(first, size)]
        opened = np.zeros(len(out), bool)
        opened[total[:-1][size > 0]] = True
        return out, np.repeat(chars, size), opened, total[np.searchsorted(chars, off)]

    def __call__(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, first byte of each row, original place of each byte, counted from the run's first byte)."""
        out, at, opens, cut = self._replaced(data, off)
        row = np.repeat(np.arange(len(off) - 1), np.diff(cut))
        stop = off[1:].copy()
        if self.squeeze and len(out):
            blank = out == 32
            stretch = np.cumsum(opens) - 1
            first = np.flatnonzero(opens)
            # leading blanks of a stretch go where the row begins or the stretch before ended in one
            inked = np.flatnonzero(~blank)
            upto = np.searchsorted(inked, first)
            ink = np.append(inked, len(out))[upto]
            leading = blank & (np.arange(len(out)) < ink[stretch])
            starts_row = np.isin(first, cut[:-1])
            after_blank = starts_row | np.append(True, blank)[first]
            drop = leading & after_blank[stretch]
            last = np.full(len(off) - 1, -1, np.int64)
            np.maximum.at(last, row[inked], inked)
            trailing = blank & (np.arange(len(out)) > last[row])
            # a row's text ends where its first trailing blank that wasn't dropped begins
            for_end = np.flatnonzero(trailing & ~drop)
            if len(for_end):
                rows, one = np.unique(row[for_end], return_index=True)
                stop[rows] = at[for_end[one]]
            keep = ~drop & ~trailing
            out, at, row = out[keep], at[keep], row[keep]
        count = np.bincount(row, minlength=len(off) - 1)
        first_at = np.concatenate([[0], np.cumsum(count)])
        begins = np.where(count > 0, np.append(at, 0)[np.minimum(first_at[:-1], len(at))], off[:-1]) if self.squeeze else off[:-1]
        space = _SPACE_BYTES if self.escape else np.array([32], np.uint8)
        width = np.where(out == 32, len(space), 1)
        lead = np.where((count > 0) & self.prefix, len(space), 0)
        ends = np.concatenate([[0], np.cumsum(width)])
        rows_before = np.concatenate([[0], np.cumsum(lead)])
        size = ends[first_at[1:]] - ends[first_at[:-1]] + lead
        cut = np.concatenate([[0], np.cumsum(size)])
        text = np.empty(cut[-1], np.uint8)
        place = np.empty(cut[-1], np.int64)
        where = ends[:-1] + rows_before[1:][row]
        spots = np.repeat(where, width) + _ranges(np.zeros(len(width), np.int64), width)
        text[spots], place[spots] = np.repeat(out, width), np.repeat(at, width)
        blank = where[out == 32]
        heads = cut[:-1][lead > 0]
        for k, byte in enumerate(space.tolist()):
            text[blank + k] = byte
            text[heads + k] = byte
            place[heads + k] = begins[lead > 0]
        return text, cut, place, np.where(count > 0, stop, off[:-1])


class Model:
    """Vocabulary, scores and normaliser of a SentencePiece model file of the byte-pair kind with byte fallback."""

    def __init__(self, raw: bytes):
        pieces, trainer, normalizer = [], {}, b""
        for number, value in _fields(raw):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append((piece.get(1, b"").decode(), np.frombuffer(piece.get(2, bytes(4)), np.float32)[0], piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = value
        kinds = {kind for _, _, kind in pieces}
        if trainer.get(3, 1) != BPE or BYTE not in kinds or kinds & {USER, UNUSED} or trainer.get(24, 0):
            raise ValueError("only byte-pair models with byte fallback, prefix white space and without user-defined or unused pieces are supported")
        self.normalize = Normalizer(normalizer)
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL}
        # equal scores rank alike, so that the leftmost pair goes first
        order = {s: r for r, s in enumerate(sorted({float(s) for _, s, _ in pieces}, reverse=True))}
        self.rank = {p: order[float(pieces[i][1])] for p, i in self.ids.items()}
        self.byte_ids = [0] * 256
        decoded, self.byte, self.unknown = [], np.full(len(pieces), -1), np.zeros(len(pieces), bool)
        unknown = trainer.get(44, UNKNOWN_SURFACE.encode())
        for i, (p, _, kind) in enumerate(pieces):
            if kind == BYTE:
                self.byte[i] = int(p[3:5], 16)
                self.byte_ids[self.byte[i]] = i
            self.unknown[i] = kind == UNKNOWN
            decoded.append(bytes([self.byte[i]]) if kind == BYTE else unknown if kind == UNKNOWN else b"" if kind == CONTROL
                           else p.replace(SPACE, " ").encode())
        self.size = np.array([len(d) for d in decoded], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.pool = np.frombuffer(b"".join(decoded), np.uint8)
        self.spaced = np.array([p.startswith(SPACE) and kind == NORMAL for p, _, kind in pieces])
        self.decimal = [str(i) for i in range(len(pieces))]
        # two characters stand side by side inside some piece, or a unit ends between them
        self.pairs = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        inner = {pair[1] for pair in self.pairs if pair[1] == SPACE and pair[0] != SPACE}
        joined = {c for pair in self.pairs for c in pair}
        alone = "".join(c for c in map(chr, range(128)) if c not in joined)
        self.units = re.compile(f"[{SPACE}]*[^{SPACE}{re.escape(alone)}]+|[{SPACE}]+|[{re.escape(alone)}]" if alone else f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+") \
            if not inner else re.compile(r"(?s).+")

        self._pairs_of_symbols()

    def _pairs_of_symbols(self) -> None:
        """Symbols are the pieces and all characters inside them; the table holds every pair that makes a piece."""
        pieces = list(self.ids)
        symbols = pieces + sorted({c for p in pieces for c in p}.difference(pieces))
        number = {s: i for i, s in enumerate(symbols)}
        self.none = len(symbols)  # stands for any other character
        keys, to = [], []
        for p in pieces:
            for cut in range(1, len(p)):
                left, right = number.get(p[:cut]), number.get(p[cut:])
                if left is not None and right is not None:
                    keys.append(left * (self.none + 1) + right)
                    to.append(number[p])
        self.pair_table = tx.probe_table(np.array(keys, np.int64))
        self.pair_to = np.array([*to, self.none], np.int64)
        self.pair = dict(zip(keys, to, strict=True))
        self.symbol_rank = np.array([self.rank.get(x, _NO_MERGE) for x in symbols] + [_NO_MERGE], np.int64)
        self.ranks = self.symbol_rank.tolist()
        self.symbol_id = np.array([self.ids.get(x, -1) for x in symbols] + [-1], np.int32)
        self.symbol_bytes = np.array([len(x.encode()) for x in symbols] + [0], np.int64)
        single = sorted((ord(x), i) for x, i in number.items() if len(x) == 1)
        self.code_points, self.code_symbols = (np.array(x, np.int64) for x in zip(*single, strict=True)) if single else (np.zeros(0, np.int64),) * 2

    def _joined(self, left: np.ndarray, right: np.ndarray, same: np.ndarray) -> np.ndarray:
        """The symbol that each pair makes; ``none`` where there is none."""
        return np.where(same, self.pair_to[tx.probe(self.pair_table, left * (self.none + 1) + right)], self.none)

    def merged(self, units: list[str]):
        """(ids, normalised bytes of each id, ids of each unit): in every round each unit merges its best pair, the leftmost of equals."""
        code = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.int64)
        place = np.minimum(np.searchsorted(self.code_points, code), len(self.code_points) - 1)
        symbol = np.where(self.code_points[place] == code, self.code_symbols[place], self.none)
        unit = np.repeat(np.arange(len(units)), np.array([len(u) for u in units], np.int64))
        long = np.flatnonzero(np.array([len(u) > LONG_UNIT for u in units]))
        is_long = np.isin(unit, long)
        done = [self._merged_long(symbol[unit == k], code[unit == k], k) for k in long.tolist()]
        symbol, code, unit = symbol[~is_long], code[~is_long], unit[~is_long]
        to = np.append(self._joined(symbol[:-1], symbol[1:], unit[:-1] == unit[1:]), self.none)[:len(symbol)]
        while len(symbol):
            first = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
            best = np.minimum.reduceat(self.symbol_rank[to] << 32 | np.arange(len(symbol)), first)
            going = best >> 32 < _NO_MERGE
            keep = np.repeat(going, np.diff(np.append(first, len(symbol))))
            done.append((symbol[~keep], code[~keep], unit[~keep]))
            at = (np.cumsum(keep) - 1)[best[going] & 0xFFFFFFFF]
            symbol, code, unit, to = symbol[keep], code[keep], unit[keep], to[keep]
            if not len(symbol):
                break
            symbol[at] = to[at]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))
            symbol, code, unit, to = symbol[keep], code[keep], unit[keep], to[keep]
            redo = np.concatenate([at, at[at > 0] - 1])
            after = np.minimum(redo + 1, len(symbol) - 1)
            to[redo] = self._joined(symbol[redo], symbol[after], (unit[redo] == unit[after]) & (after > redo))
        symbol, code, unit = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(unit, kind="stable")
        symbol, code, unit = symbol[order], code[order], unit[order]
        # a character without a piece becomes its bytes, the last of which carries it
        ids, size, count = self.symbol_id[symbol], self.symbol_bytes[symbol], np.ones(len(symbol), np.int64)
        bare = np.flatnonzero(ids < 0)
        if len(bare):
            raw = [chr(c).encode() for c in code[bare].tolist()]
            count[bare] = [len(r) for r in raw]
            last = np.cumsum(count) - 1
            spot = _ranges((last - count + 1)[bare], count[bare])
            ids, size = np.repeat(ids, count), np.repeat(size, count)
            size[spot] = 0
            size[last[bare]] = count[bare]
            ids[spot] = [self.byte_ids[b] for r in raw for b in r]
        return ids, size, np.bincount(unit, count, len(units)).astype(np.int64)

    def _merged_long(self, symbol: np.ndarray, code: np.ndarray, unit: int):
        """The same for one long unit, with a heap of its pairs."""
        own, alive = symbol.tolist(), np.ones(len(symbol), bool)
        before, after = list(range(-1, len(own) - 1)), [*range(1, len(own)), -1]
        heap = []

        def offer(a: int, b: int) -> None:
            made = self.pair.get(own[a] * (self.none + 1) + own[b]) if a >= 0 and b >= 0 else None
            if made is not None:
                heapq.heappush(heap, (rank[made], a, own[a], own[b], made))

        rank = self.ranks
        for a in range(len(own) - 1):
            offer(a, a + 1)
        while heap:
            _, a, left, right, made = heapq.heappop(heap)
            b = after[a]
            if not alive[a] or own[a] != left or b < 0 or own[b] != right:
                continue
            own[a], alive[b], after[a] = made, False, after[b]
            if after[b] >= 0:
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        return np.array(own, np.int64)[alive], code[alive], np.full(int(alive.sum()), unit)


class Units(dict):
    """Merged units of one worker: the place of each in growing lists of ids and of the normalised bytes of each id."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.characters = 0
        self.ids, self.sizes, self.first = array("i"), array("i"), array("q", [0])

    def learn(self, found: set[str]) -> None:
        """Merge what is not known yet, all at once."""
        new = list(found.difference(self.keys()))
        if new:
            ids, sizes, count = self.model.merged(new)
            start = len(self.first) - 1
            self.first.frombytes((len(self.ids) + np.cumsum(count)).astype(np.int64).tobytes())
            self.ids.frombytes(ids.astype(np.int32).tobytes())
            self.sizes.frombytes(sizes.astype(np.int32).tobytes())
            self.update(zip(new, range(start, start + len(new))))
            self.characters += sum(map(len, new))


def encode_run(data: np.ndarray, off: np.ndarray, model: Model, units: Units):
    """(ids, first id of each row, start and end byte of each id in its row) of whole rows."""
    if units.characters > CACHE_CHARACTERS:
        units.forget()
    text, cut, place, stop = model.normalize(data, off)
    raw, bounds = text.tobytes(), cut.tolist()
    found, counts = [], []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        own = model.units.findall(raw[a:b].decode())
        found += own
        counts.append(len(own))
    units.learn(set(found))
    entry = np.fromiter(map(units.__getitem__, found), np.int64, len(found))
    first = np.array(units.first)
    size = first[entry + 1] - first[entry]
    at = _ranges(first[entry], size)
    ids, width = np.array(units.ids, np.int32)[at], np.array(units.sizes, np.int64)[at]
    total = np.concatenate([[0], np.cumsum(size)])
    rows = total[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]).astype(np.int64)]
    # pieces fill a row's normalised bytes from end to end
    right = np.cumsum(width)
    left = right - width
    row = np.repeat(np.arange(len(off) - 1), np.diff(rows))
    places = np.append(place, 0)
    ends = np.where(right == cut[row + 1], stop[row], places[np.minimum(right, len(place))])
    starts = places[left]
    return ids, rows, (starts - off[row]).astype(np.int32), (np.where(width > 0, ends, starts) - off[row]).astype(np.int32)


def decoded(model: Model, ids: np.ndarray, first: np.ndarray) -> list[str]:
    """Text of each row of ids: the first piece loses one leading space, bytes that are no UTF-8 become U+FFFD."""
    if len(ids) and (ids.min() < 0 or ids.max() >= len(model.size)):
        raise ValueError("an id is not in the vocabulary")
    size = model.size[ids]
    data = model.pool[_ranges(model.first[ids], size)]
    cut = np.concatenate([[0], np.cumsum(size)])
    out, raw = [], data.tobytes()
    silent = np.concatenate([[0], np.cumsum(size == 0)])
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        own = raw[cut[a]:cut[b]]
        head = a  # control pieces leave no text, so the first piece after them still counts as first
        while head < b and not model.size[ids[head]]:
            head += 1
        if head < b and model.normalize.prefix | model.normalize.squeeze and model.spaced[ids[head]]:
            own = own[1:]
        try:
            out.append(own.decode() if silent[a] == silent[b] else _lenient(model, ids[a:b], own))
        except UnicodeDecodeError:
            out.append(_lenient(model, ids[a:b], own))
    return out


def _lenient(model: Model, ids: np.ndarray, own: bytes) -> str:
    """Runs of byte pieces are read as UTF-8 on their own: each byte that is part of no character becomes U+FFFD."""
    fill = len(own) - int(model.size[ids].sum())  # the space that was taken away
    at, text = fill, []
    is_byte = model.byte[ids] >= 0
    k = 0
    while k < len(ids):
        to = k + 1
        while to < len(ids) and is_byte[to] == is_byte[k]:
            to += 1
        end = at + int(model.size[ids[k:to]].sum())
        part = own[max(at, 0):end]
        if is_byte[k]:
            p = 0
            while p < len(part):
                for n in (1, 2, 3, 4):
                    try:
                        text.append(part[p:p + n].decode())
                        p += n
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    text.append("�")
                    p += 1
        else:
            text.append(part.decode())
        at, k = end, to
    return "".join(text)


@lru_cache(2)
def _model(raw: bytes) -> Model:
    return Model(raw)


@lru_cache(2)
def _units(raw: bytes) -> Units:
    return Units(_model(raw))


_ENCODED = "ids array<int>, starts array<int>, ends array<int>"


class Encoder:
    """A model file, sent to the tasks as it is (at most a few MB)."""

    def __init__(self, model_path: str):
        with open(model_path, "rb") as f:
            self.raw = f.read()
        self.model = _model(self.raw)

    def _run(self, frame: DataFrame):
        shared = frame.sparkSession.sparkContext.broadcast(self.raw)

        def run(batches):
            model, units = _model(shared.value), _units(shared.value)
            for batch in batches:
                for at, data, off in tx.runs(batch.column("text"), RUN_BYTES):
                    ids, first, starts, ends = encode_run(data, off, model, units)
                    yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, len(off) - 1),
                                                      *[tx.list_array(x, first, pa.int32()) for x in (ids, starts, ends)]],
                                                     ["id", "ids", "starts", "ends"])

        return run

    def encode(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(id, ids, starts, ends): the ids of each whole text as the sentencepiece library gives them without begin and
        end ids, and the bytes [start, end) of the UTF-8 text that each id stands for.

        The first id's span begins where the text does (after white space that
        the model strips); of the byte pieces of a character the last has its
        span.  Null and empty texts have no ids; null and repeated ids of rows
        stay as they are; other columns are ignored, whatever their names; an
        empty table gives an empty result.
        """
        kind = docs.schema[id_col].dataType.simpleString()
        src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        return src.mapInArrow(self._run(docs), f"id {kind}, {_ENCODED}").withColumnRenamed("id", id_col)

    def decode(self, encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
        """(id, text): the text of each row's ids; null ids count as none; an id outside the vocabulary raises."""
        shared = encoded.sparkSession.sparkContext.broadcast(self.raw)

        def run(batches):
            model = _model(shared.value)
            for batch in batches:
                ids, first = list_buffers(batch.column("ids"))
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(decoded(model, ids, first), pa.string())], ["id", "text"])

        kind = encoded.schema[id_col].dataType.simpleString()
        src = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
        return src.mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)

    def digests(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(id, n_tokens, ids_sha256, decoded_sha256, spans_sha256) of what ``encode`` and then ``decode`` make of each text.

        ``spans_sha256`` is that of the spans as pairs of little-endian 32-bit
        numbers.  All run in one pass, so the ids don't travel between them.
        """
        encode = self._run(docs)
        shared = docs.sparkSession.sparkContext.broadcast(self.raw)

        def run(batches):
            model = _model(shared.value)
            sha = lambda x: hashlib.sha256(x).hexdigest()
            for batch in encode(batches):
                ids, first = list_buffers(batch.column("ids"))
                spans = np.stack([list_buffers(batch.column(c))[0] for c in ("starts", "ends")], 1).astype("<i4")
                decimal, cut = model.decimal, first.tolist()
                rows = list(zip(cut[:-1], cut[1:], strict=True))
                yield pa.RecordBatch.from_arrays([
                    batch.column("id"), pa.array(np.diff(first), pa.int64()),
                    pa.array([sha(",".join([decimal[i] for i in ids[a:b].tolist()]).encode()) for a, b in rows], pa.string()),
                    pa.array([sha(t.encode()) for t in decoded(model, ids, first)], pa.string()),
                    pa.array([sha(spans[a:b].tobytes()) for a, b in rows], pa.string())],
                    ["id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"])

        kind = docs.schema[id_col].dataType.simpleString()
        src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        return src.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string").withColumnRenamed("id", id_col)
