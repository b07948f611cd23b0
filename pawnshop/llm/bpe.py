"""Byte-level BPE encoding and decoding with a minimal acyclic transducer lexicon.

The frequent words of the corpus are compiled into a minimal acyclic automaton:
equal suffixes share their states, and the outputs summed along a word's path
give its rank among the words, which points to its token ids.  The automaton is
a few arrays, written to a file that every worker maps into memory.  Words that
are not in it are merged exactly, pair by pair.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import tempfile
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pawnshop.llm import text as tx
from pawnshop.llm.frames import settled

#: Words compiled into the lexicon: the most frequent of the whole corpus.
LEXICON_WORDS = 65536
#: Bytes of text whose distinct words are looked up together.
RUN_BYTES = 1 << 20
#: Merged words that a task remembers between runs.
KNOWN_WORDS = 1 << 17
_SHORT = 64
_NO_MERGE = 1 << 30
# Fixed values of the byte-level pre-tokenisation.
_CONTRACTIONS = (b"'s", b"'t", b"'m", b"'d", b"'re", b"'ve", b"'ll")
_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)


@lru_cache(1)
def _char_class() -> np.ndarray:
    """Class of every code point: letter, number, white space or other."""
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            out[c] = _LETTER
        elif kind == "N":
            out[c] = _NUMBER
    out[_WHITE] = _SPACE
    return out


def _code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(byte position, code point) of each character of UTF-8 bytes."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at].astype(np.int32)
    code = lead.copy()
    wide = np.flatnonzero(lead >= 0xC0)
    if len(wide):
        padded = np.concatenate([data, np.zeros(3, np.uint8)])
        p = at[wide]
        b1, b2, b3 = (padded[p + k].astype(np.int32) & 0x3F for k in (1, 2, 3))
        first = lead[wide]
        code[wide] = np.where(first < 0xE0, (first & 0x1F) << 6 | b1, np.where(
            first < 0xF0, (first & 0x0F) << 12 | b1 << 6 | b2, (first & 0x07) << 18 | b1 << 12 | b2 << 6 | b3))
    return at, np.minimum(code, 0x10FFFF)


def split_words(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Byte positions where words start; no word crosses one of ``bounds`` (sorted, from 0 to the end).

    Words are letters, numbers or other characters with at most one blank in
    front, the contractions 's 't 're 've 'm 'll 'd, and the white space
    between, whose last character goes with the next word if it is a blank.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    at, code = _code_points(data)
    kind = _char_class()[code]
    n = len(at)
    edge = np.zeros(n + 1, bool)
    edge[np.searchsorted(at, bounds)] = True
    edge[[0, n]] = True
    space = kind == _SPACE
    blank = code == 32
    prev_kind = np.concatenate([[_OTHER], kind[:-1]]).astype(np.uint8)
    prev_blank = np.concatenate([[False], blank[:-1]])
    prev_space = prev_kind == _SPACE
    next_plain = np.concatenate([~space[1:], [False]]) & ~edge[1:]
    start = kind != prev_kind
    # the last of several white-space characters before a word stands alone or goes with the word
    start |= space & prev_space & next_plain
    # a word after a blank starts at the blank
    start &= ~(~space & prev_blank & ~edge[:-1])
    start |= edge[:-1]
    quote = np.flatnonzero((code == 39) & start)
    if len(quote):
        padded = np.concatenate([code, np.zeros(2, np.int32)])
        open_edge = np.concatenate([edge, np.ones(2, bool)])
        one, two = padded[quote + 1], padded[quote + 2]
        for word in _CONTRACTIONS:
            hit = (one == word[1]) & ~open_edge[quote + 1]
            if len(word) == 3:
                hit &= (two == word[2]) & ~open_edge[quote + 2]
            q = quote[hit]
            start[q + 1] = False
            after = q + len(word)
            start[after[after < n]] = True
    return at[start]


class Vocabulary:
    """Token bytes, merge ranks and special tokens of a byte-level BPE file (tokenizers' JSON)."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        vocab = spec["model"]["vocab"]
        symbol = _byte_symbols()
        byte_of = {s: b for b, s in enumerate(symbol)}
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token = [b""] * size
        for word, i in vocab.items():
            self.token[i] = bytes(byte_of[c] for c in word)
        for word, i in self.special.items():
            self.token[i] = word
        self.byte_id = [vocab[s] for s in symbol]
        self.merge = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merge[vocab[left] * size + vocab[right]] = (rank, vocab[left + right])
        self.size = size
        self.byte_id_array = np.array(self.byte_id, np.int32)
        pairs = np.array(sorted((k, r, i) for k, (r, i) in self.merge.items()), np.int64).reshape(-1, 3)
        self.pair_table, self.pair_rank = tx.probe_table(pairs[:, 0]), pairs[:, 1].astype(np.int32)
        self.merged_id = pairs[np.argsort(pairs[:, 1]), 2].astype(np.int32)
        self.length = np.array([len(t) for t in self.token], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)])
        self.bytes = np.frombuffer(b"".join(self.token), np.uint8)
        self.decimal = [str(i) for i in range(size)]

    def encode_word(self, word: bytes) -> list[int]:
        """Exact merges: always the pair of the lowest rank, leftmost first."""
        return self._merge_long([self.byte_id[b] for b in word])

    def encode_words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many words (byte spans) and the first id of each; all words are merged at once, a pair a round."""
        length = ends - starts
        short = np.flatnonzero((length <= _SHORT) & (length > 0))
        ids = self.byte_id_array[data[_ranges(starts[short], length[short])]]
        word = np.repeat(short.astype(np.int32), length[short])
        done_ids, done_words = [], []
        rank = self._pair_rank(ids[:-1], ids[1:], word[:-1] == word[1:])
        rank = np.append(rank, np.int32(_NO_MERGE))
        while len(ids):
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.minimum.reduceat(rank.astype(np.int64) << 32 | np.arange(len(ids)), first)
            open_ = best >> 32 < _NO_MERGE
            if not open_.all():
                keep = np.repeat(open_, np.diff(np.append(first, len(ids))))
                done_ids.append(ids[~keep])
                done_words.append(word[~keep])
                moved = np.cumsum(keep) - 1
                ids, word, rank = ids[keep], word[keep], rank[keep]
                best = best[open_]
                at = moved[best & 0xFFFFFFFF]
            else:
                at = best & 0xFFFFFFFF
            if not len(ids):
                break
            ids[at] = self.merged_id[best >> 32]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))
            ids, word, rank = ids[keep], word[keep], rank[keep]
            redo = np.concatenate([at, at[at > 0] - 1])
            after = np.minimum(redo + 1, len(ids) - 1)
            rank[redo] = self._pair_rank(ids[redo], ids[after], (word[redo] == word[after]) & (after > redo))
        for k in np.flatnonzero(length > _SHORT).tolist():
            own = self.encode_word(data[starts[k]:ends[k]].tobytes())
            done_ids.append(np.array(own, np.int32))
            done_words.append(np.full(len(own), k, np.int32))
        ids = np.concatenate([np.zeros(0, np.int32), *done_ids])
        word = np.concatenate([np.zeros(0, np.int32), *done_words])
        order = np.argsort(word, kind="stable")
        return ids[order], np.searchsorted(word[order], np.arange(len(starts) + 1))

    def _pair_rank(self, left: np.ndarray, right: np.ndarray, joined: np.ndarray) -> np.ndarray:
        at = tx.probe(self.pair_table, left.astype(np.int64) * self.size + right)
        return np.where(joined & (at >= 0), self.pair_rank[at], np.int32(_NO_MERGE))

    def _merge_long(self, ids: list[int]) -> list[int]:
        n = len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = []

        def offer(k: int) -> None:
            if 0 <= k and after[k] < n and (found := self.merge.get(ids[k] * self.size + ids[after[k]])):
                heapq.heappush(heap, (found[0], k, ids[k], ids[after[k]], found[1]))

        for k in range(n - 1):
            offer(k)
        while heap:
            _, k, left, right, new = heapq.heappop(heap)
            if not alive[k] or ids[k] != left or after[k] >= n or ids[after[k]] != right:
                continue
            gone = after[k]
            ids[k], alive[gone], after[k] = new, False, after[gone]
            if after[k] < n:
                before[after[k]] = k
            offer(k)
            offer(before[k])
        return [i for i, ok in zip(ids, alive, strict=True) if ok]

    def decode(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the tokens of all rows, and the first byte of each row."""
        out = self.bytes[_ranges(self.start[ids], self.length[ids])]
        return out, np.concatenate([[0], np.cumsum(self.length[ids])])[first]


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b) if b in plain else chr(spare))
        spare += b not in plain
    return out


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0] .. start[0] + length[0] - 1, start[1] .., as one array."""
    total = np.concatenate([[0], np.cumsum(length)])
    return np.arange(total[-1]) + np.repeat(start - total[:-1], length)


class Automaton:
    """Minimal acyclic automaton of a set of words; ``rank`` finds many words at once.

    Arrays: ``table`` (place of each transition, by state * 256 + byte),
    ``target``, ``skip`` (words that end before this transition's words),
    ``final`` (of each state), ``first`` and ``ids`` (token ids of each word by
    rank).
    """

    NAMES = ("table", "target", "skip", "final", "first", "ids")
    KINDS = (np.int64, np.int32, np.int32, np.uint8, np.int64, np.int32)

    @staticmethod
    def build(words: list[bytes], ids: list[list[int]]) -> bytes:
        """Compile sorted, distinct words, adding one after the other; finished suffixes are shared at once."""
        states: list[list] = [[False, {}]]
        shared: dict[tuple, int] = {}
        path: list[tuple[int, int]] = []

        def finish(keep: int) -> None:
            while len(path) > keep:
                parent, byte = path.pop()
                child = states[parent][1][byte]
                mark = (states[child][0], tuple(states[child][1].items()))
                same = shared.setdefault(mark, child)
                if same != child:
                    states[parent][1][byte] = same
                    states[child] = None

        last = b""
        for word in words:
            common = next((k for k, (x, y) in enumerate(zip(word, last, strict=False)) if x != y), min(len(word), len(last)))
            finish(common)
            at = states[path[-1][0]][1][path[-1][1]] if path else 0
            for byte in word[common:]:
                states.append([False, {}])
                states[at][1][byte] = len(states) - 1
                path.append((at, byte))
                at = len(states) - 1
            states[at][0] = True
            last = word
        finish(0)
        used = [i for i, s in enumerate(states) if s is not None]
        number = {old: new for new, old in enumerate(used)}
        count: dict[int, int] = {}

        def total(state: int) -> int:
            stack = [state]
            while stack:
                s = stack[-1]
                missing = [t for t in states[s][1].values() if t not in count]
                if missing:
                    stack.extend(missing)
                else:
                    count[s] = states[s][0] + sum(count[t] for t in states[s][1].values())
                    stack.pop()
            return count[state]

        total(0)
        rows = []
        for s in used:
            before = int(states[s][0])
            for byte, t in sorted(states[s][1].items()):
                rows.append((number[s] * 256 + byte, number[t], before))
                before += count[t]
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 3)
        arrays = (tx.probe_table(table[:, 0]), table[:, 1], table[:, 2], np.array([states[s][0] for s in used]),
                  np.concatenate([[0], np.cumsum([len(x) for x in ids])]), np.concatenate([np.zeros(0, int), *ids]))
        parts = [np.ascontiguousarray(a, k).tobytes() for a, k in zip(arrays, Automaton.KINDS, strict=True)]
        head = np.array([len(p) for p in parts], np.int64).tobytes()
        return head + b"".join(p + b"\0" * (-len(p) % 8) for p in parts)

    def __init__(self, raw: bytes):
        with tempfile.TemporaryFile() as f:  # has no name: nothing stays behind when the worker ends
            f.write(raw)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        sizes = np.frombuffer(self.map, np.int64, len(self.NAMES))
        at = 8 * len(self.NAMES)
        for name, kind, size in zip(self.NAMES, self.KINDS, sizes.tolist(), strict=True):
            setattr(self, name, np.frombuffer(self.map, kind, size // np.dtype(kind).itemsize, at))
            at += size + -size % 8
        self.table = self.table.reshape(-1, 2)

    def rank(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Rank of each byte span among the words, or -1."""
        out = np.full(len(starts), -1, np.int64)
        if not len(self.target):
            return out
        live = np.arange(len(starts))
        state, sum_, at = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64), starts.copy()
        while len(live):
            ended = at == ends[live]
            if ended.any():
                done = ended & (self.final[state] == 1)
                out[live[done]] = sum_[done]
                go = ~ended
                live, state, sum_, at = live[go], state[go], sum_[go], at[go]
                if not len(live):
                    break
            t = tx.probe(self.table, state * 256 + data[at])
            ok = t >= 0
            t = t[ok]
            live, at = live[ok], at[ok] + 1
            state, sum_ = self.target[t].astype(np.int64), sum_[ok] + self.skip[t]
        return out


@lru_cache(2)
def _vocabulary(raw: bytes) -> Vocabulary:
    return Vocabulary(raw)


@lru_cache(2)
def _automaton(raw: bytes) -> Automaton:
    return Automaton(raw)


def _specials(data: np.ndarray, off: np.ndarray, vocabulary: Vocabulary) -> tuple[list[int], list[int], list[int]]:
    """(starts, ends, ids) of special tokens in the bytes, leftmost first, none across rows."""
    found = []
    raw = data.tobytes()
    for word, i in vocabulary.special.items():
        at = raw.find(word)
        while at >= 0:
            row = np.searchsorted(off, at, "right")
            if at + len(word) <= off[row]:
                found.append((at, at + len(word), i))
                at = raw.find(word, at + len(word))
            else:
                at = raw.find(word, at + 1)
    found.sort()
    kept, end = [], 0
    for s in found:
        if s[0] >= end:
            kept.append(s)
            end = s[1]
    return tuple(list(x) for x in zip(*kept, strict=True)) if kept else ([], [], [])


class Known:
    """Words that a task has merged before, by hash, and their ids: the first ``words`` that it met."""

    def __init__(self, words: int = KNOWN_WORDS):
        self.room = words
        self.hashes, self.lo, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash, or -1."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def add(self, hashes: np.ndarray, ids: np.ndarray, first: np.ndarray) -> None:
        """Distinct words that are not there yet, as far as there is room; those of many ids stay out."""
        n = np.diff(first)
        new = np.flatnonzero(n <= _SHORT)[:self.room - len(self.hashes)]
        if not len(new):
            return
        joined = np.concatenate([self.hashes, hashes[new]])
        order = np.argsort(joined)
        self.hashes = joined[order]
        self.lo = np.concatenate([self.lo, len(self.ids) + np.cumsum(n[new]) - n[new]])[order]
        self.n = np.concatenate([self.n, n[new]])[order]
        self.ids = np.concatenate([self.ids, ids[_ranges(first[new], n[new])]])


def encode_run(data: np.ndarray, off: np.ndarray, vocabulary: Vocabulary, lexicon: Automaton,
               known: Known | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all rows, and the first token of each row; ``known`` spares words of earlier runs their merges."""
    s_start, s_end, s_id = _specials(data, off, vocabulary)
    bounds = np.unique(np.concatenate([off, np.array(s_start + s_end, np.int64)]))
    starts = split_words(data, bounds)
    if len(s_start):
        inside = np.zeros(len(data) + 1, np.int8)
        np.add.at(inside, np.array(s_start) + 1, 1)
        np.add.at(inside, np.array(s_end), -1)
        starts = starts[np.cumsum(inside)[starts] == 0]
    ends = np.append(starts[1:], len(data))
    codes, distinct = tx.coded(tx.span_hash(data, starts, ends))
    first = tx.firsts(codes, len(distinct))
    rank = lexicon.rank(data, starts[first], ends[first])
    known = known or Known(0)
    missing = np.flatnonzero(rank < 0)
    before = known.find(distinct[missing])
    met, missing, before = missing[before >= 0], missing[before < 0], before[before >= 0]
    own, own_first = vocabulary.encode_words(data, starts[first[missing]], ends[first[missing]])
    pool = np.concatenate([lexicon.ids, known.ids, own])
    lo, n = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
    hit = np.flatnonzero(rank >= 0)
    lo[hit], n[hit] = lexicon.first[rank[hit]], lexicon.first[rank[hit] + 1] - lexicon.first[rank[hit]]
    lo[met], n[met] = len(lexicon.ids) + known.lo[before], known.n[before]
    lo[missing], n[missing] = len(lexicon.ids) + len(known.ids) + own_first[:-1], np.diff(own_first)
    known.add(distinct[missing], own, own_first)
    if len(s_start):
        word = np.searchsorted(starts, s_start)
        codes[word] = len(distinct) + np.arange(len(word))
        lo, n = np.append(lo, len(pool) + np.arange(len(word))), np.append(n, np.ones(len(word), np.int64))
        pool = np.concatenate([pool, np.array(s_id, np.int32)])
    length = n[codes]
    total = np.concatenate([[0], np.cumsum(length)])
    return pool[_ranges(lo[codes], length)], total[np.searchsorted(starts, off)]


def _count(batches):
    """Distinct words of each Arrow batch and how often they occur."""
    for batch in batches:
        counts: dict[bytes, int] = {}
        for _, data, off in tx.runs(batch.column("text"), RUN_BYTES):
            starts = split_words(data, off)
            ends = np.append(starts[1:], len(data))
            codes, distinct = tx.coded(tx.span_hash(data, starts, ends))
            first = tx.firsts(codes, len(distinct))
            raw = data.tobytes()
            for a, b, c in zip(starts[first].tolist(), ends[first].tolist(), np.bincount(codes, minlength=len(distinct)).tolist(), strict=True):
                word = raw[a:b]
                counts[word] = counts.get(word, 0) + c
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                                         ["word", "times"])


#: Word counts are told apart in steps of the eighth root of two when the most frequent are chosen.
_STEPS = 8


def frequent_words(docs: DataFrame, text_col: str = "text", words: int = LEXICON_WORDS) -> DataFrame:
    """(word, times): the most frequent words of all texts, at most ``words``: all those from some count on.

    The count is found from a table of words per step of the count's logarithm,
    a few hundred rows, so no task or driver sorts words.
    """
    src = docs.select(F.col(text_col).cast("string").alias("text"))
    counted = settled(src.mapInArrow(_count, "word binary, times long").groupBy("word").agg(F.sum("times").alias("times")), "words")
    step = F.floor(F.log2("times") * _STEPS).cast("int")
    held, least = 0, 0
    for r in sorted(counted.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):
        held += r["count"]
        if held > words:
            least = r["step"] + 1
            break
    return counted.filter(step >= least)


class Tokenizer:
    """A byte-level BPE vocabulary and the lexicon compiled for a corpus."""

    def __init__(self, vocabulary_path: str):
        with open(vocabulary_path, "rb") as f:
            self.vocabulary = f.read()
        self.lexicon = Automaton.build([], [])

    def compile(self, docs: DataFrame, text_col: str = "text", words: int = LEXICON_WORDS) -> Tokenizer:
        """Build the lexicon from the most frequent words of ``docs``; at most ``words`` reach the driver."""
        vocabulary = _vocabulary(self.vocabulary)
        # words longer than this are rare; they are merged exactly like other unseen words
        frequent = sorted(bytes(r[0]) for r in frequent_words(docs, text_col, words).select("word").collect() if len(r[0]) <= 256)
        self.lexicon = Automaton.build(frequent, [vocabulary.encode_word(w) for w in frequent])
        return self

    def encode(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(id, ids): token ids of each whole text, as the tokenizers library gives them without added special tokens.

        A special token's string in a text becomes that token, as there.  Null
        and empty texts have no ids; null and repeated ids are kept as they
        are; other columns are ignored, whatever their names; an empty table
        gives an empty result.
        """
        kind = docs.schema[id_col].dataType.simpleString()
        src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        return src.mapInArrow(self._encoder(docs), f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)

    def _encoder(self, frame: DataFrame):
        shared = frame.sparkSession.sparkContext.broadcast((self.vocabulary, self.lexicon))

        def run(batches):
            vocabulary, lexicon = _vocabulary(shared.value[0]), _automaton(shared.value[1])
            for batch in batches:
                for at, data, off in tx.runs(batch.column("text"), RUN_BYTES):
                    ids, first = encode_run(data, off, vocabulary, lexicon)
                    yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, len(off) - 1),
                                                      tx.list_array(ids, first, pa.int32())], ["id", "ids"])

        return run

    def decode(self, encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
        """(id, text): the text of each row's token ids; null ids count as none; bytes that are no UTF-8 become U+FFFD."""
        shared = encoded.sparkSession.sparkContext.broadcast(self.vocabulary)

        def run(batches):
            vocabulary = _vocabulary(shared.value)
            for batch in batches:
                ids, first = list_buffers(batch.column("ids"))
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(decoded(vocabulary, ids, first), pa.string())],
                                                 ["id", "text"])

        kind = encoded.schema[id_col].dataType.simpleString()
        src = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
        return src.mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)

    def digests(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(id, n_tokens, ids_sha256, decoded_sha256) of what ``encode`` and then ``decode`` make of each text.

        Both run in one pass, so the ids don't travel between them.
        """
        encode = self._encoder(docs)
        shared = docs.sparkSession.sparkContext.broadcast(self.vocabulary)

        def run(batches):
            vocabulary = _vocabulary(shared.value)
            sha = lambda x: hashlib.sha256(x).hexdigest()
            for batch in encode(batches):
                ids, first = list_buffers(batch.column("ids"))
                decimal = vocabulary.decimal
                cut = first.tolist()
                joined = [sha(",".join([decimal[i] for i in ids[a:b].tolist()]).encode()) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([
                    batch.column("id"), pa.array(np.diff(first), pa.int64()), pa.array(joined, pa.string()),
                    pa.array([sha(t.encode()) for t in decoded(vocabulary, ids, first)], pa.string())],
                    ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

        kind = docs.schema[id_col].dataType.simpleString()
        src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        return src.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def list_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, first value of each row) of an int list column; a null counts as an empty list."""
    if column.null_count:
        lengths = np.array([0 if x is None else x for x in pa.compute.list_value_length(column).to_pylist()], np.int64)
        return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lengths)])
    first = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), first - first[0]


def decoded(vocabulary: Vocabulary, ids: np.ndarray, first: np.ndarray) -> list[str]:
    out = []
    # runs of rows, so that the bytes of a whole Arrow batch never stand side by side
    at = 0
    while at < len(first) - 1:
        to = max(at + 1, int(np.searchsorted(first, first[at] + tx.CHUNK_BYTES, "right")) - 1)
        data, cut = vocabulary.decode(ids[first[at]:first[to]], first[at:to + 1] - first[at])
        raw = data.tobytes()
        out += [raw[a:b].decode("utf-8", "replace") for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
        at = to
    return out
