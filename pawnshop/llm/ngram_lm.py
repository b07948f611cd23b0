"""N-gram language model in an Elias-Fano trie.

Level one holds the vocabulary: sorted word hashes and the running sums of their
counts, both monotone, both Elias-Fano coded; a word's place is its id.  Level
two holds the words that follow each word: monotone pointers from a context to
its successors, the successors' ids made monotone by adding the last value of
the context before, and a quantised smoothed probability each.  A bigram is
found by a successor search relative to its context.  Both levels are cut into
ranges that Spark tasks build and write to the shared folder; scoring tasks map
the files into memory and touch only the pages they need.

Probabilities are smoothed hierarchically: a bigram's count is topped up with
``STRENGTH`` draws from the unigram distribution, whose counts are topped up by
one half.  Every distribution sums to one over the vocabulary and one unknown
word.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pawnshop.llm import text as tx
from pawnshop.llm.elias_fano import EliasFano, encode
from pawnshop.llm.frames import map_file, put_file, settled
from pawnshop.session import scratch_path

#: Unigram draws added to each context's successors.
STRENGTH = 200.0
#: Steps of a quantised log10 probability, in a byte: 0 to -12.75.
STEP = 0.05
#: Words in a range of level one, and tokens whose bigrams make a range of level two.
VOCABULARY_RANGE = 1 << 20
BIGRAM_RANGE = 1 << 21
#: Bigrams that a counting task holds before it passes them on.
HELD = 1 << 21
#: Ends each text, is counted as a word, and is the context of the first.
END = np.uint64(0x5851F42D4C957F2D)


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all rows, each row closed by the end token, and the first token of each row."""
    word, first = tx.words(data, off)
    n = len(off) - 1
    out = np.full(len(word) + n, END, np.uint64)
    out[np.arange(len(word)) + np.repeat(np.arange(n), np.diff(first))] = word
    return out, first + np.arange(n + 1)


def _word_counts(batches):
    for batch in batches:
        parts = []
        for _, data, off in tx.runs(batch.column("text")):
            codes, distinct = tx.coded(tokens(data, off)[0])
            parts.append((distinct, np.bincount(codes, minlength=len(distinct))))
        word = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.uint64)
        codes, distinct = tx.coded(word)
        n = np.bincount(codes, np.concatenate([p[1] for p in parts]), minlength=len(distinct)) if parts else np.zeros(0)
        yield pa.RecordBatch.from_arrays([pa.array(tx.signed(distinct), pa.int64()), pa.array(n.astype(np.int64))], ["word", "n"])


def _flipped(word):
    """Signed order of the result is unsigned order of the hashes."""
    return F.col(word).bitwiseXOR(F.lit(-(1 << 63)))


def _write_vocabulary(folder: str, step: int):
    """Level one of a sorted range of words; one manifest row, with the ids at every ``step`` counted tokens."""
    def of(batches):
        parts = [(b.column("word").to_numpy(), b.column("n").to_numpy()) for b in batches if b.num_rows]
        if not parts:
            return
        word = tx.unsigned(np.concatenate([p[0] for p in parts]))
        n = np.concatenate([p[1] for p in parts])
        total = np.cumsum(n)
        words_code = encode(word, 1 << 64)
        name = f"{folder}/words-{int(word[0]):020d}.bin"
        put_file(name, np.array([len(words_code)], np.int64).tobytes() + words_code + encode(total.astype(np.uint64), int(total[-1]) + 1))
        cuts = np.searchsorted(total, np.arange(step, total[-1] + step, step))
        cuts = np.unique(np.minimum(cuts, len(n) - 1))
        yield pa.RecordBatch.from_arrays([
            pa.array([name]), pa.array([int(word[0]) - (1 << 63)], pa.int64()), pa.array([len(word)], pa.int64()), pa.array([int(total[-1])], pa.int64()),
            pa.array([cuts.tolist()], pa.list_(pa.int64())), pa.array([total[cuts].tolist()], pa.list_(pa.int64())),
            pa.array([n[cuts].tolist()], pa.list_(pa.int64()))], ["path", "first", "words", "tokens", "cut", "upto", "times"])
    return of


class Vocabulary:
    """Level one: ids and counts of words."""

    def __init__(self, manifest: tuple):
        self.first = np.array([m[1] for m in manifest], np.uint64)
        self.start = np.concatenate([[0], np.cumsum([m[2] for m in manifest])]).astype(np.int64)
        self.size = int(self.start[-1])
        self.tokens = int(sum(m[3] for m in manifest))
        self.parts = []
        for m in manifest:
            mapped = map_file(m[0])
            words = EliasFano(mapped, 8)
            self.parts.append((words, EliasFano(mapped, words.end)))

    def ids(self, word: np.ndarray) -> np.ndarray:
        out = np.full(len(word), -1, np.int64)
        part = np.searchsorted(self.first, word, "right") - 1
        for k in np.unique(part[part >= 0]).tolist():
            own = np.flatnonzero(part == k)
            found = self.parts[k][0].find(word[own])
            out[own] = np.where(found >= 0, found + self.start[k], -1)
        return out

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """How often each word occurs; 0 for id -1."""
        out = np.zeros(len(ids), np.int64)
        part = np.searchsorted(self.start, ids, "right") - 1
        for k in np.unique(part[ids >= 0]).tolist():
            own = np.flatnonzero((part == k) & (ids >= 0))
            i = ids[own] - self.start[k]
            total = self.parts[k][1]
            upto = total.access(i).astype(np.int64)
            later = np.flatnonzero(i > 0)
            upto[later] -= total.access(i[later] - 1).astype(np.int64)
            out[own] = upto
        return out


@lru_cache(2)
def _vocabulary(manifest: tuple) -> Vocabulary:
    return Vocabulary(manifest)


def _bounds(manifest: tuple, cuts: list[tuple[int, int, int]], target: int) -> np.ndarray:
    """First keys (context << 32 | successor) of the ranges of level two, about ``target`` tokens each.

    ``cuts`` are (id, tokens up to and with it, its own tokens) at even steps
    over the vocabulary.  A context with more than ``target`` tokens is cut by
    its successors, in proportion to how often they occur anywhere.
    """
    whole = max(1, cuts[-1][1]) if cuts else 1
    ids = np.array([c[0] for c in cuts], np.int64)
    upto = np.array([c[1] for c in cuts], np.float64)
    out = [0]
    held = 0.0
    for (i, reach, own), before in zip(cuts, [0, *[c[1] for c in cuts[:-1]]], strict=True):
        if own > target:
            pieces = -(-own // target)
            out.append(i << 32)
            at = np.searchsorted(upto, whole * np.arange(1, pieces) / pieces)
            out += [(i << 32) + int(s) for s in np.unique(ids[np.minimum(at, len(ids) - 1)])]
            out.append((i + 1) << 32)
            held = 0.0
            continue
        held += reach - before
        if held >= target:
            out.append((i + 1) << 32)
            held = 0.0
    return np.unique(np.array(out, np.uint64))


def _planes(values: np.ndarray) -> bytes:
    """Gaps of sorted values, byte plane by byte plane: the upper planes are all but empty and compress away."""
    gaps = np.diff(values, prepend=np.zeros(1, np.uint64))
    return gaps.view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel(), dtype=np.uint64)


def _bigram_parts(manifest: tuple, bounds: np.ndarray):
    """The distinct bigrams of a stretch of texts with their counts, cut at the bounds."""
    def rows(parts):
        key = np.concatenate([p[0] for p in parts])
        n = np.concatenate([p[1] for p in parts])
        order = np.argsort(key, kind="stable")
        key, n = key[order], n[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        key, n = key[first], np.add.reduceat(n, first)
        part = np.searchsorted(bounds, key, "right") - 1
        names, at = np.unique(part, return_index=True)
        out = [(int(p), _planes(key[a:b]), n[a:b].astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes())
               for p, a, b in zip(names.tolist(), at.tolist(), [*at.tolist(), len(key)][1:], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.binary()),
                                           pa.array([r[2] for r in out], pa.binary())], ["part", "keys", "counts"])

    def of(batches):
        vocabulary = _vocabulary(manifest)
        parts, held = [], 0
        for batch in batches:
            for _, data, off in tx.runs(batch.column("text")):
                parts.append(np.unique(_keys(vocabulary, *tokens(data, off))[0], return_counts=True))
                held += len(parts[-1][0])
                if held >= HELD:
                    yield rows(parts)
                    parts, held = [], 0
        if parts:
            yield rows(parts)
    return of


def _keys(vocabulary: Vocabulary, word: np.ndarray, first: np.ndarray):
    """(context << 32 | successor) of each token, and the id, the count and the context's count of each.

    The context of a row's first token is the end token.  An unknown word has
    the id -1; keys with one are not looked up.
    """
    codes, distinct = tx.coded(word)
    order = np.argsort(distinct)
    ids, n = np.empty(len(distinct), np.int64), np.empty(len(distinct), np.int64)
    ids[order] = vocabulary.ids(distinct[order])
    n[order] = vocabulary.counts(ids[order])
    end = vocabulary.ids(np.array([END]))
    word_id, count = ids[codes], n[codes]
    context, context_n = np.empty_like(word_id), np.empty_like(count)
    context[1:], context_n[1:] = word_id[:-1], count[:-1]
    head = first[:-1]
    context[head], context_n[head] = end[0], vocabulary.counts(end)[0]
    return (context.astype(np.uint64) << np.uint64(32)) + word_id.astype(np.uint64), word_id, count, context, context_n


def _write_bigrams(manifest: tuple, folder: str):
    """Level two of each range: pointers, successors, quantised probabilities."""
    def build(part: int, key: np.ndarray, n: np.ndarray, vocabulary: Vocabulary):
        order = np.argsort(key, kind="stable")
        key, n = key[order], n[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        key, n = key[first], np.add.reduceat(n, first)
        context, word = (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
        starts = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
        lo, hi = int(context[0]), int(context[-1])
        pointer = np.searchsorted(context[starts], np.arange(lo, hi + 2))
        pointer = np.append(starts, len(key))[pointer]
        last = word[np.append(starts[1:], len(key)) - 1]
        base = np.repeat(np.concatenate([[0], np.cumsum(last)[:-1]]), np.diff(np.append(starts, len(key))))
        c_context = np.repeat(vocabulary.counts(context[starts]), np.diff(np.append(starts, len(key))))
        p = (n + STRENGTH * unigram(vocabulary.counts(word), vocabulary)) / (c_context + STRENGTH)
        code = np.clip(np.round(-np.log10(p) / STEP), 0, 255).astype(np.uint8)
        parts = [encode(pointer.astype(np.uint64), len(key) + 1), encode((base + word).astype(np.uint64), int(base[-1] + last[-1]) + 1), code.tobytes()]
        name = f"{folder}/bigrams-{part:08d}.bin"
        put_file(name, np.array([lo, hi, *map(len, parts)], np.int64).tobytes() + b"".join(p + b"\0" * (-len(p) % 8) for p in parts))
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([name]), pa.array([len(key)], pa.int64())], ["part", "path", "bigrams"])

    def of(batches):
        vocabulary = _vocabulary(manifest)
        now, held = None, []
        for batch in batches:
            for part, keys, counts in zip(*(batch.column(c).to_pylist() for c in ("part", "keys", "counts")), strict=True):
                if part != now and held:
                    yield build(now, np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), vocabulary)
                    held = []
                now = part
                held.append((_from_planes(keys), np.frombuffer(counts, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel().astype(np.int64)))
        if held:
            yield build(now, np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), vocabulary)
    return of


def unigram(count: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    return (count + 0.5) / (vocabulary.tokens + 0.5 * (vocabulary.size + 1))


class Successors:
    """Level two of one range."""

    def __init__(self, path: str):
        mapped = map_file(path)
        self.lo, self.hi, pointers, values, codes = np.frombuffer(mapped, np.int64, 5).tolist()
        at = 40
        self.pointer = EliasFano(mapped, at)
        at += pointers + -pointers % 8
        self.value = EliasFano(mapped, at)
        at += values + -values % 8
        self.code = np.frombuffer(mapped, np.uint8, codes, at)

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Quantised probability of each (context, word), sorted by context; -1 if the pair is not there."""
        out = np.full(len(word), -1, np.int64)
        live = np.flatnonzero((context >= self.lo) & (context <= self.hi))
        if not len(live):
            return out
        own, back = np.unique(context[live] - self.lo, return_inverse=True)
        lo, hi = self.pointer.access(own).astype(np.int64), self.pointer.access(own + 1).astype(np.int64)
        # relative to the context: the last value before its successors
        base = np.zeros(len(own), np.uint64)
        later = np.flatnonzero((lo > 0) & (lo < hi))
        base[later] = self.value.access(lo[later] - 1)
        place = self.value.find(base[back] + word[live].astype(np.uint64), lo[back], hi[back])
        out[live] = np.where(place >= 0, self.code[np.maximum(place, 0)].astype(np.int64), -1)
        return out


@lru_cache(512)
def _successors(path: str) -> Successors:
    return Successors(path)


class NgramModel:
    """Where the files of a model lie, and what a scoring task needs to read them."""

    def __init__(self, manifest: tuple, bounds: np.ndarray, ranges: dict[int, str]):
        self.manifest, self.bounds, self.ranges = manifest, bounds, ranges
        self.words, self.tokens = int(sum(m[2] for m in manifest)), int(sum(m[3] for m in manifest))

    def token_log10(self, data: np.ndarray, off: np.ndarray):
        """For each token: row's first token, count in training, log10 of the unigram and of the model's probability."""
        vocabulary = _vocabulary(self.manifest)
        word, first = tokens(data, off)
        key, ids, count, context, context_n = _keys(vocabulary, word, first)
        single = unigram(count, vocabulary)
        p = STRENGTH * single / (context_n + STRENGTH)
        known = np.flatnonzero((ids >= 0) & (context >= 0))
        distinct, back = np.unique(key[known], return_inverse=True)
        code = np.full(len(distinct), -1, np.int64)
        part = np.searchsorted(self.bounds, distinct, "right") - 1
        names, at = np.unique(part, return_index=True)
        for k, a, b in zip(names.tolist(), at.tolist(), [*at.tolist(), len(distinct)][1:], strict=True):
            if k in self.ranges:
                code[a:b] = _successors(self.ranges[k]).find((distinct[a:b] >> np.uint64(32)).astype(np.int64), (distinct[a:b] & np.uint64(0xFFFFFFFF)).astype(np.int64))
        log = np.log10(p)
        code = code[back]
        log[known] = np.where(code >= 0, -STEP * code, log[known])
        return first, count, np.log10(single), log


def fit(docs: DataFrame, text_col: str = "text") -> NgramModel:
    """Count the words and bigrams of all texts and build the trie in the shared folder."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "ngrams")
    src = docs.select(F.col(text_col).cast("string").alias("text"))
    counts = settled(src.mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    size, total = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not size:
        return NgramModel((), np.zeros(1, np.uint64), {})
    target = min(BIGRAM_RANGE, max(1, total // 8))
    ranges = -(-size // VOCABULARY_RANGE)
    step = max(1, target // 16)
    written = (counts.select("word", "n", _flipped("word").alias("at")).repartitionByRange(ranges, "at").sortWithinPartitions("at").select("word", "n")
               .mapInArrow(_write_vocabulary(folder, step),
                           "path string, first long, words long, tokens long, cut array<long>, upto array<long>, times array<long>"))
    rows = sorted(written.collect(), key=lambda r: r["first"])  # one row a range of a million words
    manifest = tuple((r["path"], r["first"] + (1 << 63), r["words"], r["tokens"]) for r in rows)
    cuts, ids, upto = [], 0, 0
    for r in rows:
        cuts += [(ids + c, upto + u, t) for c, u, t in zip(r["cut"], r["upto"], r["times"], strict=True)]
        ids, upto = ids + r["words"], upto + r["tokens"]
    bounds = _bounds(manifest, cuts, target)
    parts = src.mapInArrow(_bigram_parts(manifest, bounds), "part long, keys binary, counts binary")
    built = (parts.repartition(min(len(bounds), max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))), "part")
             .sortWithinPartitions("part").mapInArrow(_write_bigrams(manifest, folder), "part long, path string, bigrams long"))
    return NgramModel(manifest, bounds, {r["part"]: r["path"] for r in built.collect()})  # one row a range


def scored(docs: DataFrame, model: NgramModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) of each whole text.

    Words are stretches without ASCII white space, capital ASCII letters made
    small; the end of the text is a token.  ``n_known`` counts tokens that occur
    in training, ``base_score`` is the log10 probability under the unigrams
    alone, ``score`` under the model.  Null and empty texts are their end token
    alone; null and repeated ids are kept; other columns are ignored, whatever
    their names; an empty table gives an empty result; a model of no text knows
    no token and gives each the probability of an unknown word.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for at, data, off in tx.runs(batch.column("text")):
                n = len(off) - 1
                first, count, single, log = shared.value.token_log10(data, off)
                sums = lambda x: np.add.reduceat(x, first[:-1])  # noqa: E731  every row has its end token
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, n), pa.array(np.diff(first), pa.int64()),
                                                  pa.array(sums((count > 0).astype(np.int64))), pa.array(sums(single)), pa.array(sums(log))],
                                                 ["id", "n_tokens", "n_known", "base_score", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, f"id {kind}, n_tokens long, n_known long, base_score double, score double").withColumnRenamed("id", id_col)
