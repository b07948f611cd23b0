"""Secrets by fixed patterns and a battery of randomness tests.

Fixed patterns find assignments, access keys and hexadecimal strings.  Beyond
them, every token that mixes letters and digits (or cases) is tested for
randomness over the alphabet of its inferred encoding: chi-squared uniformity,
Wald-Wolfowitz runs and serial correlation, combined by Fisher's method.  A
random token passes at any length, but short words pass too.  So the share of
word-like tokens that pass is measured per length on the whole corpus, and a
length's tokens are reported only at a level where the false discoveries that
this share predicts stay under ``FALSE_SHARE``.
"""

from __future__ import annotations

import functools
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pawnshop.llm import spans as sp, text as tx
from pawnshop.llm.frames import settled

KINDS = ("assign", "access", "hex")
#: Kind of the spans that the tests add.
RANDOM = "random"
FALSE_SHARE = 0.05
#: Lengths from which a class of its own is counted.
LENGTHS = (8, 12, 16, 20, 24, 32, 48, 64)
#: Word-like tokens that the expected pass rate of a length counts for beside those of the corpus.
PRIOR_WORDS = 200
# English letters, a to z, in parts of a thousand.
_LETTER_SHARE = (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1)
#: Levels of the combined p-value, least strict first.
LEVELS = (0.001, 0.003, 0.01, 0.03, 0.1, 0.3)

_ASSIGN = re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_UPPER, _LOWER, _NUM = bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58))
_HEX = _table(_NUM + b"abcdef")
_KEY = _table(_UPPER + _NUM)
_TOKEN = _table(_UPPER + _LOWER + _NUM + b"+/_-")
# Encodings from the smallest alphabet to the largest; a token gets the first that has all its characters.
_ENCODINGS = (_NUM + b"abcdef", _NUM + b"ABCDEF", _UPPER + b"234567", _LOWER + b"234567", _NUM + _LOWER, _NUM + _UPPER,
              _UPPER + _LOWER + _NUM, _UPPER + _LOWER + _NUM + b"+/", _UPPER + _LOWER + _NUM + b"-_", _UPPER + _LOWER + _NUM + b"+/-_")


_MEMBER = sum(_table(a).astype(np.uint16) << k for k, a in enumerate(_ENCODINGS))
_PLACE = np.zeros((len(_ENCODINGS), 256), np.int64)
for _k, _a in enumerate(_ENCODINGS):
    _PLACE[_k, list(_a)] = np.arange(len(_a))
_SIZE = np.array([len(a) for a in _ENCODINGS])
_IS_NUM, _IS_UPPER, _IS_LOWER, _IS_DASH = 1, 2, 4, 8
_FLAG = sum(_table(a) * np.uint8(f) for a, f in ((_NUM, _IS_NUM), (_UPPER, _IS_UPPER), (_LOWER, _IS_LOWER), (b"-_", _IS_DASH)))


def _normal_tail(z: np.ndarray) -> np.ndarray:
    """Upper tail of the normal distribution (Abramowitz and Stegun 7.1.26)."""
    x = np.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    tail = 0.5 * t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * np.exp(-x * x)
    return np.where(z >= 0, tail, 1 - tail)


def _chi_tail(x: np.ndarray, freedom: np.ndarray) -> np.ndarray:
    """Upper tail of chi-squared (Wilson and Hilferty's cube-root approximation)."""
    v = 2 / (9 * freedom)
    return _normal_tail((np.cbrt(np.maximum(x, 0) / freedom) - (1 - v)) / np.sqrt(v))


def randomness(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Combined p-value of the three tests for each byte span, under the hypothesis that its characters are random.

    Spans hold two or more characters of the largest alphabet.
    """
    n = ends - starts
    if not len(n):
        return np.zeros(0)
    cut = np.concatenate([[0], np.cumsum(n)])
    owner = np.repeat(np.arange(len(n)), n)
    chars = data[np.arange(cut[-1]) + np.repeat(starts - cut[:-1], n)]
    known = np.bitwise_and.reduceat(_MEMBER[chars], cut[:-1])
    # the lowest set bit is the smallest alphabet
    code = np.log2((known & -known.astype(np.int32)).astype(np.float64)).astype(np.int64)
    k = _SIZE[code].astype(float)
    x = _PLACE[code[owner], chars]
    first = np.ones(len(x), bool)
    first[1:] = owner[1:] != owner[:-1]
    count = np.bincount(owner * 64 + x, minlength=64 * len(n)).reshape(-1, 64).astype(float)
    chi = (count * count).sum(1) * k / n - n
    p_chi = _chi_tail(chi, k - 1)

    high = x >= k[owner] / 2
    ups = np.add.reduceat(high.astype(np.int64), cut[:-1]).astype(float)
    change = np.concatenate([[False], high[1:] != high[:-1]]) & ~first
    runs = 1 + np.add.reduceat(change.astype(np.int64), cut[:-1])
    mean = 1 + 2 * ups * (n - ups) / n
    spread = np.maximum((mean - 1) * (mean - 2) / (n - 1), 1e-9)
    one_sided = (ups == 0) | (ups == n)
    p_runs = np.where(one_sided, 2.0 ** (1 - n), 2 * _normal_tail(np.abs(runs - mean) / np.sqrt(spread)))

    d = x - (np.add.reduceat(x, cut[:-1]) / n)[owner]
    total = np.add.reduceat(d * d, cut[:-1])
    product = np.concatenate([[0.0], d[1:] * d[:-1]]) * ~first
    serial = np.add.reduceat(product, cut[:-1]) / np.where(total > 0, total, 1)
    p_serial = np.where(total > 0, 2 * _normal_tail(np.abs(serial + 1 / n) * np.sqrt(n)), 2.0 ** (1 - n))

    half = -sum(np.log(np.maximum(p, 1e-300)) for p in (p_chi, p_runs, p_serial))
    return np.minimum(1.0, np.exp(-half) * (1 + half + half * half / 2))


def base_spans(raw: bytes) -> list[tuple[int, int, str]]:
    """(start, end, kind) in bytes: leftmost, non-overlapping within a kind, by start and then kind."""
    out = []
    lower = raw.lower()
    if any(w in lower for w in _KEYWORDS):
        out += [(*m.span(), "assign") for m in _ASSIGN.finditer(raw) if m.end(1) - m.start(1) >= 6]
    data = np.frombuffer(raw, np.uint8)
    edge = np.array([0, len(data)])
    starts, ends, _ = tx.spans_of(_HEX[data], edge)
    out += [(a, b, "hex") for a, b in zip(starts.tolist(), ends.tolist(), strict=True) if b - a >= 24]
    at = raw.find(b"AKIA")
    if at >= 0:
        starts, ends, _ = tx.spans_of(_KEY[data], edge)
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            if b - a >= 20 and (first := raw.find(b"AKIA", a, b)) >= 0 and b - first >= 20:
                out.append((first, b, "access"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


_FOUND = (f"id long, print long, base array<{sp.SPAN}>, tokens array<struct<start:int,end:int,size:int,p:double>>, "
          "words array<struct<size:int,level:int,n:long>>")


def _tested(data: np.ndarray, off: np.ndarray):
    """(starts, ends, row, p, mixed) of the tokens to test: word-like ones, and long ones that mix letters and digits or cases."""
    starts, ends, first = tx.spans_of(_TOKEN[data], off)
    row = np.repeat(np.arange(len(off) - 1), np.diff(first))
    size = ends - starts
    long = size >= LENGTHS[0]
    starts, ends, row, size = starts[long], ends[long], row[long], size[long]
    if not len(starts):
        return starts, ends, row, np.zeros(0), np.zeros(0, bool)
    cut = np.concatenate([[0], np.cumsum(size)])
    flag = _FLAG[data[np.arange(cut[-1]) + np.repeat(starts - cut[:-1], size)]]
    every = np.bitwise_or.reduceat(flag, cut[:-1])
    plain = np.bitwise_and.reduceat(((flag & (_IS_UPPER | _IS_LOWER | _IS_DASH)) > 0).astype(np.uint8), cut[:-1]) > 0
    flag[cut[:-1]] = 0
    inner = np.bitwise_or.reduceat(flag, cut[:-1])
    letters = (every & (_IS_UPPER | _IS_LOWER)) > 0
    cases = (inner & _IS_UPPER > 0) & (inner & _IS_LOWER > 0)
    mixed = letters & ((every & _IS_NUM > 0) | cases)
    keep = mixed | (plain & letters)
    starts, ends, row, mixed = starts[keep], ends[keep], row[keep], mixed[keep]
    return starts, ends, row, randomness(data, starts, ends), mixed


def _extract(batches):
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    token = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("size", pa.int32()), ("p", pa.float64())])
    word = pa.struct([("size", pa.int32()), ("level", pa.int32()), ("n", pa.int64())])
    for batch in batches:
        for at, data, off in tx.runs(batch.column("text")):
            n = len(off) - 1
            base, tokens, words = [[] for _ in range(n)], [[] for _ in range(n)], [[] for _ in range(n)]
            starts, ends, row, p, mixed = _tested(data, off)
            size_class = np.searchsorted(LENGTHS, ends - starts, "right") - 1
            level = np.searchsorted(LEVELS, p, "right")
            # the word-like tokens of the whole run, counted on its first row
            counts = np.bincount(size_class[~mixed] * 8 + level[~mixed], minlength=8 * len(LENGTHS))
            words[0] = [{"size": LENGTHS[c // 8], "level": c % 8, "n": int(counts[c])} for c in np.flatnonzero(counts).tolist()]
            whole = data.tobytes()
            lower = whole.lower()
            hexes, hex_ends, _ = tx.spans_of(_HEX[data], off)
            rows = set(row[mixed].tolist()) | set((np.searchsorted(off, hexes[hex_ends - hexes >= 24], "right") - 1).tolist())
            for key in (*_KEYWORDS, b"akia"):
                k = lower.find(key)
                while k >= 0:
                    r = int(np.searchsorted(off, k, "right")) - 1
                    rows.add(r)
                    k = lower.find(key, int(off[r + 1]) - len(key) + 1 if off[r + 1] - len(key) + 1 > k else k + 1)
            place = sp.char_index(data) if rows else None
            for r in rows:
                base[r] = base_spans(whole[off[r]:off[r + 1]])
            for k in np.flatnonzero(mixed).tolist():
                r = int(row[k])
                a, b = int(starts[k] - off[r]), int(ends[k] - off[r])
                if not any(x < b and a < y for x, y, _ in base[r]):
                    c = place[off[r]]
                    tokens[r].append({"start": int(place[starts[k]] - c), "end": int(place[ends[k]] - c), "size": LENGTHS[size_class[k]], "p": float(p[k])})
            for r in rows:
                base[r] = [{"kind": k, "start": int(place[off[r] + a] - place[off[r]]), "end": int(place[off[r] + b] - place[off[r]])} for a, b, k in base[r]]
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, n), batch.column("print").slice(at, n),
                                              pa.array(base, pa.list_(span)), pa.array(tokens, pa.list_(token)),
                                              pa.array(words, pa.list_(word))], ["id", "print", "base", "tokens", "words"])


@functools.cache
def expected_rates() -> dict[int, list[float]]:
    """For each length the share of letter strings that pass each level, if letters come as often as in English.

    Words are less random than such strings, so these rates err on the safe
    side.  From ``PRIOR_WORDS`` x 10 strings of a fixed stream for each length.
    """
    out = {}
    share = np.cumsum(_LETTER_SHARE) / sum(_LETTER_SHARE)
    for size in LENGTHS:
        n = 10 * PRIOR_WORDS
        number = tx.mix(np.arange(n * size, dtype=np.uint64) + np.uint64(size << 32)) >> np.uint64(11)
        letters = (97 + np.searchsorted(share, number.astype(float) / 2.0**53, "right")).astype(np.uint8)
        p = randomness(letters, np.arange(n) * size, (np.arange(n) + 1) * size)
        out[size] = [1.0, *(float((1 + (p >= level).sum()) / (1 + n)) for level in LEVELS)]
    return out


def levels(words: DataFrame, tokens: DataFrame) -> dict[int, float]:
    """For each length class the least strict level at which its tokens may be reported.

    At a level, the expected false discoveries are the class's tokens times the
    share of word-like tokens of its length that pass; they may be at most
    ``FALSE_SHARE`` of those reported.  That share is measured on the corpus and
    drawn towards the expected one (``expected_rates``) by the weight of
    ``PRIOR_WORDS`` words, so that small corpora have a level as well.  Both
    tables are counts per length and level, a few dozen rows.
    """
    words = {(r["size"], r["level"]): r["n"] for r in words.collect()}
    tokens = {(r["size"], r["level"]): r["n"] for r in tokens.collect()}
    out: dict[int, float] = {}
    rate = [1.0] * (len(LEVELS) + 1)
    for size, expected in expected_rates().items():
        # the tests tell words better the longer they are: the rate of the length before bounds this one's
        prior = [min(x, y) for x, y in zip(expected, rate, strict=True)]
        seen = sum(words.get((size, k), 0) for k in range(len(LEVELS) + 1))
        rate = [(PRIOR_WORDS * prior[k] + sum(words.get((size, j), 0) for j in range(k, len(LEVELS) + 1))) / (PRIOR_WORDS + seen)
                for k in range(len(LEVELS) + 1)]
        held = sum(tokens.get((size, k), 0) for k in range(len(LEVELS) + 1))
        for k, level in enumerate(LEVELS, 1):
            passed = sum(tokens.get((size, j), 0) for j in range(k, len(LEVELS) + 1))
            if passed and rate[k] * held <= FALSE_SHARE * passed:
                out[size] = level
                break
    return out


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, print, base, spans): secrets of each whole text, in code points, end exclusive.

    ``base`` are the fixed patterns' spans, ``spans`` those and the tokens that
    pass the randomness tests (kind ``random``), as arrays of (kind, start, end)
    by start, then kind.  An added token has 8 characters or more (the first of
    ``LENGTHS``) and overlaps no base span.  ``print`` is a hash of the text, so that rows
    that repeat an id stay apart.

    Null and empty texts have no spans; null ids and repeated rows are kept;
    other columns are ignored, whatever their names; an empty table gives an
    empty result.
    """
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("print"), F.col(text_col).cast("string").alias("text"))
    found = settled(src.mapInArrow(_extract, _FOUND), "secrets")
    words = found.select(F.explode("words").alias("w")).groupBy("w.size", "w.level").agg(F.sum("w.n").alias("n"))
    level = sum((F.col("t.p") >= x).cast("int") for x in LEVELS)
    tokens = found.select(F.explode("tokens").alias("t")).groupBy("t.size", level.alias("level")).agg(F.count("*").alias("n"))
    allowed = levels(words, tokens)

    def passes(t):
        return F.coalesce(*[F.when(t["size"] == size, t["p"] >= level) for size, level in allowed.items()], F.lit(False))

    added = F.transform(F.filter("tokens", passes), lambda t: F.struct(F.lit(RANDOM).alias("kind"), t["start"].alias("start"), t["end"].alias("end")))
    return found.select(F.col("id").alias(id_col), "print", "base", sp.in_order(F.concat("base", added), (*KINDS, RANDOM)).alias("spans"))
