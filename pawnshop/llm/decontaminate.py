"""Benchmark decontamination by spaced-seed hashing.

A spaced seed is a fixed mask over consecutive words, such as 1101100101111: the
hash at a position covers the words under a 1 and ignores those under a 0, so a
changed word under a 0 doesn't hide the overlap.  Hashes of test items and of
training texts are joined; at the shift of each hit the two texts are compared
word by word over their whole length, allowing substitutions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pawnshop.llm import text as tx
from pawnshop.llm.frames import settled

LEAST_WORDS = 13


def _cyclic_masks() -> tuple[str, ...]:
    """Masks of ``LEAST_WORDS`` words and weight 7 that pass over every pair of changed words inside them.

    Between its two ends each mask ignores a shift of the numbers 0 .. 10 that
    are no non-zero squares modulo 11.  These eleven sets of six are a design:
    every pair of the eleven places lies in three of them, so 13 words of which
    any two inner ones are changed are always hit.
    """
    n = LEAST_WORDS - 2
    squares = {k * k % n for k in range(1, n)}
    return tuple("1" + "".join("1" if (j - shift) % n in squares else "0" for j in range(n)) + "1" for shift in range(n))


# The last mask is solid: any run of eight equal words is hit.
MASKS = (*_cyclic_masks(), "11111111")
LEAST_SHARE = 0.8
#: log2 of the bits of the filter that spares most training positions the join; its size is fixed, the
#: filter only passes more positions when the benchmark is larger.
FILTER_BITS = 24
_MULT = tx.mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def _seed_hashes(word: np.ndarray, first: np.ndarray, mask: str, number: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of one mask over all rows; a window never leaves its row."""
    span = len(mask)
    n = len(word) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    out = np.full(n, tx.mix(np.array([number + 1], np.uint64))[0], np.uint64)
    for j, bit in enumerate(mask):
        if bit == "1":
            out += word[j:j + n] * _MULT[j]
    at = np.arange(n)
    row_end = np.repeat(first[1:], np.diff(first))[:n]
    ok = at + span <= row_end
    return at[ok], tx.mix(out[ok])


def _masks(short: list[int]) -> list[tuple[int, str]]:
    """The fixed masks, and one solid mask for each length of items shorter than the longest mask."""
    return list(enumerate(MASKS)) + [(100 + n, "1" * n) for n in short]


def _hash_rows(short: list[int]):
    masks = _masks(short)

    def of(batches):
        for batch in batches:
            ids = batch.column("id")
            for at, data, off in tx.runs(batch.column("text")):
                word, first = tx.words(data, off, bare=True)
                rows, pos, hashes = [], [], []
                for number, mask in masks:
                    p, h = _seed_hashes(word, first, mask, number)
                    r = np.searchsorted(first, p, "right") - 1
                    if number >= 100:  # a solid mask of an item's own length serves such items only
                        keep = np.diff(first)[r] == number - 100
                        p, h, r = p[keep], h[keep], r[keep]
                    rows.append(r)
                    pos.append(p - first[r])
                    hashes.append(h)
                r = np.concatenate(rows)
                yield pa.RecordBatch.from_arrays([ids.slice(at, len(off) - 1).take(pa.array(r)).cast(pa.int64()),
                                                  pa.array(np.concatenate(pos), pa.int32()),
                                                  pa.array(tx.signed(np.concatenate(hashes)), pa.int64())],
                                                 ["item_id", "item_pos", "hash"])
    return of


def _tokens(batches):
    for batch in batches:
        ids = batch.column("id")
        for at, data, off in tx.runs(batch.column("text")):
            word, first = tx.words(data, off, bare=True)
            yield pa.RecordBatch.from_arrays([ids.slice(at, len(off) - 1).cast(pa.int64()),
                                              tx.list_array(tx.signed(word), first, pa.int64())], ["item_id", "item_words"])


def _slots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of the filter that a hash needs: its first and its last ``FILTER_BITS`` bits."""
    return hashes >> np.uint64(64 - FILTER_BITS), hashes & np.uint64((1 << FILTER_BITS) - 1)


def _hits(short: list[int], bits: np.ndarray):
    masks = _masks(short)

    def of(batches):
        for batch in batches:
            ids = batch.column("id")
            for at, data, off in tx.runs(batch.column("text")):
                word, first = tx.words(data, off, bare=True)
                pos, hashes = [], []
                for number, mask in masks:
                    p, h = _seed_hashes(word, first, mask, number)
                    for part in range(2):
                        places = _slots(h)[part]
                        hit = (bits[(places >> np.uint64(3)).astype(np.int64)] >> (places & np.uint64(7)).astype(np.uint8)) & 1 == 1
                        p, h = p[hit], h[hit]
                        if not len(p):
                            break
                    pos.append(p)
                    hashes.append(h)
                pos, hashes = np.concatenate(pos), np.concatenate(hashes)
                row = np.searchsorted(first, pos, "right") - 1
                order = np.argsort(row, kind="stable")
                pos, hashes, row = pos[order], hashes[order], row[order]
                keep = np.unique(row)
                cut = np.concatenate([np.searchsorted(row, keep), [len(row)]])
                size = np.diff(first)[keep]
                flat = np.concatenate([word[first[r]:first[r + 1]] for r in keep]) if len(keep) else word[:0]
                yield pa.RecordBatch.from_arrays([
                    ids.slice(at, len(off) - 1).take(pa.array(keep)).cast(pa.int64()),
                    tx.list_array(tx.signed(flat), np.concatenate([[0], np.cumsum(size)]), pa.int64()),
                    tx.list_array((pos - first[row]).astype(np.int32), cut, pa.int32()),
                    tx.list_array(tx.signed(hashes), cut, pa.int64())], ["doc_id", "words", "pos", "hash"])
    return of


def overlap(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
    """The best stretch of item words against doc words ``shift`` further on.

    Returns (start, end, equal words) in the item.  Of all stretches that begin
    and end with an equal word, span ``LEAST_WORDS`` words (the whole of a
    shorter item) or more and have ``LEAST_SHARE`` of them equal, the first with
    the most equal words; (0, 0, 0) if there is none.
    """
    lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
    at = np.flatnonzero(doc[lo + shift:hi + shift] == item[lo:hi])
    if not len(at):
        return 0, 0, 0
    # equal words i .. j have the share if gain[j] - gain[i] + 1 >= LEAST_SHARE: the first such i is where the
    # running minimum of gain falls below that
    gain = np.arange(len(at)) - LEAST_SHARE * at
    i = np.searchsorted(-np.minimum.accumulate(gain), -(gain + 1 - LEAST_SHARE + 1e-9))
    count = np.arange(len(at)) - i + 1
    count[at - at[i] + 1 < min(LEAST_WORDS, len(item))] = 0
    j = int(np.argmax(count))
    return (lo + int(at[i[j]]), lo + int(at[j]) + 1, int(count[j])) if count[j] else (0, 0, 0)


def _verified(batches):
    for batch in batches:
        cols = batch.to_pydict() if batch.num_rows == 0 else None
        out = {k: [] for k in ("doc_id", "item_id", "doc_start", "doc_end", "equal_words", "item_words")}
        if cols is None:
            doc_col, item_col = batch.column("words"), batch.column("item_words")
            flat = [(c.offsets.to_numpy(), c.values.to_numpy(zero_copy_only=False)) for c in (doc_col, item_col)]
            ids, items = batch.column("doc_id").to_pylist(), batch.column("item_id").to_pylist()
            shifts, begins = (batch.column(c).to_numpy() for c in ("shift", "begin"))
            for k in range(batch.num_rows):
                doc, item = (v[o[k]:o[k + 1]] for o, v in flat)
                start, end, equal = overlap(doc, item, int(shifts[k] - begins[k]))
                if equal:
                    for name, v in zip(out, (ids[k], items[k], start + shifts[k], end + shifts[k], equal, len(item)), strict=True):
                        out[name].append(v)
        yield pa.RecordBatch.from_arrays([pa.array(out[k], pa.int64() if k in ("doc_id", "item_id") else pa.int32())
                                          for k in out], list(out))


def _filter_bits(hashes: DataFrame) -> np.ndarray:
    """The seed hashes of the benchmark as a bit filter of ``2 ** FILTER_BITS`` bits (2 MB).

    Spark ORs the bits of equal 64-bit words, so at most 2 ** (FILTER_BITS - 6)
    small rows reach the driver, whatever the benchmark's size.
    """
    both = F.array(F.shiftrightunsigned("hash", 64 - FILTER_BITS), F.col("hash").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)))
    slot = F.col("slot")
    rows = (hashes.select(F.explode(both).alias("slot")).select(F.shiftright(slot, 6).cast("int").alias("word"), (slot % 64).cast("int").alias("bit"))
            .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toPandas())
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return out.view(np.uint8)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Overlaps of training texts with test items, one row per (doc_id, item_id) and longest first found.

    Columns: doc_id, item_id, doc_start and doc_end (words of the document, end
    exclusive), equal_words, item_words.  Words are maximal runs of letters and
    digits, ASCII case folded.  An overlap counts if it spans at least 13 words
    (all words of a shorter item), of which 80 % are equal in place; words
    inserted or dropped end it.  Every overlap of 13 words and every overlap that
    holds 13 words with two changes or fewer is found; longer ones with one word
    in five changed at random are missed once in a hundred times at most (see the
    tests).  Items of fewer words than the longest mask are
    also sought by a solid mask of their own length, so they must occur whole.

    Null, empty and wordless texts or items overlap nothing; null ids are
    skipped; of repeated ids all texts are searched and equal findings come
    once; other columns, whatever their names, are ignored; an empty table on
    either side gives an empty result.

    Only positions that pass a filter of fixed size go to the join, which is an
    ordinary shuffled join; nothing is capped or dropped.
    """
    spark = docs.sparkSession
    train = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter("id is not null")
    test = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).cast("string").alias("text")).filter("id is not null")
    items = settled(test.mapInArrow(_tokens, "item_id long, item_words array<long>").distinct(), "items")
    longest = max(map(len, MASKS))
    short = sorted(r[0] for r in items.select(F.size("item_words").alias("n")).filter(F.col("n").between(1, longest - 1)).distinct().collect())
    seeds = settled(test.mapInArrow(_hash_rows(short), "item_id long, item_pos int, hash long").distinct(), "seeds")
    bits = spark.sparkContext.broadcast(_filter_bits(seeds))
    hits = settled(train.mapInArrow(lambda batches: _hits(short, bits.value)(batches),
                                    "doc_id long, words array<long>, pos array<int>, hash array<long>"), "hits")
    shift = (F.col("pos") - F.col("item_pos")).alias("shift")
    sizes = items.groupBy("item_id").agg(F.max(F.size("item_words")).alias("longest"))
    places = (hits.select("doc_id", F.explode(F.arrays_zip("pos", "hash")).alias("h")).select("doc_id", "h.pos", "h.hash")
              .join(seeds, "hash").select("doc_id", "item_id", shift).distinct().join(sizes, "item_id"))
    # only the words that lie against the item go on, whatever the text's length
    begin = F.greatest(F.col("shift"), F.lit(0))
    window = F.slice("words", begin + 1, F.greatest(F.col("shift") + F.col("longest") - begin, F.lit(0)))
    found = (places.join(hits.select("doc_id", "words"), "doc_id")
             .select("doc_id", "item_id", "shift", begin.alias("begin"), window.alias("words")).join(items, "item_id")
             .select("doc_id", "item_id", "shift", "begin", "words", "item_words")
             .mapInArrow(_verified, "doc_id long, item_id long, doc_start int, doc_end int, equal_words int, item_words int"))
    best = F.max(F.struct("equal_words", (-F.col("doc_start")).alias("first"), "doc_end", "item_words")).alias("b")
    return (found.groupBy("doc_id", "item_id").agg(best)
            .select("doc_id", "item_id", (-F.col("b.first")).alias("doc_start"), "b.doc_end", "b.equal_words", "b.item_words"))
