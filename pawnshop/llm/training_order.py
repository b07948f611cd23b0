"""Training-order materialisation: fixed-stride shards of token ids in a keyed random order.

Documents are packed into sequences of equal length.  A keyed Feistel network
with cycle-walking is a permutation of 0 .. n - 1 that needs no table: it gives
every sequence its global slot.  Range partitions gather the slots of each
shard and lay them out with a fixed stride, so that a reader finds any slot by
arithmetic, reads sequentially and resumes anywhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from pawnshop.llm import bpe, text as tx
from pawnshop.llm.frames import file_store, put_file, settled

SEQUENCE_TOKENS = 2048
SHARD_SEQUENCES = 1024
ROUNDS = 6
#: Blocks whose running totals are computed together, then those of such groups.
_GROUP = 4096
#: Sequences that a task places at a time.
_PLACED = 1024
#: How the packed sequences are written: a page's zstd window reaches over thousands of sequences.
_STORED = {"parquet.compression.codec.zstd.level": "7", "parquet.page.size": str(4 << 20)}


def _round_keys(key: int) -> np.ndarray:
    return tx.mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ tx.mix(np.array([key % 2**64], np.uint64)))


def slots(number: np.ndarray, n: int, key: int) -> np.ndarray:
    """Where the keyed permutation of 0 .. n - 1 puts each number.

    The network permutes the smallest square power of two >= n; results >= n are
    put through it again until they fall below n, which keeps it a permutation.
    """
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = _round_keys(key)
    out = number.astype(np.uint64)
    walk = np.arange(len(out))
    while len(walk):
        left, right = out[walk] >> half, out[walk] & mask
        for k in keys:
            left, right = right, left ^ (tx.mix(right ^ k) & mask)
        out[walk] = left << half | right
        walk = walk[out[walk] >= np.uint64(n)]
    return out.astype(np.int64)


def _pack(rows: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], length: int, end: int, kind) -> Iterator[pa.RecordBatch]:
    """Sequences of ``length`` ids from (document ids, token ids, first token of each document), in order."""
    block = TaskContext.get().partitionId()
    rest, rest_docs, rest_at = np.zeros(0, kind), np.zeros(0, np.int64), np.zeros(0, np.int64)
    number = 0

    def emit(ids, docs, at, count, tokens):
        nonlocal number
        cut = np.arange(count) * length
        # the document that each sequence starts in, and where in the document
        doc = np.searchsorted(at, cut, "right") - 1
        out = pa.RecordBatch.from_arrays([
            pa.array(np.full(count, block, np.int64)), pa.array(number + np.arange(count), pa.int64()),
            pa.array(docs[doc], pa.int64()), pa.array(cut - at[doc], pa.int64()), pa.array(tokens, pa.int32()),
            pa.array([ids[a:a + length].tobytes() for a in cut.tolist()], pa.binary())],
            ["block", "number", "first_doc", "first_token", "n_tokens", "data"])
        number += count
        return out

    for docs, ids, first in rows:
        n = np.diff(first)
        joined = np.full(len(ids) + len(n), end, kind)
        place = np.arange(len(ids)) + np.repeat(np.arange(len(n)), n)
        joined[place] = ids
        ids = np.concatenate([rest, joined])
        at = np.concatenate([rest_at, len(rest) + first[:-1] + np.arange(len(n))])
        docs = np.concatenate([rest_docs, docs])
        count = len(ids) // length
        if count:
            yield emit(ids, docs, at, count, np.full(count, length))
        keep = max(0, int(np.searchsorted(at, count * length, "right")) - 1)
        rest, rest_docs, rest_at = ids[count * length:], docs[keep:], at[keep:] - count * length
    if len(rest):
        padded = np.concatenate([rest, np.full(length - len(rest), end, kind)])
        yield emit(padded, rest_docs, rest_at, 1, np.array([len(rest)]))


_SEQUENCES = "block long, number long, first_doc long, first_token long, n_tokens int, data binary"


def sequences(docs: DataFrame, tokenizer: bpe.Tokenizer, end: int, id_col: str = "doc_id", text_col: str = "text",
              length: int = SEQUENCE_TOKENS) -> DataFrame:
    """Texts as token sequences of equal length, each document followed by the ``end`` token.

    Columns: block and number (the input partition and the place in it),
    first_doc and first_token (the document the sequence begins in and the place
    there), n_tokens (without padding), data (little-endian ids of 2 bytes, 4 if
    the vocabulary needs them).  Only a block's last sequence is padded, with
    ``end``.
    """
    shared = docs.sparkSession.sparkContext.broadcast((tokenizer.vocabulary, tokenizer.lexicon))

    def run(batches):
        vocabulary, lexicon = bpe._vocabulary(shared.value[0]), bpe._automaton(shared.value[1])
        kind = np.dtype("<u2") if vocabulary.size <= 1 << 16 else np.dtype("<u4")
        known = bpe.Known()

        def rows():
            for batch in batches:
                ids = batch.column("id").to_numpy(zero_copy_only=False)
                for at, data, off in tx.runs(batch.column("text"), bpe.RUN_BYTES):
                    tokens, first = bpe.encode_run(data, off, vocabulary, lexicon, known)
                    yield ids[at:at + len(off) - 1].astype(np.int64), tokens, first
        yield from _pack(rows(), length, end, kind)

    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, _SEQUENCES)


#: One of so many sequences of a block is counted to find the common units; byte that announces any other unit.
_COUNTED, _OTHER = 64, 255


def common_units(packed: DataFrame) -> list[int]:
    """The 255 commonest 16-bit units (ids of 2 bytes, halves of 4) of every 64th sequence; they only decide how small the shuffle is."""
    def run(batches):
        count = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for data in batch.column("data"):
                data = data.as_py() or b""
                count += np.bincount(np.frombuffer(data, "<u2", len(data) // 2), minlength=1 << 16)
        unit = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(unit, pa.int32()), pa.array(count[unit], pa.int64())], ["unit", "times"])

    counted = packed.filter(F.col("number") % _COUNTED == 0).select("data").mapInArrow(run, "unit int, times long")
    return [r["unit"] for r in counted.groupBy("unit").agg(F.sum("times").alias("times")).orderBy(F.desc("times"), "unit").limit(_OTHER).collect()]


def squeezed(data: list[bytes], common: Sequence[int] = ()) -> list[bytes]:
    """Each sequence as it is shuffled: common units in a byte, the others in three, all as zstd after the number of others."""
    codec = pa.Codec("zstd")
    code = np.full(1 << 16, _OTHER, np.uint8)
    code[np.asarray(common, np.int64)] = np.arange(len(common))
    out = []
    for x in data:
        units = np.frombuffer(x, "<u2", len(x) // 2)
        short = code[units]
        others = units[short == _OTHER]
        out.append(len(others).to_bytes(4, "little") + codec.compress(short.tobytes() + others.tobytes() + x[2 * len(units):], asbytes=True) if x else b"")
    return out


def unsqueezed(data: bytes, size: int, common: Sequence[int] = ()) -> bytes:
    if not size:
        return b""
    n, others = size // 2, int.from_bytes(data[:4], "little")
    coded = pa.Codec("zstd").decompress(memoryview(data)[4:], n + 2 * others + size % 2, asbytes=True)
    unit = np.zeros(1 << 8, "<u2")
    unit[:len(common)] = common
    short = np.frombuffer(coded, np.uint8, n)
    units = unit[short]
    units[short == _OTHER] = np.frombuffer(coded, "<u2", others, n)
    return units.tobytes() + coded[n + 2 * others:]


def _assembled(per_shard: int, common: Sequence[int]):
    def close(shard, rows):
        return pa.RecordBatch.from_arrays([
            pa.array([shard], pa.int64()), pa.array([shard * per_shard], pa.int64()), pa.array([len(rows)], pa.int32()),
            pa.array([[r[0] for r in rows]], pa.list_(pa.int64())), pa.array([[r[1] for r in rows]], pa.list_(pa.int64())),
            pa.array([[r[2] for r in rows]], pa.list_(pa.int32())), pa.array([b"".join(unsqueezed(*r[3:], common) for r in rows)], pa.large_binary())],
            ["shard", "first_slot", "n_sequences", "first_doc", "first_token", "n_tokens", "data"])

    def of(batches):
        now, rows = None, []
        for batch in batches:
            for shard, *row in zip(*(batch.column(c).to_pylist() for c in ("shard", "first_doc", "first_token", "n_tokens", "squeezed", "size")), strict=True):
                if shard != now and rows:
                    yield close(now, rows)
                    rows = []
                now = shard
                rows.append(row)
        if rows:
            yield close(now, rows)
    return of


_SHARDS = "shard long, first_slot long, n_sequences int, first_doc array<long>, first_token array<long>, n_tokens array<int>, data binary"


def shards(packed: DataFrame, key: int = 0, per_shard: int = SHARD_SEQUENCES) -> DataFrame:
    """Fixed-stride shards of packed sequences (see ``sequences``) in keyed random order, one row a shard.

    Slot s lies in shard s // per_shard at byte (s % per_shard) * stride.  Every
    shard but the last is full.  A shard holds ``per_shard`` sequences at most,
    so tasks stay bounded; the layout depends on the input's partitions and the
    key only, and a lost task writes the same bytes again.  Null and empty texts
    are an ``end`` token alone, a null document id shows as -1, repeated ids are
    packed like any others, other columns are ignored; an empty table gives no
    shard.
    """
    packed = settled(packed, "sequences", compression="zstd", **_STORED)
    blocks = packed.groupBy("block").agg(F.count("*").alias("n")).withColumn("part", F.floor(F.col("block") / _GROUP))
    # running totals in two steps: within groups of blocks, then over the groups
    inner = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n").alias("m")).withColumn("before", F.coalesce(F.sum("m").over(outer), F.lit(0)))
    starts = blocks.join(parts, "part").select("block", (F.col("before") + F.coalesce(F.sum("n").over(inner), F.lit(0))).alias("start"))
    starts = settled(starts, "starts")  # small on disk, so that Spark broadcasts it instead of shuffling the sequences
    total = blocks.agg(F.sum("n")).first()[0] or 0

    common = common_units(packed)

    def place(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, _PLACED):
                rows = batch.slice(at, _PLACED)
                data = [x or b"" for x in rows.column("data").to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    pa.array(slots(rows.column("number").to_numpy(zero_copy_only=False), total, key)),
                    *(rows.column(c) for c in ("first_doc", "first_token", "n_tokens")),
                    pa.array(squeezed(data, common), pa.binary()), pa.array([len(x) for x in data], pa.int32())],
                    ["slot", "first_doc", "first_token", "n_tokens", "squeezed", "size"])

    placed = (packed.join(starts, "block").select((F.col("start") + F.col("number")).alias("number"), "first_doc", "first_token", "n_tokens", "data")
              .mapInArrow(place, "slot long, first_doc long, first_token long, n_tokens int, squeezed binary, size int"))
    wanted = max(1, -(-total // per_shard))
    parts = min(wanted, max(1, int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    # slots are dense, so equal ranges of shards need no sampling run over the sequences
    return (placed.select(F.floor(F.col("slot") / per_shard).alias("shard"), "slot", "first_doc", "first_token", "n_tokens", "squeezed", "size")
            .repartitionById(parts, F.floor(F.col("shard") * parts / wanted).cast("int")).sortWithinPartitions("shard", "slot")
            .mapInArrow(_assembled(per_shard, common), _SHARDS))


def index(shard_rows: DataFrame) -> DataFrame:
    """One row per sequence of the shards: slot, shard, byte_offset, first_doc, first_token, n_tokens, sha256 of its bytes."""
    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("slot", "shard", "byte_offset", "first_doc", "first_token", "n_tokens", "sha256")}
            for shard, slot, n, docs, at, tokens, data in zip(*(batch.column(c).to_pylist() for c in (
                    "shard", "first_slot", "n_sequences", "first_doc", "first_token", "n_tokens", "data")), strict=True):
                stride = len(data) // n
                out["slot"] += range(slot, slot + n)
                out["shard"] += [shard] * n
                out["byte_offset"] += range(0, n * stride, stride)
                out["first_doc"] += docs
                out["first_token"] += at
                out["n_tokens"] += tokens
                out["sha256"] += [hashlib.sha256(data[k:k + stride]).hexdigest() for k in range(0, n * stride, stride)]
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.string() if k == "sha256" else pa.int32() if k == "n_tokens" else pa.int64())
                                              for k, v in out.items()], list(out))

    return shard_rows.mapInArrow(run, "slot long, shard long, byte_offset long, first_doc long, first_token long, n_tokens int, sha256 string")


_MANIFEST = ("shard long, path string, n_sequences int, n_bytes long, sha256 string, first_slot long, first_doc array<long>, "
             "first_token array<long>, n_tokens array<int>")


def write_shards(shard_rows: DataFrame, uri: str) -> DataFrame:
    """Write each shard to ``uri``/shard-<number>.bin and return the manifest.

    Columns: shard, path, n_sequences, n_bytes, sha256, and first_slot,
    first_doc, first_token and n_tokens as in ``shards``.  ``uri`` is a shared
    place that pyarrow's file systems know (a path, file, hdfs, s3, gs).  A shard
    is written under another name and then moved, so a file that is there is
    whole; it is left as it is if its bytes are the same, and replaced if another
    key or corpus left others there.
    """
    def same(store, path: str, data: bytes, digest: str) -> bool:
        if store.get_file_info(path).size != len(data):
            return False
        with store.open_input_stream(path) as f:
            return hashlib.sha256(f.read()).hexdigest() == digest

    def run(batches):
        store, base = file_store(uri)
        for batch in batches:
            paths, sizes, digests = [], [], []
            for shard, data in zip(batch.column("shard").to_pylist(), batch.column("data").to_pylist(), strict=True):
                digest = hashlib.sha256(data).hexdigest()
                path = f"{base}/shard-{shard:08d}.bin"
                if not same(store, path, data, digest):
                    put_file(f"{uri}/shard-{shard:08d}.bin", data)
                paths.append(path)
                sizes.append(len(data))
                digests.append(digest)
            own = {"path": pa.array(paths, pa.string()), "n_bytes": pa.array(sizes, pa.int64()), "sha256": pa.array(digests, pa.string())}
            names = ["shard", "path", "n_sequences", "n_bytes", "sha256", "first_slot", "first_doc", "first_token", "n_tokens"]
            yield pa.RecordBatch.from_arrays([own[c] if c in own else batch.column(c) for c in names], names)

    return shard_rows.mapInArrow(run, _MANIFEST)


def read_shards(manifest: DataFrame, uri: str) -> DataFrame:
    """The shards of a manifest (see ``write_shards``), their bytes read from the files under ``uri``.

    Raises if a file's bytes are not those of the manifest.
    """
    def run(batches):
        store, base = file_store(uri)
        for batch in batches:
            for k in range(batch.num_rows):  # one shard in memory at a time
                row = batch.slice(k, 1)
                shard = row.column("shard")[0].as_py()
                with store.open_input_stream(f"{base}/shard-{shard:08d}.bin") as f:
                    data = f.read()
                if hashlib.sha256(data).hexdigest() != row.column("sha256")[0].as_py():
                    raise ValueError(f"shard {shard} is not the one of the manifest")
                names = ["shard", "first_slot", "n_sequences", "first_doc", "first_token", "n_tokens"]
                yield pa.RecordBatch.from_arrays([*(row.column(c) for c in names), pa.array([data], pa.binary())], [*names, "data"])

    return manifest.mapInArrow(run, _SHARDS)


def read_slots(uri: str, first: int, last: int, length: int = SEQUENCE_TOKENS, per_shard: int = SHARD_SEQUENCES,
               kind: str = "<u2") -> Iterator[np.ndarray]:
    """The sequences of slots first .. last - 1, read in order: how a training run starts or resumes."""
    store, base = file_store(uri)
    stride = length * np.dtype(kind).itemsize
    slot = first
    while slot < last:
        shard, at = divmod(slot, per_shard)
        with store.open_input_file(f"{base}/shard-{shard:08d}.bin") as f:
            f.seek(at * stride)
            for _ in range(min(last - slot, per_shard - at)):
                yield np.frombuffer(f.read(stride), kind)
                slot += 1
