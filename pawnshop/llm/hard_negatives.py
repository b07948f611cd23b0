"""Hard negatives by the threshold algorithm over per-dimension sorted lists.

Vectors become integers, and a candidate's score for an anchor is their inner
product.  Candidates are dealt into blocks; a block keeps, for every dimension,
its candidates in the order of that component.  An anchor reads each list from
the end that its own component's sign favours, all lists in step.  Whatever it
meets is scored at once from the whole vectors.  The threshold is the score of
an imagined candidate with the components last read: nothing unread can score
more.  An anchor stops in a block when the threshold is strictly below the k-th
score of each of its windows, or below the window itself.

The lists are built once, and every block is visited by the anchors in chunks:
candidates don't travel, anchors do.  A first search with one window over the
anchor's own label finds its positives; these set the windows of the second
search, over all other labels.  No task holds more than a block and a chunk, and
no join sends its rows through the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from pawnshop.llm.frames import settled

#: Candidates of a block, and anchors of a chunk, on average.
BLOCK = 4096
CHUNK = 512
#: List positions read before the threshold is looked at for the first time; then twice as many each time.
FIRST_STEP = 16
#: 100 * score must lie between these multiples of the positive's score.
LOW, HIGH = 30, 90
_WHOLE = (-(1 << 62), 1 << 62)


def usable(rows: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """(id, label, vector): rows that take part, with the components x as floor(256 * x); x counts as a double."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), v.alias("vector"))
            .filter("id is not null and label is not null and size(vector) > 0").filter(fine)
            .withColumn("vector", F.transform("vector", lambda x: F.floor(x * 256.0).cast("long"))))


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = pc.list_flatten(column)
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    return flat.to_numpy(zero_copy_only=False).astype(np.int64).reshape(rows, -1)


def _bytes(x: np.ndarray, kind) -> bytes:
    return np.ascontiguousarray(x, kind).tobytes()


def _listed(table: pa.Table) -> pa.Table:
    """A block as one row: ids, labels, rows, vectors, and the candidates of each dimension by component."""
    table = table.sort_by([("id", "ascending"), ("row", "ascending")])  # a smaller place is a smaller id
    x = _matrix(table["vector"], table.num_rows)
    order = np.argsort(x, axis=0, kind="stable").T
    return pa.table({"block": table["block"][:1]} | {k: pa.array([_bytes(v, t)], pa.binary()) for k, v, t in (
        ("ids", table["id"].to_numpy(), np.int64), ("labels", table["label"].to_numpy(), np.int64), ("rows", table["row"].to_numpy(), np.int64),
        ("vectors", x, np.int64), ("order", order, np.int32))})


def _packed(table: pa.Table) -> pa.Table:
    """A chunk of anchors as one row, with the least and the highest score of each of an anchor's windows."""
    x = _matrix(table["vector"], table.num_rows)
    windows = table["positive_scores"].to_pylist()
    bounds = [b for w in windows for p in w for b in (_WHOLE if p is None else (-(-LOW * p // 100), HIGH * p // 100))]
    return pa.table({"chunk": table["chunk"][:1]} | {k: pa.array([_bytes(v, np.int64)], pa.binary()) for k, v in (
        ("a_ids", table["id"].to_numpy()), ("a_labels", table["label"].to_numpy()), ("a_rows", table["row"].to_numpy()), ("a_vectors", x),
        ("a_count", np.array([len(w) for w in windows])), ("a_windows", np.array(bounds, np.int64)))})


class Lists:
    """The sorted lists of one block."""

    def __init__(self, vectors: np.ndarray, order: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.x, self.ids, self.labels, self.rows = vectors, ids, labels, rows
        self.up, self.down = order, order[:, ::-1]
        self.n = len(ids)
        self.most = int(np.abs(vectors).max(initial=0))

    def search(self, anchor: np.ndarray, eligible: np.ndarray, windows: np.ndarray, k: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
        """(places, scores) of the first k eligible candidates of each window, higher scores first, and how many were scored."""
        bound = int(np.abs(anchor).max(initial=0)) * self.most * len(anchor)
        if bound >= 1 << 62:
            raise ValueError("scores of these vectors don't fit 64 bits")
        exact = np.float64 if bound < 1 << 53 else np.int64
        weight = anchor.astype(exact)
        used = np.flatnonzero(anchor)
        used = used if len(used) else np.arange(min(1, len(anchor)))
        signed = anchor[used]
        seen = np.zeros(self.n, bool)
        places, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, step = 0, FIRST_STEP
        while at < self.n:
            to = min(self.n, at + step)
            read = np.where(signed[:, None] > 0, self.down[used, at:to], self.up[used, at:to])
            met = seen.copy()
            met[read.ravel()] = True
            new = np.flatnonzero(met & ~seen & eligible)
            seen = met
            places = np.concatenate([places, new])
            scores = np.concatenate([scores, (self.x[new].astype(exact) @ weight).astype(np.int64)])
            threshold = int((self.x[read[:, -1], used] * signed).sum())
            if all(self._settled(scores, threshold, low, high, k) for low, high in windows.tolist()):
                break
            at, step = to, 2 * step
        out = []
        for low, high in windows.tolist():
            inside = np.flatnonzero((scores >= low) & (scores <= high))
            best = inside[np.lexsort((places[inside], -scores[inside]))[:k]]
            out.append((places[best], scores[best]))
        return out, len(places)

    @staticmethod
    def _settled(scores: np.ndarray, threshold: int, low: int, high: int, k: int) -> bool:
        if low > high or threshold < low:
            return True
        inside = scores[(scores >= low) & (scores <= high)]
        return len(inside) >= k and threshold < np.partition(inside, len(inside) - k)[len(inside) - k]


_HIT = "anchor long, anchor_id long, window int, row long, id long, score long, scored long"
_ANCHOR, _BLOCK = ("a_ids", "a_labels", "a_rows", "a_vectors", "a_count", "a_windows"), ("ids", "labels", "rows", "vectors", "order")


def _visits(k: int, same: bool):
    """Search each block for each chunk that comes with it."""

    def of(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_buffer() for c in (*_ANCHOR, *_BLOCK)}
                read = lambda c, kind=np.int64: np.frombuffer(row[c], kind)  # noqa: E731, B023
                ids, labels, rows = read("ids"), read("labels"), read("rows")
                lists = Lists(read("vectors").reshape(len(ids), -1), read("order", np.int32).reshape(-1, len(ids)), ids, labels, rows)
                a_ids, a_labels, a_rows = read("a_ids"), read("a_labels"), read("a_rows")
                vectors, first = read("a_vectors").reshape(len(a_ids), -1), np.concatenate([[0], np.cumsum(read("a_count"))])
                windows = read("a_windows").reshape(-1, 2)
                out = []
                for a in range(len(a_ids)):
                    eligible = ((labels == a_labels[a]) & (rows != a_rows[a])) if same else labels != a_labels[a]
                    found, scored = lists.search(vectors[a], eligible, windows[first[a]:first[a + 1]], k)
                    for w, (places, scores) in enumerate(found):
                        out += [(a_rows[a], a_ids[a], w, rows[p], ids[p], s, scored) for p, s in zip(places, scores, strict=True)]
                columns = list(zip(*out, strict=True)) if out else [()] * 7
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(np.array(c, np.int64), pa.int64()).cast(t) for c, t in zip(columns, kinds, strict=True)],
                                                 [x.split()[0] for x in _HIT.split(", ")])

    return of


def _search(blocks: DataFrame, count: int, anchors: DataFrame, k: int, same: bool) -> DataFrame:
    """The first k of each anchor and window over all blocks."""
    chunks = max(1, -(-anchors.count() // CHUNK))
    packed = (anchors.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks))).groupBy("chunk")
              .applyInArrow(_packed, "chunk long, " + ", ".join(f"{c} binary" for c in _ANCHOR)))
    # the stated anchors visit all rows, block by block
    visits = packed.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))))
    # a chunk's row is repeated for every block, which Spark's size estimate doesn't see: it would broadcast all visits from the driver
    hits = visits.join(blocks.hint("merge"), "block").mapInArrow(_visits(k, same), _HIT)
    place = F.row_number().over(Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id", "row"))
    return hits.withColumn("rank", place).filter(F.col("rank") <= k)


def mine(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, id_col: str = "vec_id", label_col: str = "label",
         vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): each anchor's first ``positives`` other rows of
    its label, and for each the first ``negatives`` rows of other labels with LOW * positive <= 100 * negative <= HIGH * positive.

    ``anchors`` is a condition on (id, label, vector).  Higher scores come
    first, ties by smaller id.  Null ids, labels and vectors, empty vectors,
    null and non-finite components and vectors of another length than the most
    frequent take no part.  Every row counts for itself, repeated ones too: a
    repeated anchor has the other among its positives.  Fewer rows than asked
    for are all returned; an empty table gives an empty result; other columns
    are ignored, whatever their names.  Components whose scores would not fit
    64 bits raise an error.
    """
    spark = rows.sparkSession
    own = settled(usable(rows, id_col, label_col, vector_col).withColumn("row", F.monotonically_increasing_id()), "integers")
    size = own.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if size is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    own = own.filter(F.size("vector") == size["d"])
    count = max(1, -(-size["count"] // BLOCK))
    blocks = settled(own.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(count))).groupBy("block").applyInArrow(
        _listed, "block long, " + ", ".join(f"{c} binary" for c in _BLOCK)), "lists")
    asked = own.filter(anchors)
    first = asked.withColumn("positive_scores", F.array(F.lit(None).cast("long")))
    near = settled(_search(blocks, count, first, positives, True).select("anchor", "rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # a few positives an anchor
    windows = near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "positive_score")))["positive_score"].alias("positive_scores"))
    second = asked.join(windows.withColumnRenamed("anchor", "row").hint("merge"), "row")
    found = _search(blocks, count, second, negatives, False)
    return (found.select("anchor", "anchor_id", F.col("window").alias("w"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                         F.col("score").alias("negative_score"))
            .join(near.withColumn("w", (F.col("rank") - 1).cast("int")).drop("rank").hint("merge"), ["anchor", "w"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
