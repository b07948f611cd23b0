"""Approximate nearest neighbours with a hash-prefix forest.

Each tree gives every vector a long bit string (signs of random projections of
the centred vector); the index of a tree is the sorted array of its strings.  A
query descends in every tree to its longest matching prefix, then all trees
ascend together, one bit at a time, until the prefixes shared with the query
hold enough candidates.  Candidates are ranked by their exact distance.

The index is cut into blocks of ``BLOCK`` vectors, each a forest of its own;
queries visit all blocks and keep their nearest of each.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from pawnshop.llm.frames import settled

TREES = 96
BITS = 32
BLOCK = 4096
#: Queries that visit a block together.
QUERY_BLOCK = 2048
#: What the prefixes of all trees must hold before the ascent ends, counting a vector once per tree that shows it:
#: this share of the block's vectors, and at least so many.
SHARE = 0.75
LEAST = 3000
SEED = 11


def planes(dimension: int) -> np.ndarray:
    """Projections of all trees; each tree's are orthogonal where the dimension allows it, so its bits tell more apart."""
    rng = np.random.default_rng(SEED)
    out = []
    for _ in range(TREES):
        rows = []
        while sum(len(r) for r in rows) < BITS:
            q, _ = np.linalg.qr(rng.normal(size=(dimension, dimension)))
            rows.append(q.T)
        out.append(np.concatenate(rows)[:BITS])
    return np.concatenate(out)


def strings(vectors: np.ndarray, centre: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """The bit string of each vector in each tree, as a number whose first bit is the highest."""
    out = np.empty((len(vectors), TREES), np.uint32)
    weight = (np.uint64(1) << np.arange(BITS - 1, -1, -1, dtype=np.uint64)).astype(np.float64)
    for t in range(TREES):
        side = (vectors - centre) @ directions[t * BITS:(t + 1) * BITS].T > 0
        out[:, t] = (side @ weight).astype(np.uint64)
    return out


class Forest:
    """Sorted bit strings of one block of vectors."""

    def __init__(self, vectors: np.ndarray, centre: np.ndarray, directions: np.ndarray):
        self.vectors, self.n = vectors, len(vectors)
        key = strings(vectors, centre, directions)
        self.order = np.argsort(key, axis=0, kind="stable").T.copy()
        self.sorted = [key[o, t] for t, o in enumerate(self.order)]

    def candidates(self, query: np.ndarray, wanted: float):
        """For each row of query strings, the places of the vectors under the deepest common level that holds enough."""
        lo = np.zeros((len(query), TREES), np.int64)
        hi = np.zeros((len(query), TREES), np.int64)
        todo = np.arange(len(query))
        for depth in range(BITS, -1, -1):
            low = np.uint64(BITS - depth)
            first = (query[todo].astype(np.uint64) >> low) << low
            last = first + (np.uint64(1) << low) - np.uint64(1)
            for t in range(TREES):
                lo[todo, t] = np.searchsorted(self.sorted[t], first[:, t].astype(np.uint32), "left")
                hi[todo, t] = np.searchsorted(self.sorted[t], last[:, t].astype(np.uint32), "right")
            todo = todo[(hi[todo] - lo[todo]).sum(1) < wanted]
            if not len(todo):
                break
        for q in range(len(query)):
            seen = np.zeros(self.n, bool)
            for t in range(TREES):
                seen[self.order[t, lo[q, t]:hi[q, t]]] = True
            yield np.flatnonzero(seen)


_HIT = "query long, vec_id long, score double"


def _search(k: int, centre: np.ndarray, dimension: int):
    directions = planes(dimension)

    def of(key, block, queries):
        if not len(block) or not len(queries):
            return pd.DataFrame({"query": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        vectors = np.array(block["vector"].tolist(), np.float64)
        copies = block["ids"].tolist()
        forest = Forest(vectors, centre, directions)
        points = np.array(queries["vector"].tolist(), np.float64)
        out = []
        for q, point, found in zip(queries["id"].tolist(), points, forest.candidates(strings(points, centre, directions), max(LEAST, SHARE * len(vectors))), strict=True):
            gap = vectors[found] - point
            score = np.sqrt((gap * gap).sum(1))
            # copies of a vector share its distance: k + 1 of their smallest ids are enough for any query
            near = found[score <= np.partition(score, min(k, len(score) - 1))[min(k, len(score) - 1)]] if len(score) else found
            value = dict(zip(found.tolist(), score.tolist(), strict=True))
            rows = sorted((value[i], v) for i in near.tolist() for v in copies[i] if v != q)[:k]
            out += [(q, v, s) for s, v in rows]
        return pd.DataFrame(out, columns=["query", "vec_id", "score"]).astype({"query": "int64", "vec_id": "int64", "score": "float64"})
    return of


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, vector) of the rows that take part: no null id, no null, empty or zero vector, only finite components."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("vector")).filter("id is not null and vector is not null")
            .filter(F.coalesce(fine, F.lit(False)) & F.exists("vector", lambda x: x != 0)))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query, by Euclidean distance, ties to the smaller id.

    ``queries`` are rows like ``vectors``; a query is never its own neighbour.
    Null, empty, zero and non-finite vectors, null ids and vectors of another
    length than the most frequent take no part.  Of a repeated id the smallest
    vector counts.  Equal vectors are indexed once, with their k + 1 smallest
    ids, which is all that a query can return of them.  Fewer than k candidates
    give fewer rows; an empty table gives an empty result; other columns are
    ignored, whatever their names.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col).groupBy("id").agg(F.min("vector").alias("vector"))
    rows = settled(rows, "vectors")
    size = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if size is None:
        return empty
    dimension = size["d"]
    rows = rows.filter(F.size("vector") == dimension)
    mean = rows.select(F.posexplode("vector")).groupBy("pos").agg(F.avg("col").alias("m")).orderBy("pos").collect()  # one row a dimension
    centre = np.array([r["m"] for r in mean])
    # map-side: the smallest ids are merged level by level, so a vector of a third of all rows stays a few rows a task
    salted = (rows.groupBy("vector", F.pmod(F.xxhash64("id"), F.lit(64)).alias("salt"))
              .agg(F.slice(F.array_sort(F.collect_list("id")), 1, k + 1).alias("ids")))
    distinct = salted.groupBy("vector").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids"))
    distinct = settled(distinct, "distinct")
    blocks = max(1, -(-distinct.count() // BLOCK))
    asked = settled(usable(queries, id_col, vector_col).filter(F.size("vector") == dimension).groupBy("id").agg(F.min("vector").alias("vector")), "queries")
    chunks = max(1, -(-asked.count() // QUERY_BLOCK))
    index = (distinct.withColumn("block", F.pmod(F.xxhash64("vector"), F.lit(blocks)))
             .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))))
    visits = (asked.withColumn("chunk", F.pmod(F.xxhash64("id", F.lit("q")), F.lit(chunks)))
              .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))))
    keys = [F.col("block").cast("long"), F.col("chunk").cast("long")]
    hits = (index.withColumns({"block": keys[0], "chunk": keys[1]}).groupBy("block", "chunk")
            .cogroup(visits.withColumns({"block": keys[0], "chunk": keys[1]}).groupBy("block", "chunk"))
            .applyInPandas(_search(k, centre, dimension), _HIT))
    # at most k rows a query and block reach the last step
    ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id")).cast("int"))
    return ranked.filter(F.col("rank") <= k).select(F.col("query").alias("query_id"), "rank", "vec_id", "score")
