"""Connected components of an edge table, as a Spark job."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pawnshop.llm.frames import settled


def components(edges: DataFrame) -> DataFrame:
    """Smallest node id reachable from each node: columns (node, root).

    ``edges`` has integer columns (a, b), in any direction; loops and repeated
    edges do no harm, nodes without an edge don't appear.  Alternates the two
    star operations of Kiveris et al.: every node sends its larger (then its
    smaller) neighbours to its smallest one, until nothing changes.  Each round
    is written to the shared folder; the only value the driver sees is one
    checksum.  Aggregates are partial, so a hub costs one row per task.
    """
    both = lambda e: e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    now = settled(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .filter("a <> b").distinct(), "edges")
    before = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return (now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
                    .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
        before = mark
        sides = both(now)
        least = sides.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = sides.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        now = settled(small.filter("a <> b").distinct(), "edges")
