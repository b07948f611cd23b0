"""Near-duplicate groups by Order MinHash.

A text is the sequence of its distinct five-word shingles, each where it occurs
first; search and alignment use the same sequence, so that a line's number of
repeats counts in neither.  For each of ``SKETCHES`` random orders of all
shingles, the ``PER_SKETCH`` smallest are taken and kept *in text order*; their
hash is the sketch.  Two texts share a sketch only if they share those shingles in the same
order, which makes the chance of a shared sketch follow edit similarity rather
than set similarity.  Texts that share a sketch are candidates; a banded
alignment of their shingle sequences decides.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from pawnshop.llm import text as tx
from pawnshop.llm.components import components
from pawnshop.llm.frames import settled

WORDS = 5
SIMILARITY = 0.8
SKETCHES = 20
PER_SKETCH = 3
# Texts of similarity 0.8 share each sketch with probability 0.8 ** 3 = 0.51: they share none of the 20
# with probability 1e-6.
#: 64-bit words of a text's mark, which holds the parity of its shingles by hash.
MARK_WORDS = 16
#: Centres that each bucket gets in a turn after the first.
CENTRES = 3
#: Buckets of at most so many members are compared pair by pair; the members of larger ones by rare shingles.
FEW_MEMBERS = 32
_SEEDS = tx.mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _smallest(mixed: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Hash of the smallest shingles in text order, one for each seed."""
    n = len(mixed)
    take = min(PER_SKETCH, n)
    order = (mixed[None, :] ^ seeds[:, None]) * seeds[:, None]
    order ^= order >> np.uint64(32)
    order *= np.uint64(0xD6E8FEB86659FD93)
    at = np.argpartition(order, take - 1, axis=1)[:, :take] if take < n else np.tile(np.arange(n), (len(seeds), 1))
    at.sort(axis=1)
    out = np.full(len(seeds), n if n < PER_SKETCH else 0, np.uint64)
    for j in range(take):
        out = tx.mix(out * np.uint64(31) + mixed[at[:, j]])
    return out


def order_minhash(shingle: np.ndarray) -> np.ndarray:
    """``SKETCHES`` order-sensitive sketches of one text's distinct shingle hashes."""
    mixed = tx.mix(shingle)
    if len(shingle) <= 65536:
        return _smallest(mixed, _SEEDS)
    return np.concatenate([_smallest(mixed, _SEEDS[i:i + 1]) for i in range(SKETCHES)])


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Banded alignment of two sequences of distinct shingles: matched / (all - matched).

    Matched is the longest chain of equal shingles in the same order in both
    sequences.  Only matches within the band |i - j| <= n - m are chained, where
    n is the longer length and m the fewest matches that reach ``least``; no
    alignment that reaches it leaves the band.  0 if ``least`` can't be reached.
    """
    if not len(a) or not len(b):
        return 0.0
    need = int(np.ceil(least * (len(a) + len(b)) / (1 + least) - 1e-9))
    if need > min(len(a), len(b)):
        return 0.0
    order = np.argsort(b)
    at = np.minimum(np.searchsorted(b[order], a), len(b) - 1)
    j = order[at]
    i = np.flatnonzero((b[j] == a) & (np.abs(j - np.arange(len(a))) <= max(len(a), len(b)) - need))
    if len(i) < need:
        return 0.0
    j = j[i]
    if (j[1:] > j[:-1]).all():
        chain = len(j)
    else:
        tails: list[int] = []
        for x in j.tolist():
            k = bisect_left(tails, x)
            tails[k:k + 1] = [x]
        chain = len(tails)
    return chain / (len(a) + len(b) - chain)


def distinct_in_order(shingle: np.ndarray) -> np.ndarray:
    _, first = np.unique(shingle, return_index=True)
    return shingle[np.sort(first)]


_SKETCHED = "id long, n int, print1 long, print2 long, sketch array<long>"


def _sketch(batches):
    for batch in batches:
        ids = batch.column("id")
        for at, data, off in tx.runs(batch.column("text")):
            word, first = tx.words(data, off)
            sh, start = tx.shingles(word, first, WORDS)
            keep = np.flatnonzero(np.diff(start))
            sketches, distinct = [], []
            place = np.arange(len(sh), dtype=np.uint64)
            # two independent fingerprints of the whole shingle sequence
            one = np.concatenate([[np.uint64(0)], np.cumsum(tx.mix(sh))])
            two = np.concatenate([[np.uint64(0)], np.cumsum(
                tx.mix(sh ^ ((place - np.repeat(start[:-1], np.diff(start)).astype(np.uint64)) * np.uint64(0xA24BAED4963EE407))))])
            for r in keep:
                own = distinct_in_order(sh[start[r]:start[r + 1]])
                distinct.append(len(own))
                sketches.append(order_minhash(own))
            prints, other = one[start[keep + 1]] - one[start[keep]], two[start[keep + 1]] - two[start[keep]]
            flat = tx.signed(np.concatenate(sketches)) if sketches else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                ids.slice(at, len(off) - 1).take(pa.array(keep)).cast(pa.int64()),
                pa.array(distinct, pa.int32()),
                pa.array(tx.signed(prints), pa.int64()),
                pa.array(tx.signed(other), pa.int64()),
                tx.list_array(flat, np.arange(len(keep) + 1) * SKETCHES, pa.int64())],
                ["id", "n", "print1", "print2", "sketch"])


_MARK = [f"m{k}" for k in range(MARK_WORDS)]
_SHINGLES = "id long, n int, " + ", ".join(f"{m} long" for m in _MARK) + ", shingles array<long>"


def marks(rows: list[np.ndarray]) -> np.ndarray:
    """One row of ``MARK_WORDS`` words for each set of shingles: the parity of the shingles that fall on each bit.

    A shingle that only one of two sets has turns one bit, so the marks of two sets differ
    in no more bits than the sets differ in shingles.
    """
    bits = np.zeros((len(rows), 64 * MARK_WORDS), bool)
    for k, x in enumerate(rows):
        bits[k] = np.bincount((tx.mix(x) % np.uint64(64 * MARK_WORDS)).astype(np.int64), minlength=64 * MARK_WORDS) & 1
    return np.packbits(bits, axis=1).view(np.int64)


def _shingle_rows(batches):
    for batch in batches:
        ids = batch.column("id")
        for at, data, off in tx.runs(batch.column("text")):
            sh, start = tx.shingles(*tx.words(data, off), WORDS)
            rows = [distinct_in_order(sh[start[r]:start[r + 1]]) for r in range(len(off) - 1)]
            mark, size = marks(rows), np.array([len(x) for x in rows], np.int64)
            yield pa.RecordBatch.from_arrays([
                ids.slice(at, len(rows)).cast(pa.int64()), pa.array(size.astype(np.int32)),
                *(pa.array(np.ascontiguousarray(mark[:, k])) for k in range(MARK_WORDS)),
                tx.list_array(tx.signed(np.concatenate(rows)), np.concatenate([[0], np.cumsum(size)]), pa.int64())],
                ["id", "n", *_MARK, "shingles"])


def _aligned(batches):
    for batch in batches:
        sides = []
        for name in ("left", "right"):
            col = batch.column(name)
            off = col.offsets.to_numpy()
            flat = tx.unsigned(col.values.to_numpy(zero_copy_only=False).astype(np.int64))
            sides.append([flat[x:y] for x, y in zip(off[:-1], off[1:], strict=True)])
        score = np.array([similarity(x, y) for x, y in zip(*sides, strict=True)], float)
        ok = np.flatnonzero(score >= SIMILARITY)
        names = ["a", "b", "ra", "rb"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(ok)) for c in names), pa.array(score[ok])], [*names, "similarity"])


def _keys(sketched: DataFrame) -> DataFrame:
    return sketched.select("id", F.posexplode("sketch").alias("band", "key"))


def _may_link(x: str, y: str):
    """Whether two rows (id, n, mark, root) could be a link between two classes.

    Exact: texts of similarity 0.8 have at least ``need`` shingles in common, so the smaller has 0.8 of the
    larger one's number and the others, in which their marks may differ, are at most n + n - 2 need.
    """
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    need = F.ceil(SIMILARITY * (n + m) / (1 + SIMILARITY) - 1e-9)
    differ = sum((F.bit_count(F.col(f"{x}.{w}").bitwiseXOR(F.col(f"{y}.{w}"))) for w in _MARK), F.lit(0))
    return (F.col(f"{x}.root") != F.col(f"{y}.root")) & (need <= F.least(n, m)) & (differ <= n + m - 2 * need)


def _ordered(pairs: DataFrame) -> DataFrame:
    """Pairs of rows x and y as (a, b, class of a, class of b), the larger id first; each pair once."""
    larger = F.col("x.id") > F.col("y.id")
    return pairs.select(F.greatest("x.id", "y.id").alias("a"), F.least("x.id", "y.id").alias("b"),
                        F.when(larger, F.col("x.root")).otherwise(F.col("y.root")).alias("ra"),
                        F.when(larger, F.col("y.root")).otherwise(F.col("x.root")).alias("rb")).distinct()


_ROW = ("id", "n", *_MARK, "root")


def _pairs(members: DataFrame, turn: int) -> DataFrame:
    """Each member of a bucket with the bucket's centres, if they could be a link between two classes.

    A few rows a member at most, so linear in the bucket.  A centre is the
    member that a hash of the ids puts first; one hash serves all bands, so
    that a group that shares many buckets shares its centres as well.
    """
    draws = range(CENTRES * turn, CENTRES * (turn + 1)) if turn else range(1)
    drawn = [F.min(F.struct(F.xxhash64("id", F.lit(k)).alias("draw"), *_ROW)) for k in draws]
    centres = (members.groupBy("band", "key").agg(F.array(*drawn).alias("all"))
               .select("band", "key", F.explode(F.array_distinct(F.transform("all", lambda c: c.dropFields("draw")))).alias("y")))
    return _ordered(members.select("band", "key", F.struct(*_ROW).alias("x")).join(centres, ["band", "key"]).filter(_may_link("x", "y")))


def _sizes(members: DataFrame) -> DataFrame:
    return members.groupBy("band", "key").agg(F.count("*").alias("size"))


def _remaining(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Every pair of two classes that shares a bucket and could be a link: (a, b, class of a, class of b).

    Small buckets give their pairs.  In large ones two texts meet if they share
    one of their rarest shingles.  Linked texts of n and m <= n shingles have at
    least 0.8 n and 0.8 (n + m) / 1.8 in common, so the rarest common one is among
    the n - 0.8 n + 1 rarest of the larger and, ``short``, among the m - 0.89 m + 1
    rarest of the smaller: no link is lost.
    """
    sizes = _sizes(members)
    row = F.struct(*_ROW)
    small = members.join(sizes.filter(F.col("size") <= FEW_MEMBERS).select("band", "key"), ["band", "key"])
    near = small.select("band", "key", row.alias("x")).join(small.select("band", "key", row.alias("y")), ["band", "key"])
    near = near.filter("x.id > y.id").filter(_may_link("x", "y"))
    crowd = settled(members.join(sizes.filter(F.col("size") > FEW_MEMBERS).select("band", "key"), ["band", "key"])
                    .select(*_ROW).dropDuplicates(["id"]), "crowd")
    if crowd.isEmpty():
        return _ordered(near)
    shingle = texts.join(crowd.select("id"), "id", "left_semi").select("id", F.explode("shingles").alias("shingle"))
    counted = shingle.withColumn("texts", F.count("*").over(Window.partitionBy("shingle")))

    def rarest(share: float) -> str:
        return f"cast(size(all) - ceil({share!r} * size(all) - 1e-9) + 1 as int)"

    rare = (counted.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("texts", "shingle"))).alias("all"))
            .select("id", F.expr(rarest(2 * SIMILARITY / (1 + SIMILARITY))).alias("few"), F.posexplode(F.expr(f"slice(all, 1, {rarest(SIMILARITY)})")).alias("at", "r"))
            .filter("r.texts > 1").select("id", (F.col("at") < F.col("few")).alias("short"), F.col("r.shingle").alias("shingle")))
    rare = settled(rare.join(crowd, "id").select("shingle", F.struct(*_ROW, "short").alias("x")), "rare")
    # few bytes, but much to compare: as many tasks as the session's shuffles have
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sides = rare.repartition(tasks, "shingle")
    far = sides.join(sides.select("shingle", F.col("x").alias("y")), "shingle").filter("x.id > y.id")
    far = far.filter("(x.n >= y.n and y.short) or (y.n >= x.n and x.short)").filter(_may_link("x", "y"))
    return _ordered(near).unionByName(_ordered(far)).distinct()


def _merged(roots: DataFrame | None, found: DataFrame) -> DataFrame:
    """(id, root) after the classes of each found pair were drawn together.

    Every class moves to its smallest neighbour, twice over.  Chains may stay
    apart here and be merged by a later turn; the final classes are the
    components of all links.
    """
    edges = found.select(F.explode(F.array(F.struct(F.col("ra").alias("x"), F.col("rb").alias("y")),
                                           F.struct(F.col("rb").alias("x"), F.col("ra").alias("y")))).alias("e")).select("e.*")
    step = settled(edges.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m")), "steps")
    further = step.select(F.col("x").alias("m"), F.col("m").alias("m2"))
    step = step.join(further, "m", "left").select("x", F.coalesce("m2", "m").alias("m"))
    ids = step.select(F.col("x").alias("id"), F.col("x").alias("root"))
    if roots is not None:
        ids = ids.unionByName(roots).groupBy("id").agg(F.min("root").alias("root"))
    return settled(ids.join(step, ids["root"] == step["x"], "left").select("id", F.coalesce("m", "root").alias("root")), "classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, class_id): the smallest id of each text's group of near-duplicates.

    Two texts are linked if the aligned similarity of their distinct five-word
    shingles is 0.8 or more (equal word sequences always are; ASCII case and
    white space don't count).  Groups are the connected components of the links.
    A text of one to four words is one shingle.  Null, empty and blank texts
    have no shingles: each is its own class.  A null id gets its own null class;
    repeated ids give one row each and share their class.  Other columns are
    ignored, whatever their names; an empty table gives an empty result.

    Equal texts are first collapsed to one representative, so copies cost one
    row per task.  Every bucket of equal sketches is first compared with drawn
    centres; buckets that still hold several classes go through further turns
    with other centres as long as these add links.  What is left of several
    classes then is compared whole, every pair that shares enough sketches and
    that exact filters don't exclude.  No bucket, group or number of candidates
    is capped.
    """
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sketched = settled(src.filter("id is not null").mapInArrow(_sketch, _SKETCHED), "sketch")
    prints = sketched.select("id", "n", "print1", "print2")
    reps = prints.groupBy("n", "print1", "print2").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    rep_rows = sketched.join(reps.select(F.col("rep").alias("id")).distinct(), "id", "left_semi").dropDuplicates(["id"])
    shared = settled(_keys(rep_rows).join(
        _keys(rep_rows).groupBy("band", "key").agg(F.count("*").alias("size")).filter("size > 1").select("band", "key"),
        ["band", "key"]), "bands")
    texts = settled(src.join(shared.select("id").distinct(), "id", "left_semi").mapInArrow(_shingle_rows, _SHINGLES)
                    .dropDuplicates(["id"]), "shingles")
    members = settled(shared.join(texts.drop("shingles"), "id"), "members")

    def linked(pairs: DataFrame) -> DataFrame:
        return settled(pairs.join(texts.select(F.col("id").alias("a"), F.col("shingles").alias("left")), "a")
                       .join(texts.select(F.col("id").alias("b"), F.col("shingles").alias("right")), "b")
                       .select("a", "b", "ra", "rb", "left", "right")
                       .mapInArrow(_aligned, "a long, b long, ra long, rb long, similarity double"), "links")

    links, classes, turn, crowded = None, None, 0, None
    todo = members.withColumn("root", F.col("id"))
    while True:
        found = linked(_pairs(todo, turn))
        if found.isEmpty():
            break
        links = found if links is None else links.unionByName(found)
        classes = _merged(classes, found)
        classed = members.join(classes, "id", "left").withColumn("root", F.coalesce("root", "id"))
        mixed = classed.groupBy("band", "key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi")
        todo = settled(classed.join(mixed.select("band", "key"), ["band", "key"]), "mixed")
        turn += 1
        before, crowded = crowded, _sizes(todo).filter(F.col("size") > FEW_MEMBERS).agg(F.sum("size")).first()[0] or 0
        if not crowded or before is not None and 2 * crowded > before:
            break
    # the turns say nothing of the pairs they didn't draw
    found = linked(_remaining(todo, texts))
    links = found if links is None else links.unionByName(found)
    rep_class = reps.select("n", "print1", "print2", "rep")
    roots = components(links.select("a", "b"))
    rep_class = (rep_class.join(roots, rep_class["rep"] == roots["node"], "left")
                 .select("n", "print1", "print2", F.coalesce("root", "rep").alias("rep")))
    classes = prints.join(rep_class, ["n", "print1", "print2"]).groupBy("id").agg(F.min("rep").alias("class_id"))
    # an id that repeats with several texts joins their classes under its smallest
    return (src.select("id").join(classes, "id", "left")
            .select(F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id")))
