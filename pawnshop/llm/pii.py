"""Personal data by bootstrapped contextual extraction.

Fixed patterns find the seed entities.  The words around a seed induce lexical
patterns (the two words before; the word before and the word after).  Every
other identifier-like string of the corpus in such a context is an instance;
patterns and instances form a graph whose two sides are scored in turn: a
pattern is as reliable as the instances it finds, an instance as reliable as
its patterns.  Instances of high-confidence patterns are added to the seeds and
induce patterns in their turn.
"""

from __future__ import annotations

import re
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pawnshop.llm import spans as sp, text as tx
from pawnshop.llm.frames import settled

KINDS = ("email", "ip", "card", "phone")
#: Rounds at the least.
ROUNDS = 3
#: A pattern counts once so many different seeds or accepted instances of one kind stand in it.
LEAST_SEEDS = 3
CONFIDENCE = 0.8

_LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(rb"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match can only begin where a run of digits begins, which keeps the search linear.
_IP = re.compile(rb"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
_NUMBER = re.compile(rb"(?<![0-9A-Za-z])[+(]?[0-9](?:[\x20().:/-]{0,2}[0-9]){5,23}(?![0-9A-Za-z])")
_NOT_SPACE = re.compile(rb"[^\s@<>()\[\],;\"']{1,64}")
_DIGITS = np.zeros(256, bool)
_DIGITS[48:58] = True


def luhn(digits: bytes) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d -= 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(raw: bytes):
    done, at = 0, raw.find(b"@")
    while at >= 0:
        start = at
        while start > done and raw[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(raw, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = raw.find(b"@", at + 1)


def base_spans(raw: bytes) -> list[tuple[int, int, str]]:
    """(start, end, kind) in bytes: leftmost, non-overlapping within a kind, by start and then kind."""
    out = [(a, b, "email") for a, b in _emails(raw)]
    for m in _IP.finditer(raw):
        if all(len(p.lstrip(b"0")) <= 3 and int(p.lstrip(b"0") or b"0") <= 255 for p in m.group().split(b".")):
            out.append((*m.span(), "ip"))
    for m in _CARD.finditer(raw):
        if m.end() - m.start() < 40:
            digits = m.group().translate(None, b" -")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((*m.span(), "card"))
    for m in _PHONE.finditer(raw):
        if 10 <= len(m.group().translate(None, b" ().+-")) <= 15:
            out.append((*m.span(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def _candidates(raw: bytes, taken: list[tuple[int, int, str]]):
    """Identifier-like strings that no base span overlaps: (start, end, kinds they could be)."""
    found = []
    for m in _NUMBER.finditer(raw):
        digits = sum(48 <= c < 58 for c in m.group())
        kinds = [k for k, ok in (("ip", m.group().count(b".") + m.group().count(b":") >= 3), ("card", 12 <= digits <= 19),
                                 ("phone", 7 <= digits <= 15)) if ok]
        if kinds:
            found.append((*m.span(), kinds))
    at = raw.find(b"@")
    while at >= 0:
        start = at
        while start > max(0, at - 64) and _NOT_SPACE.fullmatch(raw, start - 1, start):
            start -= 1
        m = _NOT_SPACE.match(raw, at + 1)
        if start < at and m:
            end = at + 1 + len(m.group().rstrip(b".!?:"))
            if end > at + 1:
                found.append((start, end, ["email"]))
        at = raw.find(b"@", at + 1)
    found.sort(key=lambda s: s[:2])
    k, end = 0, 0
    taken = sorted(taken)
    reach = 0
    for start, stop, kinds in found:
        while k < len(taken) and taken[k][0] < stop:
            reach = max(reach, taken[k][1])
            k += 1
        if start >= reach and start >= end:
            yield start, stop, kinds
            end = stop


def _code(*parts: bytes) -> int:
    return int.from_bytes(blake2b(b"\0".join(parts), digest_size=8).digest(), "big", signed=True)


def _bare(word: bytes) -> bytes:
    return word.lower().strip(b".,;:!?\"'()[]{}<>=*#|-")


def contexts(raw: bytes, start: int, end: int) -> list[int]:
    """Codes of the lexical patterns around a span: two words before; one before and one after."""
    before = [_bare(w) for w in raw[max(0, start - 96):start].split()[-2:]]
    after = [_bare(w) for w in raw[end:end + 64].split()[:1]]
    out = []
    if len(before) == 2 and all(before):
        out.append(_code(b"L2", *before))
    if before and after and before[-1] and after[0]:
        out.append(_code(b"L1R1", before[-1], after[0]))
    return out


_FOUND = (f"id long, print long, base array<{sp.SPAN}>, "
          "slots array<struct<start:int,end:int,seed:string,kinds:array<string>,instance:long,patterns:array<long>>>")


def _extract(batches):
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    slot = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("seed", pa.string()), ("kinds", pa.list_(pa.string())),
                      ("instance", pa.int64()), ("patterns", pa.list_(pa.int64()))])
    for batch in batches:
        for at, data, off in tx.runs(batch.column("text")):
            n = len(off) - 1
            base, slots = [[] for _ in range(n)], [[] for _ in range(n)]
            rows = np.union1d(sp.rows_with(_DIGITS[data], off, 4), sp.rows_with(data == 64, off))
            place = sp.char_index(data) if len(rows) else None
            for r in rows.tolist():
                raw = data[off[r]:off[r + 1]].tobytes()
                char = lambda b, r=r: int(place[off[r] + b] - place[off[r]])
                own = base_spans(raw)
                base[r] = [{"kind": k, "start": char(a), "end": char(b)} for a, b, k in own]
                for a, b, seed, kinds in [(a, b, k, [k]) for a, b, k in own] + [(a, b, None, k) for a, b, k in _candidates(raw, own)]:
                    found = contexts(raw, a, b)
                    # a candidate without a context is no edge of the graph, but may be an instance found elsewhere
                    if found or seed is None:
                        slots[r].append({"start": char(a), "end": char(b), "seed": seed, "kinds": kinds,
                                         "instance": _code(raw[a:b].lower()), "patterns": found})
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, n), batch.column("print").slice(at, n),
                                              pa.array(base, pa.list_(span)), pa.array(slots, pa.list_(slot))],
                                             ["id", "print", "base", "slots"])


def _scored(edges: DataFrame) -> DataFrame:
    """(instance, kind, score) of instances that are no seeds, from rounds over the graph.

    Edges: (pattern, kind, instance, seed), where seed tells whether the
    instance is a base entity of that kind, of another kind (false) or none (null).

    An instance that scores ``CONFIDENCE`` or more is accepted and stays so: in
    the next round it is a seed worth its score, so that its other contexts may
    become patterns and find instances that share no context with any base
    entity.  The rounds end, after ``ROUNDS`` at least, with the first one that
    accepts nothing new.
    """
    scores, before, number = None, 0, 0
    score = F.coalesce("score", F.lit(0.0))
    accepted = F.col("seed").isNull() & (score >= CONFIDENCE)
    known = F.when(F.col("seed").isNull(), score).otherwise(F.col("seed").cast("double"))
    sure = F.when(accepted, score).otherwise(F.coalesce(F.col("seed"), F.lit(False)).cast("double"))
    while True:
        side = edges.withColumn("score", F.lit(None).cast("double")) if scores is None else edges.join(scores, ["instance", "kind"], "left")
        patterns = (side.groupBy("pattern", "kind")
                    .agg(F.sum(known).alias("weight"), F.count("*").alias("n"), F.sum(sure).alias("seeds"),
                         F.count_if(accepted | F.coalesce(F.col("seed"), F.lit(False))).alias("standing"))
                    .filter(F.col("standing") >= LEAST_SEEDS)
                    # one unseen miss is held against every pattern, unseen instances count for what they are worth so far
                    .select("pattern", "kind", (F.col("seeds") / (F.col("seeds") + 0.5 + F.col("n") - F.greatest("weight", "seeds"))).alias("trust")))
        found = (edges.filter("seed is null").join(patterns, ["pattern", "kind"])
                 .groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("trust") * 0.999)))).alias("score")))
        if scores is not None:
            found = (found.unionByName(scores.filter(F.col("score") >= CONFIDENCE)).groupBy("instance", "kind").agg(F.max("score").alias("score")))
        scores = settled(found, "scores")
        now = scores.filter(F.col("score") >= CONFIDENCE).count()
        number += 1
        if number >= ROUNDS and now == before:
            return scores
        before = now


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, print, base, spans): personal data of each whole text, in code points, end exclusive.

    ``base`` are the fixed patterns' spans, ``spans`` those and the ones that
    high-confidence contexts add; each is an array of (kind, start, end) by
    start, then kind.  ``print`` is a hash of the text, so that rows that repeat
    an id keep their own spans.  An added span overlaps no base span, looks like
    an identifier of its kind (a string with @; 7 to 15 digits; 12 to 19 digits;
    three dots or colons) and scores ``CONFIDENCE`` or more; it is added wherever
    the same string occurs, also where the words around it make no pattern.

    Null and empty texts have no spans; null ids and repeated rows are kept;
    equal scores go to the first kind listed; other columns are ignored,
    whatever their names; an empty table gives an empty result.
    """
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("print"), F.col(text_col).cast("string").alias("text"))
    found = settled(src.mapInArrow(_extract, _FOUND), "pii")
    slots = found.select("id", "print", F.explode("slots").alias("s")).select("id", "print", "s.*").distinct()
    # a string is a seed wherever it occurs once it is one somewhere: the graph has one node for it
    edges = settled(slots.select(F.explode("patterns").alias("pattern"), "instance", "seed", F.explode("kinds").alias("kind"))
                    .groupBy("pattern", "instance", "kind").agg(F.max(F.when(F.col("seed").isNotNull(), F.col("seed") == F.col("kind"))).alias("seed")), "edges")
    others = edges.filter("seed").select("pattern", "instance", F.col("kind").alias("own"))
    # a seed of one kind speaks against the pattern for the other kinds
    against = others.join(edges.filter("seed").select("pattern", "kind").distinct(), "pattern").filter("own <> kind").select(
        "pattern", "instance", "kind", F.lit(False).alias("seed"))
    scores = _scored(edges.unionByName(against))
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    best = (scores.filter(F.col("score") >= CONFIDENCE).groupBy("instance")
            .agg(F.max(F.struct("score", (-rank).alias("rank"), "kind")).alias("b")).select("instance", F.col("b.kind").alias("kind")))
    added = (slots.filter("seed is null").join(best, "instance").filter(F.array_contains("kinds", F.col("kind")))
             .groupBy("id", "print").agg(F.collect_set(F.struct("kind", "start", "end")).alias("added")))
    # added spans of one text: bounded by the text itself
    none = F.expr(f"cast(array() as array<{sp.SPAN}>)")
    left = found.select("id", "print", "base")
    return (left.join(added, left["id"].eqNullSafe(added["id"]) & (left["print"] == added["print"]), "left")
            .select(left["id"].alias(id_col), left["print"], "base",
                    sp.in_order(F.concat("base", F.coalesce("added", none)), KINDS).alias("spans")))


def masked(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span of ``found`` (see ``personal_data``) replaced by <KIND>; columns and rows stay as they are.

    Where spans overlap, the first hides its own stretch and what is left of
    the later one is hidden with it.
    """
    spans = (found.filter(F.size("spans") > 0).select(F.col(id_col).alias("id"), "print", "spans").dropDuplicates(["id", "print"]))
    spans = settled(spans, "masks")  # its size on disk tells Spark whether to broadcast it
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text_col].alias("text"),
                      docs[id_col].cast("long").alias("own_id"), F.xxhash64(docs[text_col]).alias("own_print"))
    both = row.join(spans, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_print") == F.col("print")), "left")
    text = F.col("text")

    def hide(so_far, span):
        part = F.concat(so_far["out"], F.substring(text, so_far["at"] + 1, span["start"] - so_far["at"]), F.lit("<"), F.upper(span["kind"]), F.lit(">"))
        return F.struct(F.when(span["start"] >= so_far["at"], part).otherwise(so_far["out"]).alias("out"),
                        F.greatest(so_far["at"], span["end"]).alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    changed = F.aggregate("spans", start, hide, lambda x: F.concat(x["out"], F.substring(text, x["at"] + 1, F.length(text))))
    return both.select(F.when(F.col("spans").isNull(), F.col("row")).otherwise(F.col("row").withField(text_col, changed)).alias("row")).select("row.*")
