"""Conversation repair against a search over all states with whole audits."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import types as T

from pawnshop.llm import catalog, conversation_repair as repair

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                       T.StructField("text", T.StringType()), T.StructField("ord", T.StringType()), T.StructField("block", T.StringType())])
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def brute_report(conv, rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3][:64], hashlib.sha256(r[3].encode()).digest()))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    follow = {0: "u", 1: "u", 2: "a", 3: "u"}
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    names = {"u": "user", "a": "assistant"}
    seen, faults = set(), {"blank": 0, "duplicate": 0, "truncated": 0}

    def insert(best):
        for _ in range(3):
            for s, (cost, audit, lines) in list(best.items()):
                t, new = step[s, follow[s]], (cost + 2, audit + "I", lines + [names[follow[s]] + ":"])
                if t not in best or new[:2] < best[t][:2]:
                    best[t] = new
        return best

    best = {0: (0, "", [])}
    for _, _, role, text in rows:
        fault = "blank" if not text.strip(WHITE) else "duplicate" if (role, text) in seen else "truncated" if text.strip(WHITE)[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        after = {}

        def offer(s, new):
            if s not in after or new[:2] < after[s][:2]:
                after[s] = new

        for s, (cost, audit, lines) in insert(best).items():
            offer(s, (cost + 3, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if (s, role[:1]) in step:
                    offer(step[s, role[:1]], (cost + extra, audit + "K", lines + [f"{role}:{text}"]))
                offer(step[s, follow[s]], (cost + 2 + extra, audit + "R", lines + [f"{names[follow[s]]}:{text}"]))
        best = after
    cost, audit, lines = min((v for s, v in insert(best).items() if s in (0, 3)), key=lambda v: v[:2])
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (conv, gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute(rows, convs=()):
    groups = {c: [] for c in convs}
    for conv, turn, *said in rows:
        groups.setdefault(conv, []).append((conv, turn, *[" " if x is None else x for x in said]))
    return sorted((brute_report(c, g) for c, g in groups.items()), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def random_rows(seed, conversations, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for t in range(rng.randrange(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "no", "Why?\n", " \t\n", "", None, f"new {rng.random()}!", f"open {rng.random()}", "é🎉."])
            rows.append((c if c else None, rng.choice([t, t, t, t + 3, None, 0]), role, text))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    return rows


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(catalog.op13_path_ranked_repair(spark, SF)) == brute(brute_damage(rows), {r[0] for r in rows})


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_blocks_of_any_size_give_the_same(spark, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rows = random_rows(block, 30, 25)
    df = frame(spark, rows)
    assert found(repair.report(repair.damaged(df), df)) == brute(brute_damage(rows), {r[0] for r in rows})


def test_long_conversation_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK", 16)
    rng = random.Random(7)
    rows = [(5, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["ok", f"t {t}.", f"t {t}"])) for t in range(600)]
    rows += [(4, 0, "user", "a."), (6, 0, "assistant", "b.")]
    assert found(repair.report(frame(spark, rows))) == brute(rows)


def test_repetitions_are_not_spread_as_rows(spark):
    rows = [(1, 0, "user", "same.")] * 3000 + [(1, 1, "assistant", "fine.")] + [(1, 2, "user", "same.")] * 2
    table = repair.edits(frame(spark, rows).drop("ord", "block"))
    assert table.count() == 3 and found(repair.report(frame(spark, rows))) == brute(rows)


def test_awkward_conversations(spark):
    rows = [(1, None, None, None), (2, 0, "user", "x" * 300000), (2, 1, "assistant", "y." * 200000), (3, 0, "", ""), (None, None, "user", "hi."),
            (None, 5, "assistant", "yo!"), (4, 2, "system", "only system."), (5, 1, "assistant", "starts late."), (6, -3, "user", "a."), (6, 9, "user", "b.")]
    assert found(repair.report(frame(spark, rows))) == brute(rows)
    assert found(repair.report(frame(spark, []), frame(spark, rows))) == brute([], {r[0] for r in rows})
    assert repair.report(frame(spark, [])).count() == 0


def every_audit(rows):
    """(cost, audit) of all edits of a short conversation with at most two insertions in a row."""
    out = []

    def go(k, audit, cost, roles):
        if re.fullmatch("(s?(ua)+)?", roles) and k == len(rows):
            out.append((cost, audit))
        if not audit.endswith("II"):
            for r in "ua":
                go(k, audit + "I", cost + 2, roles + r)
        if k < len(rows):
            role, extra = rows[k][2][:1], not rows[k][3].endswith(".")
            go(k + 1, audit + "D", cost + 3, roles)
            go(k + 1, audit + "K", cost + extra, roles + role)
            for r in "ua":
                go(k + 1, audit + "R", cost + 2 + extra, roles + r)

    go(0, "", 0, "")
    return out


def test_audit_is_the_least_of_all_cheapest(spark):
    rng = random.Random(11)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), rng.choice([f"t {c} {t}.", f"t {c} {t}"])) for c in range(40) for t in range(rng.randrange(4))]
    got = {r.conv_id: (r.cost, r.audit) for r in repair.report(frame(spark, rows)).collect()}
    assert got == {c: min(every_audit([r for r in rows if r[0] == c])) for c in got}
