"""The training-data operators against brute force, round trips and awkward inputs."""

import collections
import hashlib
import html
import math
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row, types as T

from pawnshop.llm import (bpe, catalog, components, decontaminate, elias_fano, hash_forest, near_dedup, ngram_lm, pii, quality,
                          secret_scan, text as tx, training_order, wrappers)

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("id", T.StringType()), ("print", T.LongType()), ("n", T.DoubleType()),
    ("words", T.StringType()), ("__id", T.StringType()), ("root", T.IntegerType()))])
LONG = " ".join(f"w{i * 7919 % 10007}" for i in range(30000))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, None, "y", None, 2) for i, t in rows], SCHEMA)


AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, LONG), (None, "null id"), (None, None), (7, "same row"), (7, "same row"),
           (8, "one"), (9, "one"), (10, "<|endoftext|> é中🎉"), (11, LONG + " end")]


@pytest.fixture(scope="module")
def awkward(spark):
    return frame(spark, AWKWARD).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.Tokenizer(catalog.vocabulary_path())


def rows(df):
    return [tuple(r) for r in df.collect()]


# --- text helpers -------------------------------------------------------------------------------------------------


def test_words_and_shingles_do_not_depend_on_the_batch():
    texts = ["A b  c", None, "", "a B c", " x", "a b c d e f", "Ünï a b c"]
    whole = [h.tolist() for h in _shingles(texts)]
    single = [_shingles([t])[0].tolist() for t in texts]
    assert whole == single and whole[0] == whole[3] and whole[1] == whole[2] == [] and len(whole[5]) == 2


def _shingles(texts):
    data, off = tx.string_buffers(pa.array(texts, pa.string()))
    sh, start = tx.shingles(*tx.words(data, off), 5)
    return [sh[a:b] for a, b in zip(start[:-1], start[1:])]


def test_probe_table_finds_all_and_nothing_else():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 40, 5000))
    table = tx.probe_table(keys)
    assert (tx.probe(table, keys) == np.arange(len(keys))).all()
    assert (tx.probe(table, keys + 1) == np.where(np.isin(keys + 1, keys), np.searchsorted(keys, keys + 1), -1)).all()


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 9), (5, 5), (20, 19), (19, 18), (18, 3)]
    got = dict(rows(components.components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {1: 1, 2: 1, 3: 1, 18: 1, 19: 1, 20: 1, 7: 7, 8: 7, 9: 7}


# --- 1 ------------------------------------------------------------------------------------------------------------


def _brute_classes(texts):
    sets = {}
    for d, t in texts:
        w = t.lower().split()
        sets[d] = frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else None
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {d: find(d) for d in ids}


def test_near_duplicates_equal_brute_force(spark, documents):
    rng = random.Random(3)
    extra = []
    for k, (d, t) in enumerate(documents[:12]):
        w = t.split()
        for j in range(3):
            v = list(w)
            for _ in range(max(1, len(w) // 120)):
                v[rng.randrange(len(v))] = f"new{rng.random()}"
            extra.append((10000 + 10 * k + j, " ".join(v)))
    texts = documents + extra
    got = dict(rows(near_dedup.near_duplicates(frame(spark, texts))))
    assert got == _brute_classes(texts)


def test_repeated_lines_do_not_hide_near_duplicates(spark):
    texts = []
    for k in range(6):
        body, line = " ".join(_words(200, 50 + k)), " ".join(_words(8, 80 + k))
        texts += [(10 * k, " ".join([body] + [line] * 10)), (10 * k + 1, " ".join([body] + [line] * 300)),
                  (10 * k + 2, " ".join([body] + [line] * 40 + _words(5, 90 + k))), (10 * k + 3, " ".join([line] * 300))]
    got = dict(rows(near_dedup.near_duplicates(frame(spark, texts))))
    assert got == _brute_classes(texts) and got[51] == got[52] == 50 and got[53] == 53


def test_sparse_links_in_hot_buckets_equal_brute_force(spark):
    texts = []
    for size, at, pairs in ((130, 0, range(10, 130, 15)), (24, 5000, range(2, 24, 7))):
        core = _words(400, 7 + size)
        own = [_words(50, at + 300 + k) for k in range(size)]
        # any two are 0.798 of each other and share most buckets; pairs that begin their own words alike are 0.806
        for k in pairs:
            own[k][:2] = own[k - 1][:2]
        texts += [(at + k, " ".join(core + w)) for k, w in enumerate(own)]
    got = dict(rows(near_dedup.near_duplicates(frame(spark, texts))))
    assert got == _brute_classes(texts) and got[100] == 99 and got[5009] == 5008 and len(set(got.values())) == 142


def test_near_duplicates_awkward(awkward, empty):
    got = rows(near_dedup.near_duplicates(awkward))
    assert len(got) == len(AWKWARD)
    classes = {d: c for d, c in got if d is not None}
    assert classes == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 7: 7, 8: 8, 9: 8, 10: 10, 11: 4}
    assert [c for d, c in got if d is None] == [None, None]
    assert rows(near_dedup.near_duplicates(empty)) == []


def test_order_matters_in_sketches_and_alignment():
    sh = tx.mix(np.arange(100, dtype=np.uint64))
    assert near_dedup.similarity(sh, sh) == 1 and near_dedup.similarity(sh, sh[::-1]) == 0
    assert near_dedup.similarity(sh, np.concatenate([sh[50:], sh[:50]])) == 0
    assert near_dedup.similarity(sh, sh[10:]) == 0.9 and near_dedup.similarity(sh, sh[:0]) == 0
    same = (near_dedup.order_minhash(sh) == near_dedup.order_minhash(sh[::-1])).mean()
    assert same < 0.5 and (near_dedup.order_minhash(sh) == near_dedup.order_minhash(sh[2:])).mean() > 0.5


# --- 2 ------------------------------------------------------------------------------------------------------------


def _words(n, seed):
    rng = random.Random(seed)
    return [f"t{rng.randrange(10 ** 6)}" for _ in range(n)]


def test_decontamination_finds_substituted_passages_and_nothing_else(spark):
    items = [(k, " ".join(_words(40, k))) for k in range(20)] + [(20, "only five words in here"), (21, None), (22, " "), (None, "x y z")]
    docs, want = [], set()
    for k in range(20):
        w = items[k][1].split()
        filler = _words(60, 1000 + k)
        changed = [f"c{i}" if i % 9 == 4 else x.upper() for i, x in enumerate(w)]
        docs.append((k, " ".join(filler[:30] + changed + filler[30:])))
        want.add((k, k))
        docs.append((100 + k, " ".join(filler + w[:10])))  # ten words of forty are no leak
        docs.append((200 + k, " ".join(filler + w[5:18])))  # thirteen are
        want.add((200 + k, k))
    docs += [(300, "see: only FIVE words, in here!"), (301, "only five other words in here"), (302, None), (303, "")]
    want.add((300, 20))
    test = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(frame(spark, docs), test)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want
    exact = {r.doc_id: r for r in got.collect()}
    assert (exact[203].doc_start, exact[203].doc_end, exact[203].equal_words, exact[203].item_words) == (60, 73, 13, 40)


def _brute_overlap(doc, item, shift):
    best = (0, 0, 0)
    for a in range(len(item)):
        for b in range(a + min(13, len(item)), len(item) + 1):
            if 0 <= a + shift and b + shift <= len(doc):
                same = [doc[k + shift] == item[k] for k in range(a, b)]
                if same[0] and same[-1] and sum(same) >= 0.8 * len(same) and sum(same) > best[2]:
                    best = (a, b, sum(same))
    return best


def test_passages_behind_a_changed_stretch_are_found(spark):
    item, filler = _words(80, 1), _words(30, 2)
    doc = filler + item[:10] + [f"c{k}" for k in range(20)] + item[30:] + filler
    test = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    docs = [(1, " ".join(doc)), (2, " ".join(filler + item[:10] + filler))]
    assert rows(decontaminate.contaminated(frame(spark, docs), test)) == [(1, 1, 60, 110, 50, 80)]
    rng = random.Random(4)
    for _ in range(400):
        item, share = np.array([rng.randrange(9) for _ in range(rng.randrange(4, 40))]), rng.random()
        doc = np.array([rng.randrange(9) for _ in range(3)] + [x if rng.random() < share else 9 for x in item.tolist()])
        for shift in (3, rng.randrange(-3, 6)):
            assert decontaminate.overlap(doc, item, shift) == _brute_overlap(doc.tolist(), item.tolist(), shift)


def test_masks_reach_substituted_overlaps():
    rng = np.random.default_rng(3)
    masks = [np.array([c == "1" for c in m]) for m in decontaminate.MASKS]

    def hit(n, changed):
        same = np.ones(n, bool)
        same[list(changed)] = False
        return any((same[o:o + len(m)] | ~m).all() for m in masks for o in range(n - len(m) + 1))

    # every pair of changed inner words of 13
    assert all(hit(13, (a, b)) for a in range(1, 12) for b in range(a + 1, 12))
    for n in range(13, 41):
        tries = [hit(n, 1 + rng.choice(n - 2, n // 5, replace=False)) for _ in range(300)]
        assert np.mean(tries) >= 0.98


def test_short_overlaps_with_changes_are_found_in_long_texts(spark):
    items = [(k, " ".join(_words(30, 7000 + k))) for k in range(40)]
    docs = []
    for k in range(40):
        w = items[k][1].split()[8:21]
        w[3], w[8] = "changed", "again"
        filler = _words(500, 9000 + k)
        docs.append((k, " ".join(filler[:300] + w + filler[300:])))
    got = decontaminate.contaminated(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.doc_start, r.doc_end, r.equal_words) for r in got) == [(k, k, 300, 313, 11) for k in range(40)]


def test_decontamination_awkward(spark, awkward, empty):
    test = spark.createDataFrame([(1, LONG), (2, None), (3, "same row")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(awkward, test).collect()}
    assert got == {(4, 1), (5, 1), (11, 1), (7, 3)}
    assert rows(decontaminate.contaminated(empty, test)) == [] == rows(decontaminate.contaminated(awkward, test.limit(0)))


# --- 3 and 5 --------------------------------------------------------------------------------------------------------


_PII = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]
_SECRET = [("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
           ("access", r"AKIA[A-Z0-9]+"), ("hex", r"[0-9a-f]+")]


def _brute_spans(text, patterns):
    out = []
    for place, (kind, pattern) in enumerate(patterns):
        for m in re.finditer(pattern, text):
            g, digits = m.group(), re.sub("[^0-9]", "", m.group())
            total = sum(int(c) if k % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for k, c in enumerate(reversed(digits)))
            ok = {"ip": lambda: all(int(x) <= 255 for x in g.split(".")), "card": lambda: 14 <= len(digits) <= 19 and total % 10 == 0,
                  "phone": lambda: 10 <= len(digits) <= 15, "assign": lambda: len(m.group(2)) >= 6, "access": lambda: len(g) >= 20,
                  "hex": lambda: len(g) >= 24}.get(kind, lambda: True)()
            if ok:
                out.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def _fuzz(n):
    rng = random.Random(5)
    pool = ["a", "é", "🎉", "@", ".", "-", " ", "+", "1", "12", "255", "256", "4111111111111111", "(555) ", "x@y.zz", "a.b@c-d.e", "token", "KEY",
            "api_key", "=", ": ", '"', "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef", "deadbeef", "pass", "word", "password", "\n", "1.2.3.4", "+1 (555) 123-4567",
            "ſecret", "49927398716", "00", "..", "@@"]
    return ["".join(rng.choice(pool) for _ in range(rng.randrange(25))) for _ in range(n)]


def test_base_spans_equal_the_patterns():
    for t in _fuzz(20000):
        raw = t.encode()
        char = lambda b: len(raw[:b].decode())
        for find, patterns in ((pii.base_spans, _PII), (secret_scan.base_spans, _SECRET)):
            assert [f"{k}:{char(a)}:{char(b)}" for a, b, k in find(raw)] == _brute_spans(t, patterns), (t, find)


def test_base_spans_of_very_long_runs_are_quick():
    for t in ("1" * 300000, "a" * 300000 + "@", "1." * 100000, "f" * 300000, "token " * 50000, "a@" * 100000, "AKIA" * 50000, "+1 " * 80000):
        pii.base_spans(t.encode())
        secret_scan.base_spans(t.encode())


def test_whole_texts_through_spark(spark, documents, awkward, empty):
    extra = [(90000 + k, t) for k, t in enumerate(_fuzz(300))]
    for found, patterns in ((pii.personal_data, _PII), (secret_scan.secrets, _SECRET)):
        kinds = [k for k, _ in patterns]
        got = {r.doc_id: r for r in found(frame(spark, documents + extra)).collect()}
        for d, t in documents + extra:
            base = [f"{s.kind}:{s.start}:{s.end}" for s in got[d].base]
            assert base == _brute_spans(t, patterns)
            assert set(base) <= {f"{s.kind}:{s.start}:{s.end}" for s in got[d].spans}
            assert [(s.start) for s in got[d].spans] == sorted(s.start for s in got[d].spans)
        assert kinds
        assert len(rows(found(awkward))) == len(AWKWARD) and rows(found(empty)) == []


def test_contexts_find_unseen_identifiers(spark):
    seeds = [(k, f"filler{k} text. Please call me at +1 (555) 010-{1000 + k} today about order {k}") for k in range(30)]
    new = [(100, "Please call me at 555 0199 4421 today"), (101, "total of 555 0199 4422 items"), (102, "nothing here")]
    got = {r.doc_id: r for r in pii.personal_data(frame(spark, seeds + new)).collect()}
    assert [(s.kind, s.start, s.end) for s in got[100].spans] == [("phone", 18, 31)] and got[100].base == []
    assert got[101].spans == [] and got[102].spans == [] and all(len(got[k].spans) == 1 for k in range(30))
    masked = {r.doc_id: r for r in pii.masked(frame(spark, seeds + new + [(5, "again")]), pii.personal_data(frame(spark, seeds + new))).collect() if r.text != "again"}
    assert masked[100].text == "Please call me at <PHONE> today" and masked[101].text == new[1][1] and "<PHONE>" in masked[3].text
    assert masked[3]["id"] == "x" and masked[3].root == 2


def test_accepted_identifiers_are_added_without_a_context(spark):
    seeds = [(k, f"filler{k} text. Please call me at +1 (555) 010-{1000 + k} today about order {k}") for k in range(30)]
    new = [(100, "Please call me at 555 0199 4421 today"), (101, "555 0199 4421 once more"), (102, "| 555 0199 4421 |"),
           (103, "* 555 0199 4422 *"), (104, "555 0199 4421")]
    docs = frame(spark, seeds + new)
    found = pii.personal_data(docs)
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in found.collect()}
    assert [got[k] for k in range(100, 105)] == [[("phone", 18, 31)], [("phone", 0, 13)], [("phone", 2, 15)], [], [("phone", 0, 13)]]
    masked = {r.doc_id: r.text for r in pii.masked(docs, found).collect()}
    assert masked[101] == "<PHONE> once more" and masked[102] == "| <PHONE> |" and masked[103] == new[3][1]


def test_discovered_identifiers_induce_patterns(spark):
    seeds = [(k, f"filler{k} text. Please call me at +1 (555) 010-{1000 + k} today about order {k}") for k in range(40)]
    # numbers that stand beside base entities, and in a context of their own where no base entity stands
    both = [(100 + k, f"Please call me at 555 0199 {4400 + k} today") for k in range(12)]
    both += [(200 + k, f"the pager rings under 555 0199 {4400 + k} all night") for k in range(12)]
    far = [(300, "my pager rings under 555 0198 7001 all night"), (301, "it weighs about 555 0198 7002 in grams")]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.personal_data(frame(spark, seeds + both + far)).collect()}
    assert got[300] == [("phone", 21, 34)] and got[301] == [] and all(got[100 + k] for k in range(12)) and all(got[200 + k] for k in range(12))
    without = {r.doc_id: r.spans for r in pii.personal_data(frame(spark, seeds + both[:12] + far)).collect()}
    assert without[300] == []


def test_masking_keeps_awkward_rows(awkward):
    got = pii.masked(awkward, pii.personal_data(awkward))
    assert got.columns == awkward.columns
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=key) == sorted(AWKWARD, key=key)


def test_random_tokens_are_told_from_words(spark):
    rng = random.Random(9)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    syllables = ["an", "er", "tion", "ing", "the", "re", "st", "ly", "ment", "con"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(3, 12)))
    docs = [(k, " ".join(word() for _ in range(60))) for k in range(300)]
    keys = {1000 + k: "".join(rng.choice(alphabet) for _ in range(40)) for k in range(60)}
    docs += [(d, f"see {k} here") for d, k in keys.items()] + [(2000 + k, f"see {word()}{word()}1 and zzzzzzzz1111111122222222 here") for k in range(60)]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secret_scan.secrets(frame(spark, docs)).collect()}
    found = sum(got[d] == [("random", 4, 44)] for d in keys)
    assert found >= 55 and sum(bool(got[2000 + k]) for k in range(60)) <= 6 and not any(got[k] for k in range(300))


def test_a_few_documents_report_as_their_level_says(spark):
    rng = random.Random(4)
    keys = ["".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(64)) for _ in range(5)]
    docs = [(k, f"see {key} here") for k, key in enumerate(keys)] + [(9, "plainwords and user2024name")]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secret_scan.secrets(frame(spark, docs)).collect()}
    assert sum(got[k] == [("random", 4, 68)] for k in range(5)) >= 4 and got[9] == []


def test_short_random_tokens_need_a_corpus_whose_words_fail(spark):
    rng = random.Random(6)
    word = lambda: rng.choice("abc") * 4 + rng.choice("xyz") * 4
    docs = [(k, " ".join(word() for _ in range(50))) for k in range(200)]
    keys = {1000 + k: "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZ0123456789") for _ in range(9)) + "A7" for k in range(100)}
    docs += [(d, f"see {k} here") for d, k in keys.items()]
    got = {r.doc_id: r.spans for r in secret_scan.secrets(frame(spark, docs)).collect()}
    assert sum(bool(got[d]) for d in keys) >= 60 and not any(got[k] for k in range(200))


def test_expected_rates_fall_with_level_and_length():
    rates = secret_scan.expected_rates()
    assert all(r[0] == 1.0 and sorted(r, reverse=True) == r for r in rates.values())
    assert all(a[-1] >= b[-1] for a, b in zip(list(rates.values()), list(rates.values())[1:]))


def test_randomness_of_random_tokens_is_uniform():
    rng = np.random.default_rng(2)
    data = rng.choice(np.frombuffer(b"0123456789abcdef", np.uint8), 32 * 4000)
    p = secret_scan.randomness(data, np.arange(0, len(data), 32), np.arange(32, len(data) + 1, 32))
    assert 0.4 < p.mean() < 0.6 and (p < 0.05).mean() < 0.12


# --- 4 ------------------------------------------------------------------------------------------------------------


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script></head><body class="ad"><header>Site</header>
<nav><ul><li>Home</ul></nav><div class="cookie-notice">We use cookies</div><aside>Side</aside>{0}<div id="comments"><p>First!</p></div>
<form><p>Name</p></form><footer>&copy; me</footer></body></html>"""


def test_main_text_of_awkward_markup():
    article = """<article class="post"><h1>A &amp; B</h1><p>One <b>two</b>
 three<br>four<p>five &lt;6&gt; &am <!-- no --><ul><li>x<li>y</ul><div class="ad">buy</div><table><tr><td>1<td>2</table><style>p{}</style><p title="a>b">last</article>"""
    page = PAGE.format(article)
    where = wrappers.container(wrappers.page_wrapper(page))
    assert where.endswith("article.post")
    assert wrappers.main_text(page, where) == "A & B\nOne two three four\nfive <6> &am\nx\ny\n1\n2\nlast"
    assert wrappers.main_text("", "") == "" and wrappers.main_text("plain  text", "") == "plain text" and wrappers.main_text("a < b", "x") == "a < b"
    for broken in ("<", "<p", "<!--", "<script>", "</", "<p></div></p>" * 3, "<b" * 1000, "<p a='" * 1000):
        wrappers.main_text(broken, "")


def test_class_words_on_frames_do_not_empty_a_page():
    def read(page):
        return wrappers.main_text(page, wrappers.container(wrappers.page_wrapper(page)))

    body = "<h1>Title</h1><p>One two three.</p><p>Four five six.</p>"
    text = "Title\nOne two three.\nFour five six."
    aside = "<div class='sidebar'><p>Links</p></div>"
    assert read(f"<div class='layout no-sidebar'>{body}</div>") == text
    assert read(f"<div class='page has-header'><div class=header>Site</div><article>{body}</article>{aside}</div>") == text
    assert read(f"<div class='header-large'><nav>Home</nav>{body}{aside}</div>") == text
    assert read(f"<div class='social-page'><main>{body}<div id=comments><article><p>First!</p></article></div></main></div>") == text
    assert read(f"<div class='header'><h1>Site</h1></div><div>{body}</div>{'<div class=comments><p>' + 'long reply ' * 40 + '</p></div>'}") == text
    assert read("<div class='cookie-notice'><p>We use cookies.</p><p>Fine?</p></div>") == ""


def test_a_class_with_a_number_per_page_is_one_place(spark):
    pages = [(k, f"http://h.example/{k}", f"<div class='post-{k}'><h2>T{k}</h2><p>{'text ' * 20}{k}</p></div><div class=footer>f</div>") for k in range(300)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    rule = wrappers.infer(df).first()
    assert rule.container == "div.post-0" and rule.pages == 300 and len(rule.expression) < 200
    assert {r.page_id: r.text for r in wrappers.extract(df).collect()} == {k: f"T{k}\n{'text ' * 20}{k}" for k in range(300)}


def test_wrapper_is_a_union_free_expression_of_all_pages():
    pages = [PAGE.format(f"<main>{'<p>t%d</p>' % k * (k + 1)}{'<h2>extra</h2>' if k % 2 else ''}</main>") for k in range(4)]
    whole = wrappers.page_wrapper(pages[0])
    for p in pages[1:]:
        whole = wrappers.align(whole, wrappers.page_wrapper(p))
    text = wrappers.expression(whole, len(pages))
    assert "(<main/p>#text)+" in text and "(<main/h2>" in text and ")?" in text and "|" not in text
    assert wrappers.container(whole) == "main"


def test_pages_without_article_elements_use_the_host(spark):
    pages = [(k, f"http://h.example/{k}", f"<div class=menu><p>Menu Menu Menu</p></div><div id=body><h2>T{k}</h2><p>{'text ' * 30}{k}</p></div><div class=footer>f</div>") for k in range(30)]
    pages += [(100, None, None), (101, "http://h.example/x", ""), (102, "no url", "<p>alone</p>"), (None, "http://h.example/y", "<p>odd</p>"), (100, None, None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as text", "3 as container")
    got = wrappers.extract(df)
    out = {r.page_id: r.text for r in got.collect()}
    assert out[3] == f"T3\n{'text ' * 30}3" and out[100] == "" == out[101] and out[102] == "alone" and out[None] == "odd" and got.count() == len(pages)
    assert rows(wrappers.extract(df.limit(0))) == []


def test_pages_equal_brute_force(spark):
    got = {r.page_id: r for r in catalog.op4_union_free_wrappers(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)(</article>|<footer>|$)", r.html, re.S).group(1)
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n".join(x for x in parts if x)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


# --- 6 ------------------------------------------------------------------------------------------------------------


def test_elias_fano():
    rng = np.random.default_rng(1)
    for n, u in ((0, 5), (1, 1), (1, 2 ** 64), (1000, 1000), (5000, 10 ** 6), (20000, 2 ** 64)):
        v = np.sort(rng.integers(0, u, n, dtype=np.uint64)) if n else np.zeros(0, np.uint64)
        code = elias_fano.EliasFano(elias_fano.encode(v, u))
        assert (code.access(np.arange(n)) == v).all()
        q = np.concatenate([v, rng.integers(0, u, 500, dtype=np.uint64)])
        at = np.searchsorted(v, q)
        want = np.where((at < n) & (v[np.minimum(at, n - 1)] == q), at, -1) if n else np.full(len(q), -1)
        assert (code.find(q) == want).all()


def test_language_model_equals_brute_force(spark, documents):
    docs = frame(spark, documents)
    train = [(d, t) for d, t in documents if zlib.crc32(str(d).encode()) % 5 != 1]
    model = ngram_lm.fit(frame(spark, train))
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    split = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", t.translate(lower)), None]
    one, two = collections.Counter(), collections.Counter()
    for _, t in train:
        w = split(t)
        one.update(w)
        two.update(zip([None, *w[:-1]], w))
    n, v, m = sum(one.values()), len(one), ngram_lm.STRENGTH
    assert (model.tokens, model.words) == (n, v)
    p1 = lambda w: (one[w] + 0.5) / (n + 0.5 * (v + 1))
    for r in ngram_lm.scored(docs, model).collect():
        w = split(dict(documents)[r.doc_id])
        assert (r.n_tokens, r.n_known) == (len(w), sum(one[x] > 0 for x in w))
        assert math.isclose(r.base_score, sum(math.log10(p1(x)) for x in w), rel_tol=1e-9)
        full = sum(math.log10((two[h, x] + m * p1(x)) / (one[h] + m)) for h, x in zip([None, *w[:-1]], w))
        assert abs(r.score - full) <= ngram_lm.STEP / 2 * len(w) + 1e-6


def test_language_model_awkward(spark, awkward, empty):
    got = ngram_lm.scored(awkward, ngram_lm.fit(awkward)).collect()
    assert len(got) == len(AWKWARD) and {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    nothing = ngram_lm.fit(empty)
    assert all(r.n_known == 0 and r.score == r.base_score for r in ngram_lm.scored(awkward, nothing).collect())
    assert rows(ngram_lm.scored(empty, nothing)) == []


def test_hot_contexts_are_cut_by_successor():
    cuts = [(10, 50, 10), (20, 1050, 1000), (30, 1100, 20)]
    bounds = ngram_lm._bounds((), cuts, 100)
    own = [b for b in bounds.tolist() if b >> 32 == 20]
    assert len(own) > 1 and bounds[0] == 0 and 21 << 32 in bounds.tolist()


# --- 7 ------------------------------------------------------------------------------------------------------------


def test_quality_separates_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    score = {r.doc_id: r.score for r in quality.scored(docs, catalog.quality_model(docs, labels)).collect()}
    held = [(score[r.doc_id], r.quality) for r in labels.collect() if r.doc_id in score and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97 and np.mean([g >= 0.3 for g in good]) > 0.97


def test_quality_awkward(awkward, empty):
    model = quality.fit_on(awkward, awkward.filter("doc_id = 4"))
    got = quality.scored(awkward, model).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 for r in got) and len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    none = quality.fit_on(empty, empty)
    assert all(r.score == 0.5 for r in quality.scored(awkward, none).collect()) and rows(quality.scored(empty, none)) == []


def test_prior_is_estimated_from_the_two_samples():
    rng = np.random.default_rng(4)
    good, mixed = rng.normal(2, 1, 4000), np.concatenate([rng.normal(2, 1, 2800), rng.normal(-2, 1, 1200)])
    assert abs(quality.estimated_prior(good, mixed) - 0.7) < 0.06


# --- 8 ------------------------------------------------------------------------------------------------------------


def test_nearest_neighbours(spark):
    got = collections.defaultdict(list)
    for r in sorted(catalog.op8_hash_prefix_forest(spark, SF).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in table]), np.array([r.embedding for r in table], float)
    hit = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(1))
        near = [(s, i) for s, i in sorted(zip(d.tolist(), ids.tolist())) if i != q][:10]
        hit += len({i for _, i in near} & {i for i, _ in got[q]})
        assert all(s == d[ids == i][0] for i, s in got[q]) and len(got[q]) == 10
    assert hit >= 0.9 * 10 * len(got)


def test_nearest_neighbours_awkward(spark):
    vectors = [(k, [1.0, 2.0]) for k in range(300)] + [(300, [1.0, 2.5]), (301, None), (302, [0.0, 0.0]), (303, [float("nan"), 1.0]), (304, [1.0, None]),
                                                       (305, [1.0]), (306, []), (None, [1.0, 2.0]), (300, [1.0, 2.5]), (307, [float("inf"), 1.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "2 as block", "3 as vector")
    got = hash_forest.nearest(df, df.filter("vec_id % 100 = 0"))
    own = lambda q: [(r.vec_id, r.score) for r in sorted(got.filter(f"query_id = {q}").collect(), key=lambda r: r["rank"])]
    assert own(0) == [(k, 0.0) for k in range(1, 11)] and own(100) == [(k, 0.0) for k in range(10)] and own(300) == [(k, 0.5) for k in range(10)]
    assert rows(hash_forest.nearest(df.limit(0), df)) == [] and rows(hash_forest.nearest(df, df.limit(0))) == []
    few = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "vec_id long, embedding array<double>")
    assert sorted(rows(hash_forest.nearest(few, few))) == [(1, 1, 2, 1.0), (2, 1, 1, 1.0)]


# --- 9 ------------------------------------------------------------------------------------------------------------


def _library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(catalog.vocabulary_path())


def test_bpe_equals_the_library(tokenizer, documents):
    rng = random.Random(1)
    pool = ["a", "Z", "é", "ß", "1", "²", "Ⅷ", "'", "'s", "'re", "'ll", "'T", " ", "  ", "\n", "\t", " ", "　", "\x85", "\x1c", ".", "!!", "中", "🎉",
            "<|endoftext|>", "the", "<|endof", "́", "x" * 70, "'ve'd", "''s", "՘", "꟎"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(30))) for _ in range(20000)] + [t for _, t in documents] + ["", "ab" * 5000, LONG]
    vocabulary = bpe.Vocabulary(tokenizer.vocabulary)
    words = sorted({w.encode() for _, t in documents for w in (" " + x for x in t.split())})
    lexicon = bpe.Automaton(bpe.Automaton.build(words, [vocabulary.encode_word(w) for w in words]))
    got, back = [], []
    for _, data, off in tx.runs(pa.array(texts, pa.string())):
        ids, first = bpe.encode_run(data, off, vocabulary, lexicon)
        got += [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])]
        back += bpe.decoded(vocabulary, ids, first)
    assert got == [e.ids for e in _library().encode_batch(texts, add_special_tokens=False)] and back == texts


def test_automaton_is_minimal_and_ranks_words():
    words = sorted({a + b for a in (b"un", b"re", b"", b"pre") for b in (b"do", b"doing", b"made", b"make")})
    fsa = bpe.Automaton(bpe.Automaton.build(words, [[k] for k in range(len(words))]))
    joined = b"".join(words) + b"xdomak"
    cut = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    data = np.frombuffer(joined, np.uint8)
    assert fsa.rank(data, cut[:-1], cut[1:]).tolist() == list(range(len(words)))
    assert fsa.rank(data, np.array([cut[-1], cut[-1] + 3, 0]), np.array([cut[-1] + 1, cut[-1] + 6, 0])).tolist() == [-1, -1, -1]
    # the suffixes of all four prefixes share their states
    single = bpe.Automaton(bpe.Automaton.build([w for w in words if w.startswith((b"d", b"m"))], [[0]] * 4))
    assert len(fsa.final) <= len(single.final) + 6


def test_bpe_through_spark(spark, tokenizer, documents, awkward, empty):
    built = tokenizer.compile(frame(spark, documents), words=500)
    lib = _library()
    for source, df in ((documents, frame(spark, documents)), (AWKWARD, awkward)):
        encoded = built.encode(df)
        want = collections.Counter()
        for d, t in source:
            ids = lib.encode(t or "", add_special_tokens=False).ids
            want[d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                 hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
        assert collections.Counter(rows(built.digests(df))) == want
        assert collections.Counter(rows(built.decode(encoded))) == collections.Counter((d, t or "") for d, t in source)
    assert rows(built.encode(empty)) == [] and rows(bpe.Tokenizer(catalog.vocabulary_path()).compile(empty).encode(empty)) == []


# --- 10 -----------------------------------------------------------------------------------------------------------


def test_slots_are_a_keyed_permutation():
    for n in (1, 2, 3, 17, 1000, 4097):
        a, b = (training_order.slots(np.arange(n), n, key) for key in (1, 2))
        assert sorted(a.tolist()) == list(range(n)) == sorted(b.tolist())
        assert n < 100 or (a != b).mean() > 0.9 and abs(np.corrcoef(a, np.arange(n))[0, 1]) < 0.15


def test_shards_round_trip_and_resume(spark, tokenizer, documents, tmp_path):
    end, length, per = catalog.END_TOKEN, 64, 16
    packed = training_order.sequences(frame(spark, documents + AWKWARD).repartition(3), tokenizer, end, length=length)
    shard_rows = training_order.shards(packed, key=5, per_shard=per).cache()
    uri = f"file://{tmp_path}/shards"
    first = {r.shard: r for r in training_order.write_shards(shard_rows, uri).collect()}
    times = {r.path: os.stat(r.path).st_mtime_ns for r in first.values()}
    assert {r.shard: r for r in training_order.write_shards(shard_rows, uri).collect()} == first
    assert all(os.stat(p).st_mtime_ns == t for p, t in times.items())
    total = sum(r.n_sequences for r in first.values())
    got = list(training_order.read_slots(uri, 0, total, length, per))
    assert [x.tolist() for x in training_order.read_slots(uri, 20, 50, length, per)] == [x.tolist() for x in got[20:50]]
    index = training_order.index(shard_rows).collect()
    assert sorted(r.slot for r in index) == list(range(total))
    assert all(hashlib.sha256(got[r.slot].tobytes()).hexdigest() == r.sha256 and r.shard == r.slot // per and r.byte_offset == r.slot % per * length * 2 for r in index)
    lib = _library()
    want = collections.Counter()
    for _, t in documents + AWKWARD:
        want.update([*lib.encode(t or "", add_special_tokens=False).ids, end])
    seen = collections.Counter()
    for r in index:
        seen.update(got[r.slot][:r.n_tokens].tolist())
    assert seen == want
    ids = dict(documents)
    for r in index[:200]:
        if r.first_doc in ids and r.first_doc > 20:
            own = [*lib.encode(ids[r.first_doc], add_special_tokens=False).ids, end][r.first_token:][:length]
            assert got[r.slot][:len(own)].tolist() == own


def test_another_key_replaces_the_files_that_are_there(spark, tokenizer, documents, tmp_path):
    packed = training_order.sequences(frame(spark, documents).repartition(2), tokenizer, catalog.END_TOKEN, length=64)
    uri = f"{tmp_path}/shards"
    for key in (1, 2):
        shard_rows = training_order.shards(packed, key=key, per_shard=16).cache()
        manifest = training_order.write_shards(shard_rows, uri).cache()
        want = rows(training_order.index(shard_rows))
        assert rows(training_order.index(training_order.read_shards(manifest, uri))) == want and want
        for r in manifest.collect():
            with open(r.path, "rb") as f:
                assert hashlib.sha256(f.read()).hexdigest() == r.sha256
    with open(manifest.first().path, "r+b") as f:
        f.write(b"xx")
    with pytest.raises(Exception, match="is not the one of the manifest"):
        training_order.read_shards(manifest, uri).collect()


def test_shards_of_nothing(empty, tokenizer):
    assert rows(training_order.index(training_order.shards(training_order.sequences(empty, tokenizer, catalog.END_TOKEN)))) == []


# --- pipeline -----------------------------------------------------------------------------------------------------


def test_pipeline_equals_its_stages_by_brute_force(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 120")
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "encoding"]
    after = {}
    now = docs
    for name, stage in cp.STAGES:
        now = stage(spark, now, SF).cache()
        assert name == "encoding" or now.columns == docs.columns
        after[name] = {r.doc_id: r for r in now.collect()}
    score = {r.doc_id: r.score for r in quality.scored(docs, catalog.quality_model(docs, spark.read.parquet(f"{SF}/labels.parquet"))).collect()}
    good = {r.doc_id: r.text for r in docs.collect() if score[r.doc_id] >= 0.3}
    assert {d: r.text for d, r in after["quality"].items()} == good
    classes = _brute_classes(list(good.items()))
    single = {d: t for d, t in good.items() if classes[d] == d}
    assert {d: r.text for d, r in after["near_duplicates"].items()} == single
    bare = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.lower())
    shown = [" ".join(bare(i)) for i in items]
    leaked = {d for d, t in single.items() if any(f" {i} " in f" {' '.join(bare(t))} " for i in shown)}
    assert leaked and leaked <= set(single) - set(after["decontamination"])
    for d, r in after["personal_data"].items():
        assert not _brute_spans(r.text, _PII[:1]) and (r.text == single[d] or _brute_spans(single[d], _PII))
    lib = _library()
    for d, r in after["encoding"].items():
        ids = lib.encode(after["personal_data"][d].text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_pipeline_stages_keep_awkward_rows(spark):
    import corpus_pipeline as cp

    df = spark.createDataFrame([Row(doc_id=i, text=t, lang="en", source=None, n_chars=0) for i, t in AWKWARD],
                               "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in cp.STAGES[1:]:
        got = stage(spark, df, SF)
        ids = sorted((str(r.doc_id) for r in got.collect()))
        want = [d for d, _ in AWKWARD if not (name == "near_duplicates" and d in (5, 9, 11))]
        want = sorted({str(d) for d in want if d is not None}) + ["None"] * 2 if name == "near_duplicates" else sorted(map(str, want))
        assert sorted(ids) == sorted(want), name
        assert stage(spark, df.limit(0), SF).count() == 0


def test_pipeline_keeps_every_text_of_a_repeated_id(spark):
    import corpus_pipeline as cp

    one, two = ("alpha beta gamma delta epsilon zeta eta theta iota kappa", "red orange yellow green blue indigo violet black white grey")
    docs = spark.createDataFrame([(1, one), (1, two), (1, one), (2, two), (3, None), (3, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in cp.keep_one_of_each(spark, docs, "unused").collect()), key=str)
    assert got == [(1, one), (1, two), (3, None)]
