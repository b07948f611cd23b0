"""Pieces, spans, normalisation and decoding against the sentencepiece library."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import types as T

from pawnshop.llm import catalog, sentence_pieces as sp, text as tx

SF = "/root/testdata/sf0.001"
LETTERS = "ab  \n\t▁é中🎉　 .,-0123<0x0A>\u0000<s>⁇ｆﬁ"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=catalog.piece_model_path())


@pytest.fixture(scope="module")
def model():
    return sp.Encoder(catalog.piece_model_path()).model


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def random_texts(letters, count, longest, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(longest))) for _ in range(count)]


def encoded(model, texts):
    units = sp.Units(model)
    for at, data, off in tx.runs(pa.array(texts, pa.string())):
        ids, first, starts, ends = sp.encode_run(data, off, model, units)
        decoded = sp.decoded(model, ids, first)
        for k, (a, b) in enumerate(zip(first[:-1], first[1:])):
            yield texts[at + k] or "", ids[a:b].tolist(), list(zip(starts[a:b].tolist(), ends[a:b].tolist())), decoded[k]


def test_ids_spans_and_decoded_texts_equal_the_library(model, library, documents):
    texts = [t for _, t in documents] + random_texts(LETTERS, 1500, 60) + random_texts("abcdefgh ij", 200, 300)
    texts += [None, "", " ", "  ", "a", " a ", "\n", "x" * 3000, "ab" * 2000, "▁", "▁▁a", "中" * 500, " " * 100, "the" * 700 + " " + "1" * 90]
    for text, ids, spans, back in encoded(model, texts):
        want = library.encode(text, return_type="proto").pieces
        assert ids == [p.id for p in want], text[:80]
        assert spans == [(p.begin, p.end) for p in want], text[:80]
        assert back == library.decode(ids), text[:80]


def test_a_forgetful_worker_gives_the_same(model, library, monkeypatch):
    monkeypatch.setattr(sp, "CACHE_CHARACTERS", 10)
    monkeypatch.setattr(tx, "CHUNK_BYTES", 200)
    texts = random_texts("abc def", 300, 40, seed=2)
    assert [ids for _, ids, _, _ in encoded(model, texts)] == library.encode(texts)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
@pytest.mark.parametrize("flags", range(8))
def test_normalisation_and_alignment_equal_the_library(rule, flags):
    kwargs = {"add_dummy_prefix": bool(flags & 1), "remove_extra_whitespaces": bool(flags & 2), "escape_whitespaces": bool(flags & 4)}
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, **kwargs)
    own = sp.Normalizer(library.serialized_normalizer_spec())
    texts = random_texts("ab  \n\t é中🎉　 ¨´.,㍿ﬁ①Ａ̀ 가ᄀ​゙ガ½", 800, 30, seed=flags) + ["", " ", "  a"]
    for at, data, off in tx.runs(pa.array(texts)):
        text, cut, place, stop = own(data, off)
        for k, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
            source, got = texts[at + k], text[a:b].tobytes().decode()
            want, offsets = library.normalize(source, with_offsets=True)
            assert got == want
            # the library gives one offset, in characters, for each normalised character
            bytes_before = np.concatenate([[0], np.cumsum([len(c.encode()) for c in source])]).astype(int)
            firsts = np.concatenate([[0], np.cumsum([len(c.encode()) for c in got])]).astype(int)
            places = np.append(place[a:b], stop[k]) - off[k]
            assert places[firsts].tolist() == bytes_before[offsets].tolist()


def test_any_ids_decode_as_the_library_does(model, library):
    rng = random.Random(4)
    draw = [lambda: rng.randrange(32000), lambda: rng.randrange(3, 259), lambda: rng.choice([0, 1, 2, 28705])]
    for _ in range(2000):
        ids = [rng.choice(draw)() for _ in range(rng.randrange(12))]
        assert sp.decoded(model, np.array(ids, np.int32), np.array([0, len(ids)])) == [library.decode(ids)]
    with pytest.raises(ValueError):
        sp.decoded(model, np.array([32000]), np.array([0, 1]))


def test_other_kinds_of_models_are_refused(model):
    with pytest.raises(ValueError):
        sp.Model(b"")


SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("id", T.StringType()), ("ids", T.LongType()), ("starts", T.StringType()))])
LONG = " ".join(f"w{i * 7919 % 10007}" for i in range(30000))
AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, LONG), (None, "null id"), (None, None), (7, "same row"), (7, "same row"), (8, "é中🎉▁x")]


def test_through_spark(spark, library, documents):
    encoder = sp.Encoder(catalog.piece_model_path())
    rows = AWKWARD + documents
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)
    table = encoder.encode(df)
    assert table.columns == ["doc_id", "ids", "starts", "ends"]
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(((r.doc_id, r.ids) for r in table.collect()), key=key) == sorted(((i, library.encode(t or "")) for i, t in rows), key=key)
    assert sorted(((r.doc_id, r.text) for r in encoder.decode(table).collect()), key=key) == sorted(
        ((i, library.decode(library.encode(t or ""))) for i, t in rows), key=key)
    empty = spark.createDataFrame([], SCHEMA)
    assert encoder.encode(empty).count() == encoder.decode(encoder.encode(empty)).count() == encoder.digests(empty).count() == 0


def test_query_equals_the_library(spark, library, documents):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for i, t in documents:
        ids = library.encode(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    got = catalog.op12_offset_preserving_pieces(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_spans_cut_the_text_into_its_pieces(spark):
    encoder = sp.Encoder(catalog.piece_model_path())
    text = "Zwölf Boxkämpfer  jagen\n🎉 Viktor"
    row = encoder.encode(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    raw = text.encode()
    assert b"".join(raw[a:b] for a, b in zip(row.starts, row.ends)) == raw
