"""What the shards' shuffle carries."""

import numpy as np
import pyarrow as pa
import pytest

from pawnshop.llm import bpe, training_order as order, text as tx
from pawnshop.llm.bpe import Tokenizer
from pawnshop.llm.catalog import END_TOKEN, vocabulary_path


@pytest.mark.parametrize("size", [0, 1, 7, 4096])
def test_squeezed_sequences_come_back(size):
    data = np.tile(np.arange(97, dtype="<u2"), size // 97 + 1).tobytes()[:size]
    packed = order.squeezed([data, b"", data])
    assert [order.unsqueezed(p, n) for p, n in zip(packed, (size, 0, size), strict=True)] == [data, b"", data]


def test_shards_shuffle_squeezed_sequences(spark):
    docs = spark.createDataFrame([(k, "the same few words again and again " * 40) for k in range(40)], "doc_id long, text string")
    packed = order.sequences(docs, Tokenizer(vocabulary_path()), END_TOKEN, length=64)
    shards = order.shards(packed, key=3, per_shard=16)
    exchange = next(x for x in shards._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1:])
    assert "squeezed" in exchange.split("Project [")[1].split("]")[0]
    rows = shards.collect()
    assert all(len(r["data"]) == r["n_sequences"] * 128 for r in rows)
    assert sum(r["n_sequences"] for r in rows) == packed.count()


@pytest.mark.parametrize("common", [[], [7], list(range(0, 2550, 10)), [65535, 0, 255]])
def test_any_bytes_come_back_whatever_units_are_common(common):
    made = np.random.default_rng(1)
    data = [made.integers(0, 256, n, np.uint8).tobytes() for n in (1, 2, 3, 513, 4096)] + [b"", b"\xff" * 4096, np.arange(2048, dtype="<u2").tobytes()]
    packed = order.squeezed(data, common)
    assert [order.unsqueezed(p, len(x), common) for p, x in zip(packed, data, strict=True)] == data


def test_shuffled_sequences_are_below_plain_zstd(spark):
    made = np.random.default_rng(2)
    data = [(made.zipf(1.3, 2048) * 37 % 50257).astype("<u2").tobytes() for _ in range(128)]
    packed = spark.createDataFrame([(0, k, bytearray(x)) for k, x in enumerate(data)], "block long, number long, data binary")
    common = order.common_units(packed)
    assert len(common) == len(set(common)) == 255
    assert common[0] == 37
    plain = sum(len(pa.Codec("zstd").compress(x, asbytes=True)) for x in data)
    assert sum(map(len, order.squeezed(data, common))) < 0.85 * plain


def test_shards_place_each_sequence_once_in_one_python_step(spark):
    docs = spark.createDataFrame([(k, "the same few words again and again " * 40) for k in range(40)], "doc_id long, text string")
    packed = order.sequences(docs, Tokenizer(vocabulary_path()), END_TOKEN, length=64)
    shards = order.shards(packed, key=3, per_shard=16)
    plan = shards._jdf.queryExecution().executedPlan().toString()
    # ranges of shards come by arithmetic: a range exchange would run the steps before it a second time for its sample
    assert "rangepartitioning" not in plan
    assert plan.count("MapInArrow") == 2 and "EvalPython" not in plan
    rows = shards.collect()
    assert sorted(r["shard"] for r in rows) == list(range(len(rows)))
    assert all(r["n_sequences"] == 16 for r in rows if r["shard"] < len(rows) - 1)


@pytest.mark.parametrize("room", [0, 1, 50, 1 << 17])
def test_known_words_change_no_id(room):
    made = np.random.default_rng(4)
    words = ["".join(chr(97 + c) for c in made.integers(0, 26, n)) for n in made.integers(1, 12, 200)] + ["x" * 700, "été", "<|endoftext|>", "12 34"]
    tokenizer = Tokenizer(vocabulary_path())
    vocabulary, lexicon, known = bpe._vocabulary(tokenizer.vocabulary), bpe._automaton(tokenizer.lexicon), bpe.Known(room)
    for _ in range(6):
        texts = [" ".join(made.choice(words, n)) for n in (0, 1, 40, 300)]
        data, off = tx.string_buffers(pa.array(texts))
        want, got = bpe.encode_run(data, off, vocabulary, lexicon), bpe.encode_run(data, off, vocabulary, lexicon, known)
        assert all(np.array_equal(a, b) for a, b in zip(want, got, strict=True))
        assert len(known.hashes) <= room
    assert room < 1000 or (known.find(known.hashes) >= 0).all() and 100 < len(known.hashes) and known.n.max() <= 64


def test_a_word_of_later_runs_is_merged_once(monkeypatch):
    merged = []
    vocabulary = bpe._vocabulary(Tokenizer(vocabulary_path()).vocabulary)
    plain = vocabulary.encode_words
    monkeypatch.setattr(vocabulary, "encode_words", lambda data, starts, ends: merged.append(len(starts)) or plain(data, starts, ends))
    data, off = tx.string_buffers(pa.array(["the same few words"]))
    known = bpe.Known()
    for _ in range(3):
        bpe.encode_run(data, off, vocabulary, bpe.Automaton(bpe.Automaton.build([], [])), known)
    assert merged == [4, 0, 0]
