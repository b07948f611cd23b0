"""Quality classifier by positive-unlabelled learning.

Only trusted positives and unlabelled web text are used: the risk of the
negative class is the unlabelled risk less the positives' share of it, kept from
going below zero (the non-negative risk estimator of Kiryo et al., 2017).  The
share of positives among unlabelled text, the class prior, is estimated from the
two samples alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pawnshop.llm import text as tx

#: At most so many rows of either kind are used to fit; scoring covers all rows.
FIT_POSITIVES = 20_000
FIT_UNLABELLED = 40_000
HIDDEN = 24
EPOCHS = 40
BATCH = 512
RATE = 0.01
DECAY = 1e-4

_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_SINGLE = b"!#$%&*|.,'\"-:;()/@?\n"
_ENDS_SENTENCE = np.zeros(256, bool)
_ENDS_SENTENCE[list(b".!?")] = True
FEATURES = 15 + len(_SINGLE)


def _mask(chars) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars)] = 1
    return out


_GROUPS = np.stack([_mask(range(65, 91)), _mask(range(97, 123)), _mask(range(48, 58)), _mask(_PUNCTUATION), _mask(range(128, 256)),
                    *[_mask([c]) for c in _SINGLE]], axis=1)


def _share_of_first(values: np.ndarray, owner: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row: number of distinct values, and how often its most frequent value occurs."""
    distinct, most = np.zeros(rows), np.zeros(rows)
    if len(values):
        order = np.lexsort((values, owner))
        v, o = values[order], owner[order]
        new = np.ones(len(v), bool)
        new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, len(v)))
        np.add.at(distinct, o[at], 1)
        np.maximum.at(most, o[at], size)
    return distinct, most


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of numbers for each text, from its characters, words and lines; zeros for an empty text."""
    n = len(off) - 1
    size = np.diff(off).astype(float)
    row = np.repeat(np.arange(n), np.diff(off))
    counts = np.bincount(row * 256 + data, minlength=256 * n).reshape(n, 256).astype(float) if len(data) else np.zeros((n, 256))
    share = counts / np.maximum(size, 1)[:, None]
    starts, ends, first = tx.spans_of(~tx.SPACE[data], off)
    words = np.diff(first).astype(float)
    owner = np.repeat(np.arange(n), np.diff(first))
    some = np.maximum(words, 1)
    code = tx.span_hash(tx.LOWER[data], starts, ends)
    length = (ends - starts).astype(float)
    per_row = lambda x: np.bincount(owner, x, minlength=n) if len(owner) else np.zeros(n)
    mean = per_row(length) / some
    spread = np.sqrt(np.maximum(per_row(length * length) / some - mean ** 2, 0))
    letter = (tx.BARE[data] & ~((data >= 48) & (data < 58))).astype(np.int64)
    letters = np.concatenate([[0], np.cumsum(letter)])
    bare = per_row((letters[ends] == letters[starts]).astype(float)) / some
    distinct, most = _share_of_first(code, owner, n)
    same = owner[1:] == owner[:-1]
    pair = tx.mix(code[:-1] * np.uint64(3) + code[1:])[same] if len(code) else code
    pairs, _ = _share_of_first(pair, owner[1:][same] if len(owner) else owner, n)
    again = np.bincount(owner[1:][same], code[1:][same] == code[:-1][same], minlength=n) if len(code) else np.zeros(n)
    line_start, line_end, line_first = tx.spans_of(data != 10, off)
    lines = np.diff(line_first).astype(float)
    different, _ = _share_of_first(tx.span_hash(data, line_start, line_end), np.repeat(np.arange(n), np.diff(line_first)), n)
    ended = per_row(_ENDS_SENTENCE[data[ends - 1]].astype(float)) / some if len(ends) else np.zeros(n)
    entropy = -(share * np.log(np.maximum(share, 1e-12))).sum(1)
    groups = share @ _GROUPS
    return np.column_stack([np.log1p(size), np.log1p(words), mean, spread, bare, distinct / some, most / some,
                            pairs / np.maximum(words - 1, 1), different / np.maximum(lines, 1), np.log1p(words / np.maximum(lines, 1)),
                            ended, np.sqrt(again / some), entropy, np.abs(groups[:, 0] - 0.03), groups[:, 4] > 0, np.sqrt(groups[:, 5:])])


@dataclass
class Model:
    """A network of one hidden layer over standardised features, and the class prior it was fitted with."""

    centre: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        z = np.clip((x - self.centre) / self.scale, -8, 8)
        return 1 / (1 + np.exp(-np.clip(np.tanh(z @ w1 + b1) @ w2 + b2, -30, 30)))


def _sigmoid(v):
    return 1 / (1 + np.exp(-np.clip(v, -30, 30)))


def _train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int) -> list[np.ndarray]:
    """Adam on the non-negative unbiased risk with the logistic loss."""
    rng = np.random.default_rng(seed)
    d = positive.shape[1]
    w = [rng.normal(0, d ** -0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(())]
    m, v, step = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
    rounds = max(1, -(-len(unlabelled) // BATCH))
    half = min(len(positive), BATCH)
    for epoch in range(EPOCHS):
        pu, pp = rng.permutation(len(unlabelled)), rng.permutation(len(positive))
        for k in range(rounds):
            u = unlabelled[pu[k * BATCH:(k + 1) * BATCH]]
            p = positive[np.take(pp, np.arange(k * half, (k + 1) * half), mode="wrap")]
            x = np.concatenate([p, u])
            h = np.tanh(x @ w[0] + w[1])
            s = _sigmoid(h @ w[2] + w[3])
            sp_, su = s[:len(p)], s[len(p):]
            # logistic loss: as negatives -log(1 - s), as positives -log(s); its slope in the output is s or s - 1
            negative_risk = -np.log(1 - su + 1e-12).mean() + prior * np.log(1 - sp_ + 1e-12).mean()
            slope = np.concatenate([-prior * sp_ / len(p), su / len(u)])
            if negative_risk < 0:
                slope = -slope  # climb back instead of fitting the unlabelled text ever better
            else:
                slope[:len(p)] += prior * (sp_ - 1) / len(p)
            back = np.outer(slope, w[2]) * (1 - h * h)
            grads = [x.T @ back + DECAY * w[0], back.sum(0), h.T @ slope + DECAY * w[2], slope.sum()]
            step += 1
            rate = RATE * (1 - 0.9 * epoch / EPOCHS)
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                w[i] = w[i] - rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    return w


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from scores of both.

    Above any threshold the unlabelled share is at least the prior times the
    positives' share; the smallest ratio over thresholds that leave a tenth of
    the positives or more is the estimate.
    """
    cuts = np.quantile(positive, np.linspace(0, 0.9, 91))
    p = 1 - np.searchsorted(np.sort(positive), cuts, "left") / len(positive)
    u = 1 - np.searchsorted(np.sort(unlabelled), cuts, "left") / len(unlabelled)
    return float(np.clip((u / np.maximum(p, 1e-9)).min(), 0.02, 0.98))


def fit(positive: np.ndarray, unlabelled: np.ndarray, seed: int = 7) -> Model:
    """Fit on the features of trusted positives and of unlabelled texts; without either, every score is the prior 0.5."""
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(FEATURES), np.ones(FEATURES), [np.zeros((FEATURES, 1)), np.zeros(1), np.zeros(1), np.zeros(())], 0.5)
    centre, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-6
    p, u = (np.clip((x - centre) / scale, -8, 8) for x in (positive, unlabelled))
    # positives against all of the unlabelled: a score that orders, from which the prior is read on positives left out
    left = np.arange(len(p)) % 4 == 0 if len(p) > 8 else np.zeros(len(p), bool)
    w = _train(p[~left], u, 0.5, seed)
    order = lambda x: _sigmoid(np.tanh(x @ w[0] + w[1]) @ w[2] + w[3])
    prior = estimated_prior(order(p[left] if left.any() else p), order(u))
    return Model(centre, scale, _train(p, u, prior, seed), prior)


def _feature_rows(batches):
    for batch in batches:
        for at, data, off in tx.runs(batch.column("text")):
            n = len(off) - 1
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, n), tx.list_array(features(data, off).ravel(), np.arange(n + 1) * FEATURES, pa.float64())],
                                             ["id", "x"])


def _matrix(frame: DataFrame) -> np.ndarray:
    column = frame.select("x").toArrow().column(0).combine_chunks()
    return np.asarray(column.flatten()).reshape(-1, FEATURES) if len(column) else np.zeros((0, FEATURES))


def fit_on(docs: DataFrame, positives: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on ``docs``, where ``positives`` holds the ids of trusted ones and all other rows count as unlabelled.

    Rows are drawn by a hash of their id, at most ``FIT_POSITIVES`` and
    ``FIT_UNLABELLED``; the texts of other rows are not shuffled or parsed.
    """
    draw = (F.pmod(F.xxhash64(F.col("id"), F.lit("fit")), F.lit(1 << 30)) / F.lit(float(1 << 30)))
    trusted = positives.select(F.col(id_col).cast("long").alias("id")).filter("id is not null").distinct()
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter("id is not null")
    all_rows, good_rows = src.count(), trusted.count()
    # a little more than wanted, then exactly as many as allowed
    share = [min(1.0, 1.1 * most / max(n, 1)) for most, n in ((FIT_POSITIVES, good_rows), (FIT_UNLABELLED, all_rows))]
    rows = src.filter(draw < max(share)).mapInArrow(_feature_rows, "id long, x array<double>")
    drawn = lambda frame, s, most: _matrix(frame.filter(draw < s).orderBy(draw, "id").limit(most))
    return fit(drawn(rows.join(trusted, "id", "left_semi"), share[0], FIT_POSITIVES), drawn(rows, share[1], FIT_UNLABELLED))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): the chance that each text is of the positive class.

    Null and empty texts get the score of the all-zero features; null and
    repeated ids are kept; other columns are ignored, whatever their names; an
    empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for at, data, off in tx.runs(batch.column("text")):
                n = len(off) - 1
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, n), pa.array(shared.value.score(features(data, off)), pa.float64())],
                                                 ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def with_score(docs: DataFrame, model: Model, name: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with a score column (see ``scored``); only the text passes through Python."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(text):
        import pandas as pd

        parts = [shared.value.score(features(data, off)) for _, data, off in tx.runs(pa.array(text, pa.string()))]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn(name, score(F.col(text_col).cast("string")))
