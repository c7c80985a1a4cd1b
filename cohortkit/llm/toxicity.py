"""Operator 2: toxicity by averaged subword embeddings and a linear softmax.

A word's vector is the mean of its subwords' vectors (the word itself and its
character 3- to 6-grams between word marks, hashed to buckets), so a misspelt
or inflected form unseen in training shares the vectors of its n-grams. Words
are averaged over windows of ``WINDOW`` words and a linear softmax scores the
mean; embeddings and softmax are trained together by Adam in numpy on the
driver. A text scores as its worst window, so one abusive sentence is not
averaged away in a long text: in training a clean text's windows all count as
clean, a toxic text counts by its highest window.

The fit is bounded: at most ``PER_CLASS`` labelled texts of each class (those
of the smallest id hash), each of at most ``FIT_CHARS`` characters. Scoring
covers every whole text; the model it broadcasts is ``BUCKETS`` floats.

Defined results: null and empty texts score like a text without known words;
a null label, or a label of an absent document, is not used, of several labels
of a document the highest counts; repeated rows score alike; where labels lack
one of the classes every score is the share of label 1 (0 without labels);
other columns are ignored, an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, remainder, words

BUCKETS = 1 << 18
DIM = 4
WINDOW = 8
#: A window of fewer words is averaged as if padded to so many.
LEAST = 8
PER_CLASS = 1500
FIT_CHARS = 8_000
#: A bucket is trained if the words of at least so many sample texts meet it;
#: others keep the zero vector, as buckets unseen in training do.
LEAST_TEXTS = 12
GAIN = 8.0
DECAY = 5e-6
#: Words whose score a worker keeps at most.
KEPT = 400_000
#: Rows whose texts a worker holds at a time.
STEP = 512


def subwords(word: bytes) -> list[int]:
    """Buckets of the word and its 3- to 6-grams; '<' and '>' mark its ends."""
    w = f"<{word.decode('utf-8', 'replace')}>"
    n = len(w)
    out = [zlib.crc32(b"=" + word) & (BUCKETS - 1)]
    for k in (3, 4, 5, 6):
        out += [zlib.crc32(w[i:i + k].encode("utf-8", "replace")) & (BUCKETS - 1) for i in range(n - k + 1)]
    return out


@dataclass
class Model:
    """``weight[b]``: what bucket b adds to a word's log odds; the embeddings
    times the difference of the softmax's two rows."""

    weight: np.ndarray | None
    bias: float
    share: float


def _segments(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts ``keys``, starts of its runs, the distinct keys."""
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    starts = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]])
    return order, starts, sorted_keys[starts]


def _met_often(sub: np.ndarray, lens: np.ndarray, occ_word: np.ndarray, occ_doc: np.ndarray) -> np.ndarray:
    """Of each bucket, whether words of LEAST_TEXTS texts meet it. Counted over
    (word, text) pairs, which can only be more for n-grams of several words."""
    pairs = np.unique(occ_word.astype(np.int64) << 32 | occ_doc)
    texts_of_word = np.bincount(pairs >> 32, minlength=len(lens))
    met = np.bincount(sub, weights=np.repeat(texts_of_word, lens.astype(np.int64)), minlength=BUCKETS)
    return met >= LEAST_TEXTS


def train(texts: list[str], labels: list[int], steps: int = 100, seed: int = 7) -> Model:
    y = np.asarray(labels, dtype=np.int64)
    share = float(y.mean()) if len(y) else 0.0
    if not 0 < share < 1:
        return Model(None, 0.0, share)
    vocab: dict[bytes, int] = {}
    occ_word, occ_win, win_doc, win_len = [], [], [], []
    for d, text in enumerate(texts):
        ws = words(text)
        for at in range(0, max(1, len(ws)), WINDOW):
            part = ws[at:at + WINDOW]
            occ_word += [vocab.setdefault(w, len(vocab)) for w in part]
            occ_win += [len(win_doc)] * len(part)
            win_doc.append(d)
            win_len.append(max(LEAST, len(part)))
    occ_word, occ_win = np.asarray(occ_word, np.int32), np.asarray(occ_win, np.int32)
    win_doc, win_len = np.asarray(win_doc), np.asarray(win_len, np.float32)
    n_words, n_win = len(vocab), len(win_doc)
    bags = [np.asarray(subwords(w), np.int32) for w in vocab]
    lens = np.asarray([len(s) for s in bags], np.float32)
    row = np.repeat(np.arange(n_words, dtype=np.int32), lens.astype(np.int64))
    sub = np.concatenate(bags) if bags else np.empty(0, np.int32)
    del bags
    buckets = _met_often(sub, lens, occ_word, win_doc[occ_win])
    known = buckets[sub]
    buckets = np.flatnonzero(buckets)
    place = np.zeros(BUCKETS, np.int32)
    place[buckets] = np.arange(len(buckets))
    row, sub = row[known], place[sub[known]]
    _, s3, rows_met = _segments(row)  # already in order of words
    o2, s2, _ = _segments(sub)
    row_by_sub = row[o2]
    o1, s1, used_words = _segments(occ_word)
    win_by_word = occ_win[o1]
    _, s0, used_win = _segments(occ_win)  # already in order of windows

    rng = np.random.default_rng(seed)
    E = np.zeros((DIM, len(buckets)), np.float32)
    W = rng.normal(0, 0.5, (2, DIM)).astype(np.float32)
    b = np.zeros(2, np.float32)
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (E, W, b)]
    yw = y[win_doc]
    first = np.searchsorted(win_doc, np.arange(len(texts)))
    share_of_win = 1.0 / np.bincount(win_doc)[win_doc]
    for t in range(1, steps + 1):
        X = np.zeros((n_win, DIM), np.float32)
        for k in range(DIM):
            V = np.zeros(n_words, np.float32)
            if len(s3):
                V[rows_met] = np.add.reduceat(E[k][sub], s3)
            if len(s0):
                X[used_win, k] = np.add.reduceat((V / lens)[occ_word], s0)
        X *= GAIN / win_len[:, None]
        z = X @ W.T + b
        p = 1 / (1 + np.exp(np.clip(z[:, 0] - z[:, 1], -30, 30)))
        best = p == np.maximum.reduceat(p, first)[win_doc]
        weight = np.where(yw == 1, best if t > 15 else share_of_win, share_of_win + best)
        g = (weight * (p - yw) / len(texts)).astype(np.float32)
        dz = np.stack([-g, g], axis=1)
        dW, db = dz.T @ X, dz.sum(0)
        dX = (dz @ W) * (GAIN / win_len)[:, None]
        dE = np.zeros_like(E)
        for k in range(DIM):
            dV = np.zeros(n_words, np.float32)
            if len(s1):
                dV[used_words] = np.add.reduceat(dX[win_by_word, k], s1)
            if len(s2):
                dE[k] = np.add.reduceat((dV / lens)[row_by_sub], s2)
        rate = 0.4 if t < steps * 3 // 4 else 0.1
        for q, grad, (m, v), r in zip((E, W, b), (dE + DECAY * E, dW, db), state, (rate, rate / 10, rate / 10)):
            m += 0.1 * (grad - m)
            v += 0.02 * (grad * grad - v)
            q -= r * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.98 ** t)) + 1e-8)
    out = np.zeros(BUCKETS, np.float32)
    out[buckets] = (W[1] - W[0]) @ E
    return Model(out, float(b[1] - b[0]), share)


def fit_sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS,
               chars: int = FIT_CHARS) -> DataFrame:
    """The bounded sample of labelled texts: (doc_id, text, toxic)."""
    lab = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
           .where(remainder(F.col("doc_id"), 5) != 0)
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    own = F.xxhash64("doc_id")
    some = [lab.where(F.col("toxic") == k).orderBy(own, "doc_id").limit(per_class) for k in (0, 1)]
    ids = F.broadcast(some[0].unionByName(some[1]))
    return (docs.select("doc_id", "text").where(F.char_length("text") <= chars)
            .join(ids, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    rows = fit_sample(docs, labels).collect()
    rows.sort(key=lambda r: r.doc_id)
    return train([r.text for r in rows], [int(r.toxic) for r in rows])


def scorer(model: Model):
    """Text -> probability of label 1; the model keeps the scores of recent
    words, also from one task of a worker to the next."""
    if model.weight is None:
        return lambda text: model.share
    kept: dict[bytes, float] = model.__dict__.setdefault("kept", {})
    weight = model.weight

    def word(w: bytes) -> float:
        s = subwords(w)
        return float(weight[s].sum()) / len(s)

    def score(text: str | None) -> float:
        ws = words(text)
        values = []
        for w in ws:
            v = kept.get(w)
            if v is None:
                if len(kept) >= KEPT:
                    kept.clear()
                v = kept[w] = word(w)
            values.append(v)
        if not values:
            return float(1 / (1 + np.exp(-model.bias)))
        a = np.asarray(values)
        starts = np.arange(0, len(a), WINDOW)
        n = np.minimum(WINDOW, len(a) - starts)
        z = np.add.reduceat(a, starts) * GAIN / np.maximum(n, LEAST) + model.bias
        return float(1 / (1 + np.exp(-np.clip(z.max(), -700, 700))))

    return score


def score(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """doc_id and ``out`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        f = scorer(sent.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([f(t) for t in b.column(1).to_pylist()], pa.float64())],
                names=["doc_id", out])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, `{out}` double")


def filtered(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``limit``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        f = scorer(sent.value)
        for whole in batches:
            for first in range(0, whole.num_rows, STEP):
                b = whole.slice(first, STEP)
                yield b.filter(pa.array([f(t) < limit for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op2(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels)).select(
        "doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
