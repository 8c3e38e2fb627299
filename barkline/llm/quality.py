"""Quality classifier: supervised subword embeddings.

Each word has a vector of its own bucket plus those of its character n-grams, and each pair of words in
a row has one (all hashed; where both words are equal the pair is hashed as back-references, whatever
the word, so that repetition is learned across words). A text is the mean of its words' and pairs' vectors and of one end-of-text
vector; a softmax over two classes follows. The vectors and the softmax are trained in numpy by
stochastic gradient descent on a bounded sample of labelled rows. Scoring is linear in the vectors, so a
task keeps one number a word.

Edge cases: null and empty texts have the end-of-text vector only; without both labels the score is
the share of good ones; repeated rows and ties get equal scores; an empty table gives an empty result; a
very long text is scored whole; columns score and predicted are replaced, other columns are carried.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import SEED, append_columns, char_grams, labelled_sample, mixed

LABELLED_ROWS = 4000
BUCKETS = 1 << 17
DIM = 8
EPOCHS = 4
RATE = 3.0
_BITS = np.uint64(64 - 17)
_NEXT = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Model:
    """Per-bucket difference of the two classes' logits; bucket 0 is the end of a text."""

    gain: np.ndarray
    prior: float


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return np.maximum(hashes >> _BITS, np.uint64(1)).astype(np.int32)


class Words(dict):
    """Word -> its place; places hold the word's hash (``marks``) and what ``learn`` makes of its buckets."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most = most
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.marks = np.zeros(0, np.uint64)

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = at = len(self)
        return at

    def learn(self) -> tuple[np.ndarray, np.ndarray]:
        """(bucket, place among the new words) of the n-grams and whole words that are new."""
        hashes, of = char_grams(self.new, 2)
        # whole words come last, in order
        self.marks = np.concatenate([self.marks, hashes[len(hashes) - len(self.new) :]])
        self.new = []
        return _buckets(hashes), of

    def pairs(self, at: np.ndarray) -> np.ndarray:
        """Buckets of the pairs of words in a row; a pair of equal words is written as two back-references."""
        m = self.marks[at]
        same = m[:-1] == m[1:]
        return _buckets(mixed(np.where(same, _NEXT, m[:-1]) * _NEXT + np.where(same, _NEXT, m[1:])))


def _bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their weights: the share of each among its n-grams, words, pairs and end."""
    words = Words()
    at = np.fromiter(map(words.__getitem__, text.split() if text else []), np.int64)
    ids, weights = [np.zeros(1, np.int32)], [np.ones(1)]
    if len(at):
        b, of = words.learn()
        pairs = words.pairs(at)
        ids += [b, pairs]
        weights += [np.bincount(at)[of], np.ones(len(pairs))]
    used, place = np.unique(np.concatenate(ids), return_inverse=True)
    weight = np.bincount(place, weights=np.concatenate(weights))
    return used, (weight / weight.sum()).astype(np.float32)


def train(texts: Iterable, y: np.ndarray, epochs: int = EPOCHS, dim: int = DIM, seed: int = SEED) -> Model:
    y = np.asarray(y, int)
    if len(y) == 0 or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        return Model(np.zeros(BUCKETS), float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1.0 / dim, 1.0 / dim, (BUCKETS, dim))
    out = np.zeros((2, dim))
    bags = [_bag(t if isinstance(t, str) else t.as_py()) for t in texts]
    weight = len(y) / (2.0 * np.bincount(y, minlength=2))
    weight = np.minimum(weight, 4.0)
    steps, done = epochs * len(y), 0
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            ids, w = bags[i]
            mean = w @ vectors[ids]
            z = out @ mean
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1.0
            rate = RATE * (1 - done / steps) * weight[y[i]]
            grad = p @ out
            out -= rate * np.outer(p, mean)
            vectors[ids] -= np.outer(w, rate * grad)
            done += 1
    return Model(vectors @ (out[1] - out[0]), 0.0)


def fit(documents: DataFrame, labels: DataFrame, modulus: int = 4, held: int = 2, bound: int = LABELLED_ROWS) -> Model:
    """Train on a bounded sample of labelled rows; held-out ids are never read."""
    got = labelled_sample(documents, labels, "quality", modulus, held, bound).toArrow()
    return train(got.column("text"), got.column("y").to_numpy())


def score(docs: DataFrame, model: Model, threshold: float = 0.7, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with score (0 to 1, softmax of class 1) and predicted."""
    fields = [T.StructField("score", T.DoubleType(), False), T.StructField("predicted", T.IntegerType(), False)]
    sent = docs.sparkSession.sparkContext.broadcast((model.gain, model.prior))

    def make() -> Callable:
        gain, prior = sent.value
        words, known, sizes = Words(), np.zeros(0), np.zeros(0)

        def apply(texts):
            nonlocal known, sizes
            if len(words) > words.most:
                words.forget()
                known, sizes = np.zeros(0), np.zeros(0)
            found = [np.fromiter(map(words.__getitem__, t.split() if t else []), np.int64) for t in texts]
            if n := len(words.new):
                b, of = words.learn()
                known = np.concatenate([known, np.bincount(of, weights=gain[b], minlength=n)])
                sizes = np.concatenate([sizes, np.bincount(of, minlength=n)])
            total = [gain[0] + known[at].sum() + gain[words.pairs(at)].sum() if len(at) else gain[0] for at in found]
            z = prior + np.array(total) / np.array([sizes[at].sum() + max(len(at), 1) for at in found])
            s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            return {"score": s, "predicted": (s >= threshold).astype(np.int32)}

        return apply

    return append_columns(docs, fields, make, keep=keep)
