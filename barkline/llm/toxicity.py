"""Toxicity: a linear classifier regularised by counterfactuals.

Features of a text are the distinct words, word starts and word n-grams that it holds. Weights are
logistic regression's with an L1 penalty and no weight below zero (evidence adds up, long texts
gather no noise), plus a penalty on the squared change of a labelled text's score between
counterfactuals: for each set of identity terms, a term of the text is swapped for another one of the
set; a text without any takes two of them in turn. Each set holds a neutral word, so a mention of a
group can carry no more weight than that word does.

Training takes at most ``bound`` labelled rows (a uniform sample by hashed id) and runs in numpy on
the driver over hashed features of bounded number; scoring runs in tasks over whole texts.

Edge cases: null and empty texts have no features and get the score of the bias; without labels of
both kinds the score is the share of toxic labels (0 if there are none); repeated rows and ties get
equal scores; an empty table gives an empty result; a very long text costs its distinct words; columns
named score or predicted are replaced, other columns are carried.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import SEED, append_columns, give_back, labelled_sample

#: Sets of terms that may stand for each other, the neutral word last.
IDENTITY_TERMS = (
    ("women", "men", "people"), ("woman", "man", "person"), ("female", "male", "human"), ("girls", "boys", "children"),
    ("black", "white", "asian", "latino", "other"), ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "religious"),
    ("gay", "straight", "lesbian", "bisexual", "single"), ("immigrants", "natives", "people"), ("old", "young", "adult"),
    ("frauen", "männer", "menschen"), ("femmes", "hommes", "personnes"), ("mujeres", "hombres", "personas"),
    ("juifs", "musulmans", "chrétiens", "croyants"),
)

LABELLED_ROWS = 4000
BUCKETS = 1 << 20
#: Documents of the sample that a feature must occur in.
LEAST = 3
#: L1 penalty times the square root of the number of rows over 12.
L1 = 0.01
PAIR_WEIGHT = 1.0
_WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[int]:
    """Hashed features of a word: itself, its starts of 3 to 6 letters, its inner 4-grams."""
    got = {"w" + word} | {f"p{word[:k]}" for k in range(3, min(6, len(word)) + 1)}
    got |= {"g" + word[i : i + 4] for i in range(len(word) - 3)}
    return [zlib.crc32(g.encode()) % BUCKETS for g in got]


def words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


@dataclass
class Model:
    """Weights above zero by feature, and the bias."""

    weights: dict[int, float]
    bias: float

    def word(self, w: str) -> float:
        return sum(self.weights.get(f, 0.0) for f in features(w))

    def logit(self, text: str | None) -> float:
        got = {f for w in words(text) for f in features(w)}
        return self.bias + sum(self.weights.get(f, 0.0) for f in got)


def swaps(have: set[str], draw: int) -> list[tuple[str, str]]:
    """One pair of terms (out, in) of each set: a term that the text holds and another one, else two of the set."""
    out = []
    for k, terms in enumerate(IDENTITY_TERMS):
        held = [t for t in terms if t in have]
        pick = zlib.crc32(b"%d:%d" % (draw, k))
        a = held[pick % len(held)] if held else terms[pick % len(terms)]
        others = [t for t in terms if t != a]
        out.append((a, others[(pick >> 8) % len(others)]))
    return out


class _Rows:
    """Sparse rows of signed features, appended one by one."""

    def __init__(self):
        self.at, self.of, self.sign, self.n = array("i"), array("i"), array("b"), 0

    def add(self, up: list[int], down: tuple = ()) -> None:
        self.at.extend(up), self.at.extend(down)
        self.sign.extend([1] * len(up) + [-1] * len(down))
        self.of.extend([self.n] * (len(up) + len(down)))
        self.n += 1

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.frombuffer(self.at, np.int32), np.frombuffer(self.of, np.int32), np.frombuffer(self.sign, np.int8)


def _largest(of: np.ndarray, at: np.ndarray, val: np.ndarray, n: int, m: int) -> float:
    """The largest eigenvalue of D'D for sparse rows D (n by m), by power iteration from above its start."""
    v, top = np.random.default_rng(SEED).random(m) + 0.1, 0.0
    for _ in range(50):
        v /= np.linalg.norm(v)
        v = np.bincount(at, weights=val * np.bincount(of, weights=val * v[at], minlength=n)[of], minlength=m)
        top = float(np.linalg.norm(v))
        if top == 0.0:
            return 0.0
    return top


def _remembered(make: Callable[[str], Sequence[int]], most: int = 30_000) -> Callable[[str], Sequence[int]]:
    """``make`` with its results kept, for ``most`` words at a time."""
    cache: dict[str, Sequence[int]] = {}

    def get(w: str) -> Sequence[int]:
        if w not in cache:
            if len(cache) >= most:
                cache.clear()
            cache[w] = make(w)
        return cache[w]

    return get


def _words_of(text) -> set[str]:
    return words(text if isinstance(text, str) else text.as_py())


def train(texts: Collection, y: np.ndarray, steps: int = 400, l1: float = L1, pair_weight: float = PAIR_WEIGHT) -> Model:
    """Proximal gradient steps with momentum on the penalised mean log-loss, weights >= 0.

    The texts are read twice, so that only rows of features that can carry weight are kept.

    The step is one over a bound of the curvature: a quarter of the weighted mean number of features
    for the loss, plus the largest eigenvalue of the counterfactuals' matrix for the penalty.
    """
    y = np.asarray(y, float)
    if len(y) == 0 or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Model({}, float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    times, toxic = np.zeros(BUCKETS, np.int32), np.zeros(BUCKETS)
    known = _remembered(features)
    for text, label in zip(texts, y, strict=True):
        got = {f for w in _words_of(text) for f in known(w)}
        at = np.fromiter(got, np.int32, len(got))
        times[at] += 1
        toxic[at] += label
    # features that occur in fewer documents, or no likelier in toxic ones, stay at zero: rows hold the others only
    ids = np.flatnonzero((times >= LEAST) & (toxic > 1.5 * y.mean() * times))
    index = {int(f): i for i, f in enumerate(ids)}
    del times, toxic
    # most words keep few or none, so more of them are remembered
    known = _remembered(lambda w: tuple(index[f] for f in features(w) if f in index), 150_000)
    rows, changes = _Rows(), _Rows()
    for k, text in enumerate(texts):
        have = _words_of(text)
        got = {f for w in have for f in known(w)}
        rows.add(sorted(got))
        for a, b in swaps(have, k):
            # features that leave and enter: those of the text's other words stay
            rest = {f for w in have for f in known(w) if w not in (a, b)} if a in have else got
            x, z = set(known(a)) - rest, set(known(b)) - rest
            changes.add(sorted(x - z), tuple(sorted(z - x)))
    at, of, _ = rows.arrays()
    p_at, p_of, p_val = changes.arrays()
    p_val = p_val.astype(float)
    share = pair_weight / changes.n
    l1 = l1 * np.sqrt(12 / len(y))
    balance = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    theta, bias = np.zeros(len(ids)), 0.0
    look, look_b, t = theta.copy(), bias, 1.0
    size = np.bincount(of, minlength=len(y)) + 1.0
    rate = 1.0 / (0.25 * (balance @ size) + 2 * share * 1.05 * _largest(p_of, p_at, p_val, changes.n, len(ids)))
    for _ in range(steps):
        z = look_b + np.bincount(of, weights=look[at], minlength=len(y))
        g = balance * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        grad = np.bincount(at, weights=g[of], minlength=len(ids))
        if len(p_at):
            change = np.bincount(p_of, weights=p_val * look[p_at], minlength=changes.n)
            grad += 2 * share * np.bincount(p_at, weights=p_val * change[p_of], minlength=len(ids))
        new, new_b = np.maximum(look - rate * (grad + l1), 0.0), look_b - rate * g.sum()
        if (look - new) @ (new - theta) + (look_b - new_b) * (new_b - bias) > 0:
            t = 1.0  # momentum points uphill
        t, was = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        look, look_b = new + (was - 1) / t * (new - theta), new_b + (was - 1) / t * (new_b - bias)
        theta, bias = new, new_b
    return Model({int(i): float(v) for i, v in zip(ids, theta, strict=True) if v > 1e-6}, float(bias))


def fit(documents: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0, bound: int = LABELLED_ROWS) -> Model:
    """Train on a bounded sample of labelled rows; held-out ids are never read."""
    got = labelled_sample(documents, labels, "toxic", modulus, held, bound).toArrow()
    model = train(got.column("text"), got.column("y").to_numpy())
    del got
    give_back()
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.5, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1) and predicted of the texts in a column."""
    fields = [T.StructField("score", T.DoubleType(), False), T.StructField("predicted", T.IntegerType(), False)]

    def make() -> Callable:
        known: dict[str, tuple[int, ...]] = {}

        def logit(text):
            got: set[int] = set()
            for w in words(text):
                f = known.get(w)
                if f is None:
                    f = known[w] = tuple(x for x in features(w) if x in model.weights)
                got.update(f)
            return model.bias + sum(map(model.weights.__getitem__, got))

        def apply(texts):
            if len(known) > 200_000:
                known.clear()
            z = np.array([logit(t) for t in texts], float)
            s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            return {"score": s, "predicted": (s >= threshold).astype(np.int32)}

        return apply

    return append_columns(docs, fields, make, text=text, keep=keep)
