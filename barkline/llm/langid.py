"""Language identification of spans: script ranges, per-word scores, Viterbi with a switching penalty.

A word here is a run of letters of one script; runs are split where the script changes, and into pieces
of at most MOST_LETTERS, all of which are scored: text without spaces is labelled piece by piece.
A word's script narrows the languages to those that were seen with it in training; others get a
fixed penalty. Per-word scores are log-likelihoods of the word's marked character n-grams under each
candidate. Viterbi over a text's words, with a penalty for each change of language, labels spans; the
text's language is the one with most letters, its score the share of letters in its spans.

Where no span of a language gains more than the penalty over the best single one, a better path has to
do without that one; it can't if the best prefix and the best suffix gain no more than the penalty
together. Then the best path is constant; running sums test it, and other texts are searched by steps.

Training reads about ``per_language`` texts a language, drawn by hashed id among those of at most ``LONGEST``
characters, which bounds what the driver holds; a language that has only longer ones is not learned. Edge cases:
a null text, or one without a letter, gives ``und`` and score 0; ties go to the first language in order; without
training rows every text is ``und``; a very long text is labelled whole, in the memory of one text; repeated rows get
equal results; an empty table gives an empty result; output names replace columns.
"""

from __future__ import annotations

import re
import uuid
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SEED, append_columns, char_grams, held_out

UNKNOWN = "und"
#: Texts that training reads of each language, and characters of such a text at most.
PER_LANGUAGE = 400
LONGEST = 1 << 17
PENALTY = 9.0
#: Log-likelihood that a language loses on a word of a script it was not seen with.
FOREIGN = 30.0
#: Share of a language's training words in a script from which it is a candidate for it.
CANDIDATE = 0.005

#: Letters of a piece of a run.
MOST_LETTERS = 40

#: First code points of script ranges.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "indic"),
    (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3130, "hangul"),
    (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"),
    (0x20000, "han"), (0x30000, "other"),
)
_STARTS = [a for a, _ in SCRIPTS]


def _letters(name: str) -> str:
    """The character class of letters of a script: letters outside the ranges of all others."""
    ends = [*_STARTS[1:], 0x110000]
    others = "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for (a, n), b in zip(SCRIPTS, ends, strict=True) if n != name)
    return rf"[^\W\d_{others}]"


#: Letters of one script, MOST_LETTERS at most; the lookahead keeps other characters from being tried by script.
_RUN = re.compile(r"[^\W\d_]+")
_WORD = re.compile(r"(?=[^\W\d_])(?:%s)" % "|".join(f"{_letters(n)}{{1,{MOST_LETTERS}}}" for n in dict.fromkeys(n for _, n in SCRIPTS)))


def script(word: str) -> str:
    return SCRIPTS[bisect_right(_STARTS, ord(word[0])) - 1][1]


@dataclass
class Model:
    languages: list[str]
    #: Hashes of known n-grams, and their log-likelihoods by language; one row more for an unseen one.
    hashes: np.ndarray
    table: np.ndarray
    candidates: dict[str, np.ndarray]

    def __post_init__(self):
        # sorted hashes lie in slots by their first bits, four slots a hash; the slot's first place, and its end
        order = np.argsort(self.hashes, kind="stable")
        self.known, self.place = self.hashes[order], np.append(order, len(order)).astype(np.int32)
        bits = max(1, (4 * len(order)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.known >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)

    def __reduce__(self):
        return Model, (self.languages, self.hashes, self.table, self.candidates)

    def rows(self, h: np.ndarray) -> np.ndarray:
        """Rows of the table for n-grams' hashes; the last row for one that is not known."""
        slot = (h >> self.shift).astype(np.int64)
        at, end = self.first[slot], self.first[slot + 1]
        out = np.full(len(h), len(self.known), np.int32)
        todo = np.flatnonzero(at < end)
        at, end, h = at[todo], end[todo], h[todo]
        while len(todo):
            hit = self.known[at] == h
            out[todo[hit]] = at[hit]
            at = at + 1
            left = ~hit & (at < end)
            todo, at, end, h = todo[left], at[left], end[left], h[left]
        return self.place[out]

    def words(self, words: list[str]) -> np.ndarray:
        """Scores of pieces of one script, a row each; languages that the script excludes lose FOREIGN."""
        k = len(self.languages)
        some = max(1, 50_000 // k)
        return np.concatenate([self._words(words[a : a + some]) for a in range(0, len(words), some)]) if words else np.zeros((0, k))

    def _words(self, words: list[str]) -> np.ndarray:
        h, of = char_grams([w.lower() for w in words])
        row = self.rows(h)
        n = np.bincount(of, minlength=len(words))
        total = np.stack([np.bincount(of, weights=t[row], minlength=len(words)) for t in self.table.T], 1)
        total /= np.maximum(1.0, n / (np.array([len(w) for w in words]) + 1))[:, None]
        every = np.ones(len(self.languages), bool)
        scripts = {s: self.candidates.get(s, every) for s in dict.fromkeys(n for _, n in SCRIPTS)}
        return total - FOREIGN * ~np.array([scripts["latin" if w[0] < "\u0370" else script(w)] for w in words])


def train(texts: list[str], langs: list[str]) -> Model:
    names = sorted(set(langs))
    words: dict[str, Counter] = {n: Counter() for n in names}
    for text, lang in zip(texts, langs, strict=True):
        words[lang].update(_WORD.findall(text.lower()))
    scripts: dict[str, np.ndarray] = {}
    own = []
    for k, n in enumerate(names):
        for w, c in words[n].items():
            scripts.setdefault(script(w), np.zeros(len(names)))[k] += c
        if words[n]:
            h, of = char_grams([w.lower() for w in words[n]])
            # frequent words must not drown the rest
            weight = 1.0 + np.log(np.fromiter(words[n].values(), float))
            h, at = np.unique(h, return_inverse=True)
            own.append((k, h, np.bincount(at, weights=weight[of])))
    hashes = np.unique(np.concatenate([h for _, h, _ in own])) if own else np.zeros(0, np.uint64)
    counts = np.zeros((len(hashes), len(names)))
    for k, h, c in own:
        counts[np.searchsorted(hashes, h), k] = c
    total = counts.sum(0) + 0.1 * max(1, len(counts))
    kept = np.flatnonzero(counts.sum(1) > 1.5)
    table = np.concatenate([counts[kept], np.zeros((1, len(names)))])
    every = sum(scripts.values(), np.zeros(len(names)))
    seen = {s: c >= CANDIDATE * np.maximum(every, 1) for s, c in scripts.items()}
    return Model(names, hashes[kept], np.log(table + 0.1) - np.log(total), {s: a for s, a in seen.items() if a.any()})


def fit(documents: DataFrame, modulus: int = 5, held: int = 0, per_language: int = PER_LANGUAGE) -> Model:
    """Train on about ``per_language`` texts a language whose ids are not held out."""
    rows = documents.where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length(F.col("text").cast("string")) <= LONGEST) & ~held_out(modulus, held)
    ).select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().toLocalIterator()}
    if not sizes:
        return train([], [])
    # a hashed id below the language's share: about per_language texts each, the same at each run
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, per_language / n))])
    drawn = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1_000_000)) < 1_000_000 * share[F.col("lang")])
    got = drawn.select("text", "lang").toPandas()
    return train(list(got["text"]), list(got["lang"]))


def viterbi(scores: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The best path of languages over words; rows of ``scores`` are words."""
    n, k = scores.shape
    best = int(scores.sum(0).argmax())
    gain = np.cumsum(scores - scores[:, best : best + 1], axis=0)
    low = np.minimum.accumulate(np.vstack([np.zeros((1, k)), gain[:-1]]), axis=0)
    if (gain - low).max(initial=0.0) <= penalty:
        # without ``best``, m spans gain at most prefix + suffix + (m - 2) * penalty, less (m - 1) * penalty
        prefix, suffix = gain[:-1].max(initial=0.0), (gain[-1] - gain[:-1]).max(initial=0.0)
        if prefix + suffix <= penalty:
            return np.full(n, best)
    value, before = [0.0] * k, []
    for row in scores.tolist():
        floor = max(value) - penalty
        before.append((value, floor))
        value = [(v if v >= floor else floor) + x for v, x in zip(value, row, strict=True)]
    path = np.zeros(n, np.int64)
    at = value.index(max(value))
    for t in range(n - 1, -1, -1):
        path[t] = at
        value, floor = before[t]
        if value[at] < floor:
            at = value.index(max(value))
    return path


class Labeller(dict):
    """Labels texts. As a dict it keeps the place of each run of letters that it has met in ``first`` and
    ``count``: a run's pieces are rows of ``scores`` and ``letters`` one after another."""

    def __init__(self, model: Model, most: int = 300_000):
        super().__init__()
        self.model, self.most = model, most
        self._forget()

    def _forget(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.scores, self.letters = np.zeros((0, len(self.model.languages))), np.zeros(0)

    def __missing__(self, run: str) -> int:
        self.new.append(run)
        self[run] = at = len(self)
        return at

    def _learn(self) -> None:
        """Score the pieces of new runs, all at once."""
        pieces, counts = [], []
        for run in self.new:
            got = [run] if len(run) <= MOST_LETTERS and run.isascii() else _WORD.findall(run)
            pieces += got
            counts.append(len(got))
        count = np.array(counts)
        self.first = np.concatenate([self.first, len(self.letters) + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.letters = np.concatenate([self.letters, [len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in pieces]])
        scores = self.model.words(pieces) * np.array([w[0].isalpha() for w in pieces])[:, None]
        self.scores = np.concatenate([self.scores, scores])
        self.new = []

    def paths(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """For each text (language of each piece, letters of each piece), or None without a letter."""
        if not self.model.languages:
            return [None] * len(texts)
        if len(self) > self.most:
            self._forget()
        runs = [np.fromiter(map(self.__getitem__, _RUN.findall(t)), np.int64) if t else np.zeros(0, np.int64) for t in texts]
        if self.new:
            self._learn()
        return [self._path(r) for r in runs]

    def _path(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        if not len(runs):
            return None
        n = self.count[runs]
        at = self.first[runs]
        if n.max() > 1:
            at = np.repeat(at - (np.cumsum(n) - n), n) + np.arange(n.sum())
        letters = self.letters[at]
        return (viterbi(self.scores[at]), letters) if letters.any() else None

    def labels(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out = []
        for got in self.paths(texts):
            if got is None:
                out.append((UNKNOWN, 0.0))
                continue
            by = np.bincount(got[0], weights=got[1], minlength=len(self.model.languages))
            out.append((self.model.languages[int(by.argmax())], float(by.max() / by.sum())))
        return out

    def label(self, text: str | None) -> tuple[str, float]:
        return self.labels([text])[0]

    def spans(self, text: str | None) -> list[dict]:
        """Runs of pieces of one language: start, end (exclusive, code points), lang."""
        got = self.paths([text])[0]
        out: list[dict] = []
        if got is not None:
            for m, k in zip(_WORD.finditer(text), got[0], strict=True):
                lang = self.model.languages[int(k)]
                if out and out[-1]["lang"] == lang:
                    out[-1]["end"] = m.end()
                else:
                    out.append({"start": m.start(), "end": m.end(), "lang": lang})
        return out


#: The labeller of a worker process, by run: what it has met serves the process's next tasks too.
_labeller: dict[str, Labeller] = {}


def identify(docs: DataFrame, model: Model, spans: bool = False, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with lang_pred and score, and on demand the labelled spans."""
    fields = [T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False)]
    if spans:
        span = T.StructType().add("start", "int").add("end", "int").add("lang", "string")
        fields.append(T.StructField("lang_spans", T.ArrayType(span), False))
    sent, run = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def make() -> Callable:
        if run not in _labeller:
            _labeller.clear()
            _labeller[run] = Labeller(sent.value)
        labeller = _labeller[run]

        def apply(texts):
            got = labeller.labels(texts)
            out = {"lang_pred": [a for a, _ in got], "score": [b for _, b in got]}
            return out | ({"lang_spans": [labeller.spans(t) for t in texts]} if spans else {})

        return apply

    return append_columns(docs, fields, make, keep=keep)
