"""Quality rules: base limits, then robust multivariate outliers a language and source.

Each text gives counts; their transforms are a vector of five statistics. For each (lang, source) the
minimum-covariance-determinant estimate is the mean and covariance of the ``SUPPORT`` share of rows
whose covariance has the least determinant, found as FAST-MCD does for large tables:

1. From a bounded sample of each group (``SAMPLE`` rows on average, repeated rows counted once and weighted; the row
   of least hash is always in it, so each group has a start) ``STARTS`` random subsets of p + 1
   rows take two concentration steps (the share of rows nearest by Mahalanobis distance gives the next
   mean and covariance); the best ``FINALISTS`` go on until their determinant falls no more.
2. The finalists take concentration steps over all rows, as grouped aggregates with partial
   aggregation, until no determinant falls; the least one is the group's.
3. Rows within the 0.975 quantile of chi-square give the reweighted mean and covariance.

Counts are noisy and often zero in half of the rows, where a covariance is singular; so every covariance
has the group's mean counting noise added to its diagonal, as in the regularised estimate. A group's
estimate is drawn to that of all rows as if the latter brought p + 1 rows, so small groups need no
switch. A document goes if its squared distance is above the ``QUANTILE`` of chi-square with p degrees of
freedom, with the first-order correction of the F distribution for the rows that the estimate rests on.

Estimates have one row a group; they meet the rows by a join that Spark broadcasts within its own size
limit and otherwise splits where skewed. Null lang or source is a group of its own.

Edge cases: null and empty texts have zero counts and fail the base rules (n_words < 50); ties and
repeated rows count each time; a very long text is counted whole; an empty table gives an empty result;
extra columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SEED, append_columns, staged

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATS = ("log_words", "word_length", "symbol_rate", "dup_lines", "repeat_rate")
NOISE = tuple(f"v_{s}" for s in STATS)
#: Share of rows an estimate rests on, and the factor that makes such a covariance consistent:
#: share / P(chi-square(7) <= its quantile of chi-square(5)).
SUPPORT = 0.75
CONSISTENT = 1.35
#: Rows of a group that the search for starts reads on average, random starts, and starts that all rows refine.
SAMPLE = 1500
STARTS = 100
FINALISTS = 2
#: 0.975 and 0.9999 quantiles of chi-square(5): rows of the reweighted estimate, and the cutoff.
WEIGHED = 12.833
QUANTILE = 25.745
#: Rows that the estimate of all rows counts for in each group's.
PRIOR = 6
#: The key of the group of all rows; other keys are empty or begin with an equals sign.
ALL = "*"
#: Relative error of the distances' quantile is about 1 / ACCURACY.
ACCURACY = 5000


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; bytes.split() cuts at 9-13 and 32."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()
    blank = sum(map(text.count, " \t\n\v\f\r"))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif line.strip(" \t\v\f\r"):
            seen.add(line)
    n = len(words)
    repeat = 0
    if n > 3:
        ids: dict[bytes, int] = {}
        w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
        _, two = np.unique(w[:-1] * len(ids) + w[1:], return_inverse=True)
        _, three, times = np.unique(two[:-1] * len(ids) + w[2:], return_inverse=True, return_counts=True)
        again = times[three] > 1
        mark = np.zeros(n, bool)
        for k in range(3):
            mark[k : k + n - 2] |= again
        repeat = int(mark.sum())
    return n, len(text) - blank, symbols, dup, repeat


def with_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    fields = [T.StructField(c, T.LongType(), False) for c in COUNTS]

    def make() -> Callable:
        def apply(texts):
            rows = np.array([counts(t) for t in texts], np.int64).reshape(-1, len(COUNTS))
            return {c: rows[:, i] for i, c in enumerate(COUNTS)}

        return apply

    return append_columns(docs, fields, make, keep=keep)


def stats() -> list[Column]:
    """The transformed statistics of the counts, and the variance that counting alone gives each.

    The root of a rate k / n has variance u / 4n if k comes in lots of u: a symbol, a line, and six words,
    which the least repeat of a three-word window marks.
    """
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return [
        F.log(n).alias("log_words"), (chars / n).alias("word_length"), F.sqrt(F.col("n_symbols") / chars).alias("symbol_rate"),
        F.sqrt(F.col("n_dup_lines") / n).alias("dup_lines"), F.sqrt(F.col("n_repeat_words") / n).alias("repeat_rate"),
        (1 / n).alias(NOISE[0]), (chars / n / n).alias(NOISE[1]), (1 / (4 * chars)).alias(NOISE[2]), (1 / (4 * n)).alias(NOISE[3]), (6 / (4 * n)).alias(NOISE[4]),
    ]


def concentrated(x: np.ndarray, mean: np.ndarray, cov: np.ndarray, h: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One concentration step for each of several estimates: (mean, cov, log determinant), cov without noise added."""
    d = x[None] - mean[:, None]
    d2 = np.einsum("sni,sij,snj->sn", d, np.linalg.inv(cov), d)
    near = x[np.argsort(d2, axis=1, kind="stable")[:, :h]]
    m = near.mean(1)
    c = near - m[:, None]
    return m, CONSISTENT * np.einsum("sni,snj->sij", c, c) / h, np.sort(d2, axis=1)[:, h - 1]


def fast_mcd(x: np.ndarray, noise: np.ndarray, starts: int = STARTS, finalists: int = FINALISTS, seed: int = SEED) -> list[tuple[np.ndarray, np.ndarray]]:
    """The best (mean, covariance with noise) of rows ``x``, the least determinant first."""
    n, p = x.shape
    h = max(1, math.ceil(SUPPORT * n))
    ridge = np.diag(noise)
    rng = np.random.default_rng(seed)
    picks = np.array([rng.choice(n, min(n, p + 1), replace=False) for _ in range(starts)])
    mean = x[picks].mean(1)
    c = x[picks] - mean[:, None]
    cov = np.einsum("sni,snj->sij", c, c) / picks.shape[1] + ridge
    for _ in range(2):
        mean, cov, _ = concentrated(x, mean, cov, h)
        cov = cov + ridge
    best = np.argsort(np.linalg.slogdet(cov)[1], kind="stable")[: 5 * finalists]
    mean, cov = mean[best], cov[best]
    while True:
        new, wide, _ = concentrated(x, mean, cov, h)
        wide = wide + ridge
        falls = np.linalg.slogdet(wide)[1] < np.linalg.slogdet(cov)[1] - 1e-9
        if not falls.any():
            break
        mean, cov = np.where(falls[:, None], new, mean), np.where(falls[:, None, None], wide, cov)
    out: list = []
    for k in np.argsort(np.linalg.slogdet(cov)[1], kind="stable"):
        if len(out) < finalists and not any(np.allclose(mean[k], m, rtol=1e-6) for m, _ in out):
            out.append((mean[k], cov[k]))
    return out


def _distance(mean: str, inverse: str) -> Column:
    """Squared Mahalanobis distance of the row's statistics."""
    p = len(STATS)
    d = [F.col(s) - F.col(mean)[i] for i, s in enumerate(STATS)]
    terms = [d[i] * d[j] * F.col(inverse)[i * p + j] * (1 if i == j else 2) for i in range(p) for j in range(i, p)]
    return reduce(lambda a, b: a + b, terms)


@F.pandas_udf(T.StructType([T.StructField("inverse", T.ArrayType(T.DoubleType())), T.StructField("logdet", T.DoubleType())]))
def _inverse(cov: pd.Series) -> pd.DataFrame:
    """Inverses and log determinants of flattened covariance matrices."""
    p = len(STATS)
    m = [np.array(x, float).reshape(p, p) for x in cov]
    return pd.DataFrame({"inverse": [np.linalg.inv(x).ravel() for x in m], "logdet": [np.linalg.slogdet(x)[1] for x in m]})


def _inverted(estimates: DataFrame) -> DataFrame:
    return estimates.withColumn("of", _inverse("cov")).select(*estimates.columns, "of.inverse", "of.logdet")


def _moments(rows: DataFrame, keys: list[str], factor: float) -> DataFrame:
    """(keys, rows, mean, cov) of the rows; ``factor`` times the covariance plus the rows' mean noise."""
    p = len(STATS)
    upper = [F.covar_pop(F.col(STATS[i]), F.col(STATS[j])).alias(f"c{i}{j}") for i in range(p) for j in range(i, p)]
    got = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *[F.avg(s).alias(f"m_{s}") for s in STATS], F.first("noise").alias("noise"), *upper)
    flat = [factor * F.col(f"c{min(i, j)}{max(i, j)}") + (F.col("noise")[i] if i == j else F.lit(0.0)) for i in range(p) for j in range(p)]
    return got.select(*keys, "rows", F.array(*[F.col(f"m_{s}") for s in STATS]).alias("mean"), F.array(*flat).alias("cov"))


def _draw() -> Column:
    return F.xxhash64("doc_id", *STATS)


def _starts(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, cand, mean, cov): the finalists of each group from a bounded sample of its rows."""
    h = _draw()
    drawn = rows.join(groups, keys).where((F.pmod(h, F.lit(1_000_000)) * F.col("n") < 1_000_000 * SAMPLE) | (h == F.col("least")))
    # rows that repeat are drawn together, but reach the group's task as one with its number of copies
    drawn = drawn.groupBy(*keys, *STATS).agg(F.count(F.lit(1)).alias("copies"), F.first("noise").alias("noise"))
    schema = T.StructType([*[rows.schema[k] for k in keys], *T.StructType.fromDDL("cand int, mean array<double>, cov array<double>")])

    def search(table: pa.Table) -> pa.Table:
        x = np.stack([table.column(s).to_numpy() for s in STATS], 1)
        copies = table.column("copies").to_numpy()
        # as often as they come, in proportion where that is more than four samples
        copies = np.ceil(copies * min(1.0, 4 * SAMPLE / copies.sum())).astype(int)
        x = np.repeat(x, copies, axis=0)
        x = x[np.lexsort(x.T)]  # the same starts however the rows arrive
        found = fast_mcd(x, np.array(table.column("noise")[0].as_py()))
        first = {k: pa.array([table.column(k)[0].as_py()] * len(found), table.schema.field(k).type) for k in keys}
        return pa.table(first | {"cand": pa.array(range(len(found)), pa.int32()), "mean": [m.tolist() for m, _ in found], "cov": [c.ravel().tolist() for _, c in found]})

    return drawn.groupBy(*keys).applyInArrow(search, schema)


def mcd(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rows, mean, cov): the reweighted minimum-covariance-determinant estimate of each group."""
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(_draw()).alias("least"), F.array(*[F.avg(v) for v in NOISE]).alias("noise"))
    groups = staged(groups, "groups")
    best = staged(_inverted(_starts(rows, groups, keys)), "starts")
    slim = rows.select(*keys, *STATS)
    each = [*keys, "cand"]
    while True:  # each step lowers a determinant that the noise bounds
        far = slim.join(best.select(*each, "mean", "inverse"), keys).withColumn("d2", _distance("mean", "inverse")).drop("mean", "inverse")
        limit = staged(far.groupBy(*each).agg(F.percentile_approx("d2", SUPPORT, ACCURACY).alias("limit")), "limit")
        near = far.join(limit, each).where("d2 <= limit").join(groups, keys)
        new = _inverted(_moments(near, each, CONSISTENT)).select(*each, *[F.col(c).alias(f"new_{c}") for c in ("mean", "cov", "inverse", "logdet")])
        both = best.join(new, each).withColumn("falls", F.col("new_logdet") < F.col("logdet") - 1e-4)
        best = staged(both.select(*each, "falls", *[F.when(F.col("falls"), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) for c in ("mean", "cov", "inverse", "logdet")]), "best")
        if best.where("falls").isEmpty():
            break
    least = best.groupBy(*keys).agg(F.min(F.struct("logdet", "cand", "mean", "inverse")).alias("x")).select(*keys, "x.mean", "x.inverse")
    inside = slim.join(staged(least, "least"), keys).where(_distance("mean", "inverse") <= WEIGHED).drop("mean", "inverse")
    return staged(_moments(inside.join(groups, keys), keys, 1.0), "mcd")


def rule_verdicts(docs: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """doc_id, the five counts, base_failed, kept and distance of each document."""
    keyed = docs.select(
        "doc_id", "text",
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("k_lang"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("k_source"),
    )
    base = staged(with_counts(keyed, ["doc_id", "k_lang", "k_source"]), "counts")
    rows = base.select("*", *stats()).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    )
    keys, p = ["k_lang", "k_source"], len(STATS)
    fit = rows.where(~F.col("base_failed"))
    # every row is in the group of its keys and in that of all rows
    of_all = [F.lit(ALL).alias(k) for k in keys]
    both = fit.withColumn("of", F.explode(F.array(F.struct(*keys), F.struct(*of_all)))).drop(*keys).select("*", "of.*").drop("of")
    found = mcd(both, keys)
    pool = found.where(F.col(keys[0]) == ALL).first()
    if pool is None:  # no row passes the base rules
        return rows.select("doc_id", *COUNTS, "base_failed", F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance"))
    drawn = lambda own, every: [(F.col("rows") * F.col(own)[i] + F.lit(PRIOR * float(x))) / (F.col("rows") + PRIOR) for i, x in enumerate(every)]
    own = found.select(*keys, "rows", F.array(*drawn("mean", pool["mean"])).alias("mean"), F.array(*drawn("cov", pool["cov"])).alias("cov"))
    own = staged(_inverted(own).drop("cov", "logdet"), "own")
    # p F(p, v) is about q (1 + (q - p + 2) / 2v) at the quantile q of chi-square(p)
    cutoff = quantile * (1 + (quantile - p + 2) / (2 * (F.col("rows") + PRIOR)))
    judged = rows.join(own, keys, "left").withColumn("distance", _distance("mean", "inverse"))
    return judged.select(
        "doc_id", *COUNTS, "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))).alias("kept"), "distance",
    )
