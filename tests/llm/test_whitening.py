"""Whitening against a dense eigensolver on whole tables, and the solver against matrices made by hand."""

import math
from fractions import Fraction

import numpy as np
import pytest

from barkline.llm import queries, whitening

ROWS = "vec_id long, embedding array<float>"


def model(rows):
    """{(vec_id, component): (n, deviation, |whitened|, explained)} of rows (vec_id, vector), by plain Python and eigh."""
    able = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in able}), dtype=np.int64)
    n, s = len(fit), [int(t) for t in fit.sum(0)]
    z = fit - np.array([float(Fraction(t, n)) for t in s])
    v = z.T @ z / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:16], q[:, ::-1][:, :16]
    out = {}
    for i, x in able:
        dev = sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True))
        w = (np.array(x) - np.array(s) / n) @ q / np.sqrt(e)
        out |= {(i, k + 1): (n, dev, abs(w[k]), e[k] / np.trace(v)) for k in range(len(e))}
    return out


def check(got, want, places=1e-6):
    rows = got.collect()
    assert {(r["vec_id"], r["component"]) for r in rows} == set(want) and len(rows) == len(want)
    for r in rows:
        n, dev, w, part = want[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, dev)
        assert abs(abs(r["whitened"]) - w) < places and abs(r["explained"] - part) < 1e-9 * part
        assert r["identity_error"] < 1e-9


def test_query(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(queries.op12_whitening(spark, d), model(rows))


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(k, (rng.standard_normal(5) * [5, 4, 3, 2, 1]).tolist()) for k in range(60)]
    odd = [(100, None), (101, []), (102, [1.0, None, 0.0, 0.0, 0.0]), (103, [math.nan] + [0.0] * 4), (104, [math.inf] + [0.0] * 4)]
    repeated = [(200 + k, rows[0][1]) for k in range(300)]
    want = model(rows + repeated)
    df = spark.createDataFrame(rows + odd + repeated + [(105, [1.0, 2.0]), (106, [1e30] + [0.0] * 4)], ROWS)
    got = whitening.whiten(df.selectExpr("*", "1 as component", "2 as x", "3 as n"))
    check(got, want)
    sign = {}
    for r in got.where("vec_id = 0 OR vec_id >= 200").collect():
        sign.setdefault(r["component"], set()).add(r["whitened"])
    assert all(len(s) == 1 for s in sign.values())


def test_few_or_no_vectors(spark):
    assert whitening.whiten(spark.createDataFrame([], ROWS)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], ROWS)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], ROWS)).count() == 0
    two = whitening.whiten(spark.createDataFrame([(1, [0.0, 0.0]), (None, [1.0, 1.0])], ROWS)).collect()
    assert {(r["vec_id"], r["component"], round(r["explained"], 12)) for r in two} == {(1, 1, 1.0), (None, 1, 1.0)}
    assert {round(abs(r["whitened"]), 9) for r in two} == {1.0}


@pytest.mark.parametrize("values", [
    np.linspace(1, 2, 40), np.ones(30), np.repeat([5.0, 3.0, 3.0 + 1e-9, 1.0], 6), 2.0 ** -np.arange(40), np.r_[1.0, np.zeros(20)], np.r_[np.ones(3), 1e-8 * np.ones(25)],
])
def test_feast(values):
    rng = np.random.default_rng(7)
    q = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    v = q * values @ q.T
    v = (v + v.T) / 2
    found = whitening.Feast(v)
    e, x = found.largest(16)
    want = np.linalg.eigh(v)[0][::-1][:16]
    assert np.abs(e - want).max() < 1e-12 * want[0]
    assert np.abs(x.T @ x - np.eye(len(e))).max() < 1e-6 and np.abs(v @ x - x * e).max() < 1e-12 * want[0]
    for s in (0.5, 1.5, 2.9999, 1e-3):
        assert whitening.above(v, s) == (np.linalg.eigvalsh(v) > s).sum()


def test_exact_sums_of_wide_numbers():
    n, d = 3, 2
    x = np.array([[0, 1 << 40], [1, 0], [5, -(1 << 41)]], np.int64)
    s = [int(t) for t in x.sum(0)]
    centre = [t // n for t in s]
    z = [[int(a) - c for a, c in zip(row, centre, strict=True)] for row in x.tolist()]
    products = [[sum(r[i] * r[j] for r in z) for j in range(d)] for i in range(d)]
    got = whitening.Whitening(n, s, products, centre).deviation(x)
    assert got == [v if (v := sum((n * a - b) ** 2 for a, b in zip(row, s, strict=True))) < 1 << 63 else None for row in x.tolist()]
