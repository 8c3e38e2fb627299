"""Importance resampling against a brute-force version."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from barkline.llm import queries, resample

from oracle import assert_equal

DOCS = "doc_id long, text string"


def features(text, longest=2):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def model(docs, target, buckets=10_000):
    """doc index -> (n_features, weight, score, rank), with a CRC of every n-gram's own bytes."""
    bucket = lambda f: crc32(f.encode("utf-8", "surrogatepass")) % buckets
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(map(bucket, features(x)[1]))
    for x in target:
        t.update(map(bucket, features(x)[1]))
    over, under = s.total() + buckets, t.total() + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * over / ((s[b] + 1) * under)))
    out = []
    for i, x in docs:
        n, f = features(x)
        weight = sum(map(gain, map(bucket, f))) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, -r[2], r[3]))
    for k, r in enumerate(able[: 25 * len(able) // 100]):
        r[5] = k + 1
    return sorted((r[0] is None, r[0] or 0, *map(str, r[2:])) for r in out)


def check(spark, docs, target):
    got = resample.resample(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(x,) for x in target], "text string"))
    rows = got.select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted((r[0] is None, r[0] or 0, *map(str, r[1:])) for r in rows) == model(docs, target)


def test_query_equals_sql(spark, sf_dir):
    assert_equal(queries.op11_resample(spark, sf_dir), sf_dir, queries.ORACLE_SQL["op11_resample"])


@pytest.mark.parametrize("piece", [1 << 20, 40])
def test_brute_force(spark, monkeypatch, piece):
    """Texts cut into pieces of 40 bytes have the n-grams of whole ones."""
    monkeypatch.setattr(resample, "PIECE", piece)
    rng = random.Random(5)
    words = ["Alpha", "beta", "γάμμα", "x1", "É", "é", "a" * 70, "😀", "don't", "0"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", "\n", ", ", "--", "\x7f"]) for _ in range(n))
    docs = [(k, text(rng.choice([0, 1, 2, 19, 20, 60]))) for k in range(120)]
    check(spark, docs, [text(30) for _ in range(5)] + [None, ""])


def test_edges(spark):
    long = " ".join(f"w{k % 977}" for k in range(300_000))
    same = "one two three " * 10
    docs = [(1, None), (2, ""), (3, " ,;"), (4, long), (None, same), (None, same), (7, same), (7, same), (7, same + "four"), (8, "w" * 3_000_000)]
    check(spark, docs, [same])
    check(spark, docs, [])
    check(spark, [(k, same) for k in range(40)], ["other words"])
    check(spark, [], [same])


def test_extra_columns(spark):
    docs = spark.createDataFrame([(1, "a b " * 20, 5, 6, {"k": 1}, "en")], "doc_id long, text string, score long, rank long, bucket map<string,int>, `in_0` string")
    got = resample.resample(docs, docs, percent=100, keep=["bucket", "score", "in_0"])
    assert got.columns == ["doc_id", "bucket", "in_0", "n_words", "n_features", "weight", "score", "rank"]
    assert got.first()["rank"] == 1 and got.first()["in_0"] == "en"


def test_shift_cancels_prefixes():
    """The CRC of any span from two prefixes, at lengths of one to four digits."""
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 400_000, dtype=np.uint8).tobytes()
    shift = resample.Shift()
    for n in (0, 1, 5, 63, 64, 4095, 4096, 300_000):
        a = crc32(data[:777])
        assert int(shift(np.array([a], np.uint32), np.array([n]))[0]) ^ crc32(data[: 777 + n]) == crc32(data[777 : 777 + n])
    c = np.array([crc32(b"abc")], np.uint32)
    assert int(shift.after_space(c)[0]) == crc32(b"abc ")
