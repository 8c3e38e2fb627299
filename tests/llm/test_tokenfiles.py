"""Token files against the library's own ids of whole texts, and what a reader of parts sees."""

import glob
import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barkline.llm import queries, tokenfiles

PATH = public_tokenizers.path(queries.TOKENIZER)
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda x: t.encode(x or "", add_special_tokens=False).ids + [0]


def expected(docs, library):
    at, out = 0, []
    for i, x in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library(x)
        out.append((i, at, len(ids), crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: r[1])


def test_query_equals_library(spark, sf_dir, library):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(queries.op13_tokenfiles(spark, sf_dir)) == expected(docs, library)


def test_borders_equal_the_pattern():
    """Random strings over what the pattern tells apart, many texts at a time."""
    rng, find = random.Random(3), regex.compile(tokenfiles.PATTERN).findall
    alphabet = ["'", "'s", "'ll", "'re", "l", "v", "e", "t", " ", "  ", "\n", "\t", " ", "　", "a", "Ж", "中", "7", "²", "Ⅷ", "!", "…", "́", "_", "\x1c"]
    for _ in range(300):
        texts = ["".join(rng.choices(alphabet, k=rng.randrange(12))) for _ in range(30)]
        c = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        sizes = np.array([len(t) for t in texts])
        first = (np.cumsum(sizes) - sizes)[sizes > 0]
        at = [*tokenfiles.borders(c, first).tolist(), len(c)]
        joined = "".join(texts)
        assert [joined[a:b] for a, b in zip(at, at[1:], strict=False)] == [w for t in texts for w in find(t)]


def test_encoder_equals_library(library, monkeypatch):
    with open(PATH, "rb") as f:
        encode = tokenfiles.Encoder(f.read())
    rng = random.Random(4)
    alphabet = [" ", "'s", "don't", "été", "naïve", "\r\n", "  x", "😀", "🫠", "𞤀", "ꭓ", "<|endoftext|>", "12 345", "日本語", "᠎", "​", "à", "//", "\x00"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(30))) for _ in range(600)] + ["", " ", "w" * 5000]
    want = [library(t)[:-1] for t in texts]
    for piece, kept in ((1 << 20, 300_000), (50, 10)):
        monkeypatch.setattr(tokenfiles, "PIECE", piece)
        monkeypatch.setattr(tokenfiles, "KEPT", kept)
        assert [np.frombuffer(x, "<u4").tolist() for x in encode(texts)] == want
    long = " ".join(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in encode([long])] == [library(long)[:-1]]


def test_edges(spark, library):
    docs = [(5, "five"), (None, "no id"), (3, None), (3, ""), (-2, "minus"), (9, "long text " * 200_000), (7, "x" * 30_000), (8, "  \n"), (10, "<|endoftext|>")]
    assert [r for r in rows(tokenfiles.round_trip(spark.createDataFrame(docs, DOCS), PATH))] == expected(docs, library)
    assert tokenfiles.round_trip(spark.createDataFrame([], DOCS), PATH).count() == 0
    same = spark.createDataFrame([(1, "again")] * 500 + [(2, "after")], DOCS).repartition(7)
    got = rows(tokenfiles.round_trip(same, PATH))
    n = len(library("again"))
    assert [r[1] for r in got] == [n * k for k in range(501)] and got[-1][0] == 2


def test_files(spark, tmp_path, library, monkeypatch):
    """Encodings, row groups and page indexes; parts of the corpus are read without the rest."""
    monkeypatch.setattr(tokenfiles, "ROW_GROUP", 1 << 20)
    monkeypatch.setattr(tokenfiles, "PAGE_ROWS", 50)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("shard", F.lit("own"))
    folder = f"{tmp_path}/tokens"
    tokenfiles.write(docs, folder, PATH, keep=["lang", "shard"])
    files = sorted(glob.glob(f"{folder}/*.parquet"))
    columns = {c["column"]: c for f in files for c in tokenfiles.layout(f)}
    assert any("DICTIONARY" in e for e in columns["ids.list.element"]["encodings"])
    assert all("DELTA_BINARY_PACKED" in columns[c]["encodings"] for c in ("doc_id", "place"))
    assert all(c["indexed"] for c in columns.values()) and set(columns) == {"doc_id", "lang", "_shard", "shard", "place", "n_tokens", "ids.list.element"}
    assert max(c["group"] for f in files for c in tokenfiles.layout(f)) > 0
    every = rows(tokenfiles.documents(spark, folder).select("doc_id", "start", "ids"))
    assert [r[0] for r in every] == list(range(1000))
    flat = [i for r in every for i in r[2]]
    assert every[17][2] == library(docs.where("doc_id = 17").first()["text"])
    some = tokenfiles.documents(spark, folder, 100, 120)
    assert rows(some.select("doc_id", "start", "ids")) == every[100:121]
    assert "GreaterThanOrEqual(doc_id,100)" in some._jdf.queryExecution().executedPlan().toString()
    for a, b in ((0, 5), (every[40][1] - 3, every[43][1] + 2), (len(flat) - 4, len(flat) + 9), (7, 7)):
        got = rows(tokenfiles.span(spark, folder, a, b))
        assert [i for r in got for i in r[2]] == flat[a:b] and (not got or got[0][1] == a)
    plan = tokenfiles.manifest(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<shard:int,n_tokens:bigint>" in plan
