"""Texts cut before spaces give the ids of whole texts; plans of the byte-pair fold hold no rank table."""

import random

import public_tokenizers as P
import regex

from barkline.llm import bpe, queries

HARD = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n b", "a\n  b", "\n \na", "a  b", "a 　b", "a\x1c b", "it's  'll go", "x᠎ y​ z", "a\t \tb ", "w" * 99 + " " + "v" * 99]


def texts():
    rng = random.Random(8)
    return HARD + ["".join(rng.choice("abé中😀'.\n\t\x1d ᠎09    ") for _ in range(rng.randrange(1, 120))) for _ in range(3000)]


def test_words_by_remembered_pieces(monkeypatch):
    split = regex.compile(bpe.BYTE_LEVEL).findall
    assert bpe.cuttable(P.PATTERN) and not bpe.cuttable(r"\S+|\s+")
    for limit in (300_000, 20):
        monkeypatch.setattr(bpe, "CUTS", limit)
        words = bpe.Numbered({}, [])
        pieces = bpe.Pieces(split, words)
        for t in texts():
            got = memoryview(pieces.of(t)).cast("i").tolist()
            assert got == [words[w] for w in split(t)]


def test_plans_hold_no_rank_table(spark):
    docs = spark.createDataFrame([(1, "some words and more"), (2, None)], "doc_id long, text string")
    coded = bpe.round_trip(docs, P.path(queries.RANKS), P.PATTERN)
    assert len(coded._jdf.queryExecution().toString()) < 100_000
