"""Words by array operations: equal words of a group are looked up once, with the ids of whole texts."""

import random

import numpy as np
import public_tokenizers as P
import regex
from tokenizers import Tokenizer

from barkline.llm import bpe, queries, tokenfiles

EDGES = ["", "a" * 15, "a" * 16, "a" * 15 + "\0", "\0", "\0\0", "b" * 15 + " " + "b" * 15, "it's  'll go", "x᠎ y​ z", "中" * 5 + " " + "中" * 6]


def texts():
    rng = random.Random(9)
    return EDGES + ["".join(rng.choice("abé中😀'.\n\t\x1d ​09\0    ") for _ in range(rng.randrange(120))) for _ in range(1500)] + EDGES


def test_distinct_lists_short_words_once():
    found = tokenfiles.split([t for t in texts() if not tokenfiles.changed(t)])
    raw, places, firsts = found
    words = [raw[a:b] for a, b in zip(places[:-1], places[1:])]
    assert firsts[-1] == len(words)
    listed, number = tokenfiles.distinct(raw, places)
    assert [listed[k] for k in number] == words
    short = [w for w in listed if len(w) <= 15]
    assert len(short) == len(set(short)) < len(words) / 2


def test_a_word_is_looked_up_once_a_group():
    with open(P.path(queries.TOKENIZER), "rb") as f:
        encode = tokenfiles.Encoder(f.read())

    class Counted(tokenfiles.Words):
        asked = 0

        def __getitem__(self, word):
            Counted.asked += 1
            return super().__getitem__(word)

    encode.words = Counted(encode.tokenizer)
    many = ["the same words again and again"] * 500
    assert list(encode(many)) == [encode.whole(many[0])] * 500
    assert Counted.asked < 20
    assert list(encode(texts())) == [encode.whole(t) for t in texts()]


def test_a_file_with_more_than_bytes_is_encoded_as_it_says():
    from tokenizers.normalizers import Lowercase

    with open(P.path(queries.TOKENIZER), "rb") as f:
        tokenizer = Tokenizer.from_buffer(f.read())
    tokenizer.normalizer = Lowercase()
    encode = tokenfiles.Encoder(tokenizer.to_str().encode())
    assert next(encode(["SOME Words"])) == encode.whole("some words")


def test_numbers_of_words_of_many_texts(monkeypatch):
    split = regex.compile(bpe.BYTE_LEVEL).findall
    for piece in (1 << 20, 40):
        monkeypatch.setattr(bpe, "PIECE", piece)
        monkeypatch.setattr(tokenfiles, "PIECE", piece)
        words = bpe.Numbered({}, [])
        pieces = bpe.Pieces(split, words)
        got = list(bpe.numbered(texts(), words, pieces)) + [x for t in texts() for x in bpe.numbered([t], words, pieces)]
        assert [np.frombuffer(x, np.int32).tolist() for x in got] == [[words[w] for w in split(t)] for t in texts() * 2]
        assert words.next == len({w for t in texts() for w in split(t)})


def test_words_once_in_each_task_are_in_the_dictionary(spark):
    """However many tasks share the sample, a word that each of them meets once is a frequent one."""
    docs = spark.range(8).repartition(8).selectExpr("'zqxvkw' || id || ' zqxvkwj' AS in_text")
    ranks = bpe.load_ranks(P.path(queries.RANKS))
    head, flat, sizes = bpe.head_words(docs, ranks, bpe.RankMap(ranks), P.PATTERN)
    assert {" zqxvkwj", "zqxvkw"} == set(head.to_pylist())
    ids = np.split(flat, np.cumsum(sizes)[:-1])
    assert [x.tolist() for x in ids] == [bpe.merge_long(w.encode(), ranks) for w in head.to_pylist()]
