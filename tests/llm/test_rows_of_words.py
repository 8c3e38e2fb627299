"""The rows that carry words to op4_bpe's fold are small, and its words are forgotten between pieces of texts."""

import hashlib
import re

import numpy as np
import public_tokenizers as P

from barkline.llm import bpe, queries


def test_fold_rows_carry_no_rank_table(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, "more text")], "doc_id long, text string")
    got = bpe.round_trip(docs, P.path(queries.RANKS), P.PATTERN, keep=["doc_id"])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    sent = [line for line in plan.split("\n") if re.search(r"MapInArrow number", line)]
    assert sent and not any("rank_" in line for line in sent)
    assert plan.count("Join Cross") == 1


def test_texts_of_a_piece_in_many_rows(spark, monkeypatch):
    """Rows end within a piece, words are forgotten after it; ids stay those of each word merged alone."""
    monkeypatch.setattr(bpe, "HEAD_WORDS", 5)
    monkeypatch.setattr(bpe, "CHUNK", 200)
    monkeypatch.setattr(bpe, "FRESH", 400)
    monkeypatch.setattr(bpe, "KEPT", 60)
    texts = {i: " ".join(f"wq{(i * 7 + k * k) % 211}zx" for k in range(i % 40)) for i in range(300)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    ranks = bpe.load_ranks(P.path(queries.RANKS))
    got = bpe.round_trip(docs, P.path(queries.RANKS), P.PATTERN, keep=["doc_id"]).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        words = re.findall(r" ?[a-z]+| ?[0-9]+", texts[r["doc_id"]])
        ids = np.array([i for w in words for i in ([ranks[w.encode()]] if w.encode() in ranks else bpe.merge_long(w.encode(), ranks))], "<u4")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
