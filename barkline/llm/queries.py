"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, compaction, langid, mixing, neardup, ngram_join, quality, resample, rules, secrets, tokenfiles, toxicity, whitening
from .common import held_out

RANKS = "byte_bpe_multi_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", held_out(4, 2).alias("held_out"), "score", "predicted")


def op2_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.rule_verdicts(_table(spark, sf_dir, "documents"))


def op3_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep=["doc_id"])
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    named = langid.identify(docs, langid.fit(docs), keep=["doc_id"])
    return named.select("doc_id", held_out(5, 0).alias("held_out"), "lang_pred", "score")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as the last version of a store of its own holds it, and whether its shard is listed there."""
    store = compaction.shard(_table(spark, sf_dir, "documents"))
    listed = store.manifest().select("shard", F.lit(True).alias("listed"))
    rows = store.read().join(listed, "shard", "left")
    return rows.select("doc_id", "lang", "source", "n_chars", F.sha2("text", 256).alias("text_sha256"), F.coalesce("listed", F.lit(False)).alias("listed"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(_table(spark, sf_dir, "documents"), keep=["doc_id"])


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_tokenfiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokenfiles.round_trip(docs, public_tokenizers.path(TOKENIZER)).select("doc_id", "start", "n_tokens", "ids_crc32")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality, op2_rules, op3_neardup, op4_bpe, op5_langid, op6_sharding, op7_toxicity, op8_secrets, op9_mixing, op10_jaccard, op11_resample,
        op12_whitening, op13_tokenfiles,
    )
}

#: What SQL can't express (trained models, hashing of tokens, files, graph search) is tested otherwise.
ORACLE_SQL: dict[str, str] = {"op6_sharding": compaction.SQL, "op9_mixing": mixing.SQL, "op11_resample": resample.SQL}
