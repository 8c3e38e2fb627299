"""A corpus pipeline: toxicity, n-gram Jaccard join, secret scans, mixing, BPE round trip.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's ``docs``. Stages but the last return the columns of documents. As a stage's
result is written by the time the next one begins, that one drops the tables that its forerunner staged; those that
its own ``docs`` still read stay.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barkline.llm import bpe, mixing, ngram_join, secrets, toxicity
from barkline.llm.common import col, collect_garbage, drop, orderable, shared_dir, staged, staging
from barkline.llm.queries import RANKS

#: Trained models and token hashes can't be written in SQL; the stages are tested by brute force.
ORACLE_SQL = None

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Folders that stages of this thread have staged in and that are still there.
_here = threading.local()


def stage(f: Stage) -> Stage:
    """``f`` with a folder of its own for the tables that it stages; the one of the stage before goes."""

    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        done = _here.__dict__.setdefault("done", [])
        # rows that aren't written yet still read what was staged for them
        read = docs.inputFiles()
        for folder in [x for x in done if not any(f"/{x}/" in file for file in read)]:
            drop(spark, folder)
            done.remove(folder)
        # what the stage before held (a sample, a model, rank tables, grown heaps) goes before this one adds its own
        collect_garbage(spark)
        with staging(f.__name__) as folder:
            done.append(folder)
            return f(spark, docs, sf_dir)

    return run_stage


@stage
def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs.withColumnsRenamed({c: f"in_{c}" for c in docs.columns}), model, text="in_text")
    return scored.where("predicted = 0").select(*[col(f"in_{c}").alias(c) for c in docs.columns])


@stage
def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id stays of each group of near copies; rows without an id are documents too.

    Rows without words are no copies, so all of them stay.
    """
    null = F.col("doc_id").isNull()
    worded = F.coalesce(F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    least, most, count = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count_if(null & worded)).first()
    named, unnamed = docs.where(~null), None
    every = named
    if count:
        # ids of their own, after all others where there is room, so that a row with an id stays before one without
        k = F.monotonically_increasing_id()
        own = F.lit((most or 0) + 1) + k if (most or 0) < 1 << 62 else F.lit(least - 1) - k
        unnamed = staged(docs.where(null & worded).withColumn("doc_id", own), "unnamed")
        every = named.unionByName(unnamed)
    found = ngram_join.jaccard_components(every)
    kept = staged(found.where("doc_id = component_id").groupBy("doc_id").count(), "kept")
    rows = named.join(kept.where("count = 1"), "doc_id", "left_semi")
    # of the rows that carry one id the least one stays
    again = named.join(kept.where("count > 1"), "doc_id", "left_semi")
    rest = [c for c in docs.columns if c != "doc_id"]
    least_row = F.min_by(F.struct(*map(col, rest)), F.struct(*[orderable(docs, c) for c in rest])).alias("row")
    again = again.groupBy("doc_id").agg(least_row).select("doc_id", "row.*")
    out = rows.unionByName(again).unionByName(docs.where(null & ~worded))
    if unnamed is not None:
        alone = unnamed.join(kept, "doc_id", "left_semi").withColumn("doc_id", F.lit(None).cast(docs.schema["doc_id"].dataType))
        out = out.unionByName(alone)
    return out.select(*map(col, docs.columns))


@stage
def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced by a mark."""
    return secrets.redact(docs)


@stage
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it."""
    # columns that are named like those of the mix are carried under other names
    own = {c: f"in_{k}_{c}" for k, c in enumerate(docs.columns) if c in mixing.OUTPUTS}
    mixed = mixing.emitted(mixing.mix(docs.withColumnsRenamed(own)))
    return mixed.withColumnsRenamed({v: k for k, v in own.items()}).select(*map(col, docs.columns))


@stage
def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number and digest of the ids, digest of the decoded text."""
    coded = bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep=["doc_id"])
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", toxicity_stage),
    ("ngram_jaccard", jaccard_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, apply) in enumerate(STAGES):
        apply(spark, docs, sf_dir).write.parquet(f"{root}/{k}-{name}")
        docs = spark.read.parquet(f"{root}/{k}-{name}")
    return docs
