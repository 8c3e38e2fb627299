"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Seed of everything that is drawn at random.
SEED = 20240501

#: Folder under the shared one that tables are staged in now; see ``staging``.
_folder: ContextVar[str] = ContextVar("staging_folder", default="staged")


def col(name: str) -> Column:
    """A column by its exact name (dots and backticks included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def orderable(df: DataFrame, name: str) -> Column:
    """A column, or its JSON where it holds what can't be ordered."""
    kind = df.schema[name].dataType.simpleString()
    return F.to_json(F.struct(col(name))) if "map<" in kind or "variant" in kind else col(name)


@cache
def _own_folder(application: str) -> str:
    """A local application's own folder; the setting itself can't be changed while it runs."""
    return "file://" + tempfile.mkdtemp(prefix="spark-shared-")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the setting is missing a local master (tests) gets a folder of its own; elsewhere that is
    an error, since executors would not see a machine-local folder.
    """
    sc = spark.sparkContext
    given = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not given:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        given = _own_folder(sc.applicationId)
    return given.rstrip("/")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: cuts the lineage durably.

    The table stays as long as results may read it; ``staging`` names a folder that can be dropped.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{_folder.get()}/{label}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


@contextmanager
def staging(name: str) -> Iterator[str]:
    """Within the block tables are staged in a folder of their own, for ``drop`` once results are written."""
    folder = f"{name}-{uuid.uuid4().hex}"
    before = _folder.set(folder)
    try:
        yield folder
    finally:
        _folder.reset(before)


def drop(spark: SparkSession, folder: str) -> None:
    """Delete the tables that were staged in ``folder``; results that read them must be written."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{folder}")
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


#: Rows of an Arrow batch of whole texts.
TEXT_ROWS = 1000


def text_batches(spark: SparkSession) -> None:
    """Hold the session's Arrow batches to TEXT_ROWS rows, as these carry whole texts.

    Executors keep a batch or two a task outside the heap, and texts may be long. The setting is read when
    a plan runs, after the operator has returned, so it stays with the session.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= TEXT_ROWS:
        spark.conf.set(key, str(TEXT_ROWS))


def append_columns(
    df: DataFrame,
    fields: list[T.StructField],
    make: Callable[[], Callable[[list[str | None]], dict[str, list]]],
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Add columns computed from whole texts in Arrow batches.

    ``make()`` runs once a task and returns the function from a batch's texts to the new columns, so
    caches live as long as a task. Columns of ``df`` that carry a new column's name are replaced.
    """
    text_batches(df.sparkSession)
    names = {f.name for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    # a text that is carried anyway isn't sent twice
    carried = text in kept and isinstance(df.schema[text].dataType, T.StringType)
    # by place, as a name with a dot can't be sent to a worker
    source = df.select(*[col(c).alias(f"c{i}") for i, c in enumerate(kept)], *([] if carried else [col(text).cast("string").alias("__text_in")]))
    at = kept.index(text) if carried else len(kept)
    schema = T.StructType([T.StructField(c, f.dataType, f.nullable) for c, f in zip(kept, source.schema)] + fields)
    arrow = to_arrow_schema(T.StructType(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            # few texts at a time, so that very long ones do not add up
            for part in slices(batch):
                got = apply(part.column(at).to_pylist())
                new = [pa.array(got[f.name], type=f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(kept))] + new, names=kept + [f.name for f in fields]
                )

    return source.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory of this process to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def collect_garbage(spark: SparkSession) -> None:
    """Collect garbage on the driver, then in each executor, so that heaps shrink to what is in use.

    A heap that one step has grown stays with the executor, beside the Python workers of the next step. On an idle cluster
    a task for each core reaches each executor; where one is missed, only its heap stays as it is.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    give_back()
    n = spark.sparkContext.defaultParallelism
    collected = F.java_method(F.lit("java.lang.System"), F.lit("gc")).alias("collected")
    spark.range(0, n, 1, n).select(collected).write.format("noop").mode("overwrite").save()


def slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """A batch a few rows at a time; what Arrow has freed by its end is given back."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, bound: int, chars: int = 1 << 25
) -> DataFrame:
    """At most ``bound`` labelled documents (text, y) for fitting, the same ones at each run.

    Rows whose crc32(doc_id as text) mod ``modulus`` is ``held`` are never among them. The bound is
    taken in the order of a hash of the id, so it is a uniform sample of the labelled rows. Of these, texts
    of more than a 64th of ``chars`` characters are left out, and of the others, in the same order, as many are
    taken as hold ``chars`` characters together; that is 64 at least, whatever the texts.
    """
    order = F.xxhash64("doc_id", F.lit(SEED))
    ids = (
        labels.select(F.col("doc_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull())
        .where(F.crc32(F.col("doc_id").cast("string")) % modulus != held)
        .groupBy("doc_id").agg(F.max("y").alias("y"))
        .orderBy(order, "doc_id").limit(bound)
    )
    docs = documents.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    # of rows that repeat an id the least text is taken, so the sample has at most ``bound`` rows
    found = docs.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    upto = Window.orderBy(order, "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    found = found.where(F.length("text") <= chars // 64)
    return found.withColumn("upto", F.sum(F.length("text")).over(upto)).where(F.col("upto") <= chars).select("text", "y")


def held_out(modulus: int, remainder: int) -> Column:
    """Whether crc32(doc_id as text) mod ``modulus`` is ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == remainder, F.lit(False))


_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit numbers with their bits mixed."""
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ h >> np.uint64(32)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ h >> np.uint64(29)


def char_grams(words: list[str], least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words' marked n-grams of ``least`` (1 or 2) to 4 characters and of the whole words, and the
    place of the word that each belongs to."""
    marked = [f"<{w}>" for w in words]
    sizes = np.array([len(m) for m in marked])
    c = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    of = np.repeat(np.arange(len(words)), sizes)
    start = np.cumsum(sizes) - sizes
    inner = np.ones(len(c), bool)
    inner[start] = inner[start + sizes - 1] = False
    h = mixed(c)
    hashes, owner = ([h[inner]], [of[inner]]) if least == 1 else ([], [])
    left = np.repeat(start + sizes, sizes) - np.arange(len(c))
    for n in (2, 3, 4):
        h = mixed(h[:-1] * _STEP + c[n - 1 :])
        whole = left[: len(h)] >= n
        hashes.append(h[whole])
        owner.append(of[: len(h)][whole])
    # a word is the sum of its characters' products with the powers of its places
    powers = np.cumprod(np.full(int(sizes.max()), _STEP, np.uint64))
    hashes.append(mixed(np.add.reduceat(c * powers[np.arange(len(c)) - start[of]], start) ^ _STEP))
    owner.append(np.arange(len(words)))
    return np.concatenate(hashes), np.concatenate(owner)
