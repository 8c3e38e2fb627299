"""Sharding by size-tiered compaction with a versioned manifest; DataFrame functions only.

``append`` writes arrivals as small immutable shards and commits a manifest that lists them.
``compact`` merges runs of similar size (one tier) into files near the target size and commits the
next manifest. A manifest is a table, written aside; a version is one small file ``manifest/vNNNNNN``
that names it. That file is written aside too and then moved to its name by an operation that fails if
the name is taken: a rename without overwriting, or a hard link on a local file system, where renames
overwrite. So a version is whole or absent, of two writers one gets it and the other a ``Conflict``, and
readers of older versions keep their files until ``expire`` is called.

Plan: a shard's tier is the power of ``fan_in`` by which its bytes exceed the smallest size. The
prefix sum of bytes within a tier cuts the tier's runs into merge groups of the target size; groups
of one run are left alone. Only the list of shards is windowed, never the documents. A merge group is
a task of its own, which reads the group's shards and writes the new one, so nothing is shuffled.

The list of shards passes the driver where files are read, as a listing of files does; documents never do.

Edge cases: an empty table commits a version without shards, from which an empty table of the same
columns is read; nulls, ties, empty and very long texts, repeated rows and any extra columns are stored
as they are (columns named ``shard`` or ``shard_bytes`` are kept under a leading underscore); a source
that holds most rows doesn't matter, since shards are dealt by size.
"""

from __future__ import annotations

import re
import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import col, shared_dir

#: Bytes of a finished shard.
TARGET = 256 << 20
#: Bytes up to which a shard is in tier 0.
SMALLEST = 4 << 20
#: Factor between tiers.
FAN_IN = 4
#: Rows of one file of an arrival at most.
ARRIVAL_ROWS = 20_000
#: Parts that ``shard`` takes a table in.
ARRIVALS = 3

#: Merge groups of one job.
JOB_GROUPS = 64

MANIFEST = "shard string, bytes bigint, tier int"


class Conflict(RuntimeError):
    """Another writer committed the version first; plan again from the latest one."""


class ShardStore:
    """A folder of immutable shards with versioned manifests."""

    def __init__(self, spark: SparkSession, root: str, target: int = TARGET, smallest: int = SMALLEST, fan_in: int = FAN_IN):
        self.spark, self.root = spark, root.rstrip("/")
        self.target, self.smallest, self.fan_in = target, smallest, fan_in

    # -- files ---------------------------------------------------------------------------------
    def _fs(self, path: str):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def version(self) -> int:
        """The latest committed version; 0 before the first."""
        fs, at = self._fs(f"{self.root}/manifest")
        if not fs.exists(at):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        return max([int(n[1:]) for n in names if re.fullmatch(r"v\d+", n)], default=0)

    def _sizes(self, folder: str) -> DataFrame:
        """(shard, bytes) of the data files in a folder, from the listing alone."""
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(folder)
        return files.select(F.col("path").alias("shard"), F.col("length").alias("bytes"))

    def _tiered(self, sizes: DataFrame) -> DataFrame:
        over = F.greatest(F.col("bytes").cast("double") / self.smallest, F.lit(1.0))
        return sizes.select("shard", "bytes", F.floor(F.log(float(self.fan_in), over)).cast("int").alias("tier"))

    def _commit(self, manifest: DataFrame, version: int) -> int:
        jvm = self.spark.sparkContext._jvm
        name = uuid.uuid4().hex
        table = f"{self.root}/lists/{name}"
        manifest.select("shard", "bytes", "tier").coalesce(1).write.parquet(table)
        fs, aside = self._fs(f"{self.root}/staging/{name}")
        out = fs.create(aside, False)
        out.write(bytearray(name.encode()))
        out.close()
        to = self._fs(f"{self.root}/manifest/v{version:06d}")[1]
        fs.mkdirs(to.getParent())
        try:
            if fs.getScheme() == "file":
                paths = [jvm.java.nio.file.Path.of(p.toUri().getPath(), self.spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0)) for p in (to, aside)]
                jvm.java.nio.file.Files.createLink(*paths)
            else:
                conf = self.spark.sparkContext._jsc.hadoopConfiguration()
                options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), conf).rename(aside, to, options)
        except Py4JJavaError as error:
            if not fs.exists(to):
                raise
            fs.delete(self._fs(table)[1], True)
            raise Conflict(f"version {version} exists") from error
        finally:
            fs.delete(aside, False)
        return version

    # -- operations ----------------------------------------------------------------------------
    def _list(self, version: int) -> str:
        """The folder of a version's manifest."""
        fs, at = self._fs(f"{self.root}/manifest/v{version:06d}")
        stream = fs.open(at)
        try:
            return f"{self.root}/lists/{self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, 'UTF-8')}"
        finally:
            stream.close()

    def manifest(self, version: int | None = None) -> DataFrame:
        v = self.version() if version is None else version
        if not v:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(self._list(v))

    def append(self, df: DataFrame) -> int:
        """Write ``df`` as it is partitioned, a few small shards a task, and commit them."""
        v = self.version()
        folder = f"{self.root}/data/a{v + 1:06d}-{uuid.uuid4().hex[:8]}"
        safe = df.select(*[col(c).alias(f"_{c}" if c in ("shard", "shard_bytes") else c) for c in df.columns])
        safe.write.option("maxRecordsPerFile", ARRIVAL_ROWS).option("compression", "zstd").parquet(folder)
        fs, at = self._fs(f"{self.root}/schema")
        if not fs.exists(at):
            safe.limit(0).write.mode("overwrite").parquet(f"{self.root}/schema")
        return self._commit(self.manifest(v).unionByName(self._tiered(self._sizes(folder))), v + 1)

    def plan(self, version: int | None = None) -> DataFrame:
        """(shard, bytes, tier, bin): the runs to merge; runs of one bin become one shard.

        Runs below the target are cut within their tier at multiples of the target in the prefix sum
        of bytes. A tier merges when it holds ``fan_in`` runs, or when all that is left is smaller.
        """
        runs = self.manifest(version).where(F.col("bytes") < self.target)
        in_tier = Window.partitionBy("tier").orderBy("bytes", "shard")
        cut = F.floor((F.sum("bytes").over(in_tier.rowsBetween(Window.unboundedPreceding, 0)) - 1) / self.target)
        cut = runs.withColumn("cut", cut).withColumn("bin", F.concat_ws("-", "tier", "cut"))
        whole = Window.partitionBy("bin")
        cut = cut.withColumn("runs", F.count(F.lit(1)).over(whole)).withColumn("sum", F.sum("bytes").over(whole))
        # a group is worth a merge when it fills a file or holds fan_in runs of its tier
        return cut.where((F.col("runs") > 1) & ((F.col("runs") >= self.fan_in) | (F.col("sum") >= self.target // 2))).select("shard", "bytes", "tier", "bin")

    def compact(self) -> int:
        """Merge each planned group into one file and commit; the version is unchanged if none is."""
        v = self.version()
        planned = self.plan(v)
        bins: dict[str, list[str]] = {}
        for r in planned.select("shard", "bin").toLocalIterator():
            bins.setdefault(r["bin"], []).append(r["shard"])
        if not bins:
            return v
        folder = f"{self.root}/data/c{v + 1:06d}-{uuid.uuid4().hex[:8]}"
        none = self.spark.read.parquet(f"{self.root}/schema")
        groups = list(bins.values())
        for at in range(0, len(groups), JOB_GROUPS):
            whole = [self.spark.read.schema(none.schema).parquet(*names).coalesce(1) for names in groups[at : at + JOB_GROUPS]]
            # a union of single partitions alone would be taken as one partition; a table without rows keeps them apart
            reduce(DataFrame.union, [*whole, none]).write.mode("append").option("compression", "zstd").parquet(folder)
        kept = self.manifest(v).join(planned.select("shard"), "shard", "left_anti")
        return self._commit(kept.unionByName(self._tiered(self._sizes(folder))), v + 1)

    def read(self, version: int | None = None, only: list[str] | None = None) -> DataFrame:
        """The rows of a version (of some of its shards), with shard and shard_bytes."""
        v = self.version() if version is None else version
        schema = self.spark.read.parquet(f"{self.root}/schema").schema
        shards = only if only is not None else [r["shard"] for r in self.manifest(v).select("shard").toLocalIterator()]
        if not shards:
            return self.spark.createDataFrame([], schema).withColumns({"shard": F.lit("").cast("string"), "shard_bytes": F.lit(0).cast("bigint")})
        rows = self.spark.read.schema(schema).parquet(*shards)
        return rows.withColumns({"shard": F.col("_metadata.file_path"), "shard_bytes": F.col("_metadata.file_size")})

    def expire(self, keep: int = 1) -> None:
        """Delete manifests but the last ``keep``, and the shards that only they list; on demand only."""
        last = self.version()
        have = [v for v in range(1, last + 1) if self._fs(f"{self.root}/manifest/v{v:06d}")[0].exists(self._fs(f"{self.root}/manifest/v{v:06d}")[1])]
        old, live = [v for v in have if v <= last - keep], [v for v in have if v > last - keep]
        if not old:
            return
        shards = lambda versions: reduce(DataFrame.unionByName, [self.manifest(v).select("shard") for v in versions]).distinct()
        for r in shards(old).join(shards(live), "shard", "left_anti").toLocalIterator():
            fs, at = self._fs(r["shard"])
            fs.delete(at, False)
        for v in old:
            fs, at = self._fs(self._list(v))
            fs.delete(at, True)
            fs.delete(self._fs(f"{self.root}/manifest/v{v:06d}")[1], False)


def shard(docs: DataFrame, root: str | None = None, arrivals: int = ARRIVALS, **sizes: int) -> ShardStore:
    """A store of ``docs`` that came in ``arrivals`` parts by hash of the row's id; compacted after each."""
    spark = docs.sparkSession
    store = ShardStore(spark, root or f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}", **sizes)
    for k in range(arrivals):
        at = store.append(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(arrivals)) == k))
        while (after := store.compact()) != at:
            at = after
    return store


#: The query in DuckDB's SQL: every document once, in a shard that the last manifest lists.
SQL = "SELECT doc_id, lang, source, n_chars, sha256(text) AS text_sha256, true AS listed FROM documents"
