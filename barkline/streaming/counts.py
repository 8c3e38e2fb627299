"""Barcode tallies over arriving reads, with Structured Streaming.

An extension: the batch operators' tallies, kept up to date as files arrive in a folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barkline.functions.sequences import is_primary

READS = "read_id bigint, region string, umi string, start bigint, flag int"


def arriving(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Reads of Parquet files as they arrive."""
    return spark.readStream.schema(READS).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def counts(reads: DataFrame) -> DataFrame:
    """The tally of each (region, barcode); state is one row a barcode."""
    return reads.where(is_primary(F.col("flag"))).groupBy("region", "umi").agg(F.count(F.lit(1)).alias("n"), F.min("read_id").alias("first_seen"))


def keep_counts(reads: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Write the tallies of all arrived reads to an in-memory table until no file is left."""
    return counts(reads).writeStream.outputMode("complete").format("memory").queryName(table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
