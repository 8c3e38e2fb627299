"""Reads, pileup and FASTQ views that are derived from the lineitem, part and orders tables.

Each is one SQL text that Spark and DuckDB both run, so queries and their SQL start from equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barkline.session import durable

UMI_LENGTH = 8

_CODE = "((l_partkey % 150) * 431) % 65536"
_DIGITS = ", ".join(
    f"substr('ACGT', cast((cast(floor(({_CODE}) / {4**k}) AS bigint) + (CASE WHEN l_orderkey % 7 = 0 AND l_linenumber = {k + 1} THEN 1 ELSE 0 END)) % 4 AS int) + 1, 1)"
    for k in range(UMI_LENGTH)
)

#: Reads with barcodes, one-base errors among them, and flags.
READS = f"""
SELECT cast(l_orderkey AS bigint) * 8 + l_linenumber AS read_id,
       concat('chr', cast(1 + l_suppkey % 5 AS varchar(10))) AS region,
       1000 + (l_partkey % 150) * 7 + (cast(l_quantity AS bigint) % 4) * 6 AS start,
       concat({_DIGITS}) AS umi,
       CASE l_orderkey % 11 WHEN 3 THEN 4 WHEN 5 THEN 256 WHEN 7 THEN 2048 WHEN 9 THEN 2304 ELSE 0 END AS flag
FROM lineitem"""

#: Three bases of each read that isn't flagged, with errors and some indels.
PILEUP = f"""
SELECT read_id, region, umi, start, start + k AS pos,
       CASE WHEN m % 13 = 0 AND k = 1 THEN concat(r, 'A') ELSE r END AS ref,
       CASE WHEN m % 17 = 0 AND k = 2 THEN concat(r, 'GT')
            WHEN m % 5 = 0 THEN substr('ACGT', cast((m + k) % 4 AS int) + 1, 1) ELSE r END AS alt,
       q
FROM (SELECT v.read_id, v.region, v.umi, v.start, k.k, cast(floor(v.read_id / 8) AS bigint) AS m,
             substr('ACGT', cast((v.start + k.k) % 4 AS int) + 1, 1) AS r,
             cast((v.read_id * 7 + k.k * 3) % 50 AS int) AS q
      FROM ({READS}) v CROSS JOIN (VALUES (0), (1), (2)) AS k(k) WHERE v.flag = 0) b"""

#: Barcoded FASTQ-like reads: an 8-base barcode, a spacer that may be damaged, and a sequence.
FASTQ = f"""
SELECT read_id AS ord, concat('@r', cast(read_id AS varchar(20)), ' 1:N:0') AS name,
       concat(umi, CASE WHEN read_id % 9 = 0 THEN 'ATGCG' WHEN read_id % 4 = 0 THEN 'atgGG' ELSE 'ATGGG' END, umi, 'ACGT') AS seq,
       '+' AS plus, concat('IIIIIIIIIIIII', 'FFFFFFFF', '####') AS qual
FROM ({READS}) v"""


def _run(spark: SparkSession, sf_dir: str, sql: str, stage: bool = True) -> DataFrame:
    """The rows of a view, staged: a barcode's expression is long, and plans that read a view several times, or filter and
    join by it, would repeat it. A plan that only groups a view once does without."""
    rows = spark.sql(sql.replace("FROM lineitem", "FROM {lineitem}"), lineitem=spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    return durable(rows) if stage else rows


def reads(spark: SparkSession, sf_dir: str, stage: bool = True) -> DataFrame:
    """Reads with the columns that the operators expect; a read spans 30 positions."""
    return _run(spark, sf_dir, READS, stage).withColumns({"end": F.col("start") + 30, "region_start": F.lit(1005), "region_end": F.lit(2000)})


def pileup(spark: SparkSession, sf_dir: str, stage: bool = True) -> DataFrame:
    return _run(spark, sf_dir, PILEUP, stage)


def fastq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, FASTQ)
