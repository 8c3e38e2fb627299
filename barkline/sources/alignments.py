"""SAM text and BAM files as tables of aligned reads, and FASTQ files as tables of reads.

Columns of alignments: read_id, qname, flag, contig, start (0-based), end (exclusive), cigar, md, seq,
qual (array of ints). SAM and FASTQ are Spark's text; BAM is a Python data source (``barkline.sources.bam``). All split.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barkline.session import durable
from barkline.sources.bam import BamSource


def sam(spark: SparkSession, path: str) -> DataFrame:
    """Aligned reads of SAM text; header lines are skipped; read_id follows the order of lines."""
    f = F.split("value", "\t")
    lines = spark.read.text(path).where(~F.startswith("value", F.lit("@"))).withColumn("read_id", F.monotonically_increasing_id())
    cigar, seq, qual = f[5], f[9], f[10]
    span = F.aggregate(
        F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), 1), F.lit(0).cast("bigint"), lambda acc, n: acc + n.cast("bigint")
    )
    codes = F.when(qual == "*", F.array().cast("array<int>")).otherwise(F.transform(F.filter(F.split(qual, ""), lambda c: c != ""), lambda c: F.ascii(c) - 33))
    start = f[3].cast("bigint") - 1
    return lines.select(
        "read_id", f[0].alias("qname"), f[1].cast("int").alias("flag"), F.nullif(f[2], F.lit("*")).alias("contig"), start.alias("start"),
        (start + span).alias("end"), cigar.alias("cigar"), F.nullif(F.regexp_extract("value", r"\tMD:Z:(\S+)", 1), F.lit("")).alias("md"), seq.alias("seq"), codes.alias("qual"),
    )


def sam_contigs(spark: SparkSession, path: str) -> DataFrame:
    """(contig, length) from the header of SAM text."""
    rows = spark.read.text(path).where(F.startswith("value", F.lit("@SQ")))
    return rows.select(F.regexp_extract("value", r"\tSN:(\S+)", 1).alias("contig"), F.regexp_extract("value", r"\tLN:(\d+)", 1).cast("bigint").alias("length"))


def bam(spark: SparkSession, path: str, regions: DataFrame | None = None, split_bytes: int | None = None, pushdown: bool = False) -> DataFrame:
    """Aligned reads of BAM files; where there is an index, only the chunks of ``regions`` (contig, start, end), a list
    of targets, are read. Rows outside of ``regions`` may be among the result.

    With ``pushdown`` (and spark.sql.python.filterPushdown.enabled) filters on contig, start and end narrow the read as
    well. Spark 4.1 keeps what was pushed with the loaded relation, so such a DataFrame serves one query; load another one for the next.
    """
    spark.dataSource.register(BamSource)
    reader = spark.read.format("bam").option("pushdown", str(pushdown).lower())
    if split_bytes:
        reader = reader.option("split_bytes", str(split_bytes))
    if regions is not None:
        reader = reader.option("regions", json.dumps([list(r) for r in regions.select("contig", "start", "end").toLocalIterator()]))
    return reader.load(path)


def bam_contigs(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(BamSource)
    return spark.read.format("bam").option("part", "header").load(path)


#: Lines of a FASTQ record, and the fields that they fill.
LINES = 4
FIELDS = ("name", "seq", "plus", "qual")


def _numbered(lines: DataFrame) -> DataFrame:
    """(file, block, line, ord, border) for each split: the number of its first line in the file, the records of
    all files before, and the lines of the record that begins in it and ends behind it, if there is one.

    Splits are counted in one pass, which keeps their first and last lines; the windows have a row a split.
    """
    few = LINES - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, tuple] = {}
        for batch in batches:
            for key, at, n in _runs(batch):
                count, head, tail = found.get(key, (0, [], []))
                values = batch.column(2)
                if len(head) < few:
                    head = (head + values.slice(at, min(n, few)).to_pylist())[:few]
                found[key] = count + n, head, (tail + values.slice(at + max(0, n - few), min(n, few)).to_pylist())[-few:]
        text = pa.list_(pa.string())
        kinds = (pa.string(), pa.int64(), pa.int64(), text, text)
        rows = [(*key, *value) for key, value in found.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["file", "block", "n", "head", "tail"])

    counted = durable(lines.mapInArrow(run, "file string, block bigint, n bigint, head array<string>, tail array<string>"))
    here = Window.partitionBy("file").orderBy("block")
    before = Window.unboundedPreceding
    files = counted.groupBy("file").agg(F.ceil(F.sum("n") / LINES).alias("records"))
    files = files.select("file", (F.sum("records").over(Window.orderBy("file").rowsBetween(before, 0)) - F.col("records")).alias("ord"))
    after = F.concat(*[F.coalesce(F.lead("head", k).over(here), F.array().cast("array<string>")) for k in range(1, LINES)])
    splits = counted.withColumns({"line": F.sum("n").over(here.rowsBetween(before, 0)) - F.col("n"), "after": after})
    left = ((F.col("line") + F.col("n")) % LINES).cast("int")
    border = F.when((left > 0) & (F.col("n") >= left), F.slice(F.concat(F.slice("tail", -left, left), "after"), 1, LINES))
    return splits.select("file", "block", "line", (F.col("line") + F.col("n") - left).alias("border_line"), border.alias("border")).join(files, "file")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int, int]]:
    """((file, block), first row, rows) of the runs of rows that one split gave."""
    codes = [batch.column(k).dictionary_encode().indices.to_numpy() for k in (0, 1)]
    at = np.flatnonzero(np.concatenate([[True], (codes[0][1:] != codes[0][:-1]) | (codes[1][1:] != codes[1][:-1])])) if batch.num_rows else []
    for a, b in pairwise([*at, batch.num_rows]):
        yield (batch.column(0)[int(a)].as_py(), batch.column(1)[int(a)].as_py()), int(a), int(b - a)


def fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(ord, name, seq, plus, qual) of FASTQ files; ord is the read's number over all files, in the order of their paths.

    Files are Spark's text, so they split (compressed ones don't), and any path that Spark reads will do. A first
    pass counts the lines of each split; their running sums tell which line begins a record. Records within a
    split are put together there; one that lies across splits comes from the lines which the first
    pass kept. So the rows are the same however files are split. A last record that lacks lines has nulls.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    splits = _numbered(lines)
    schema = "ord bigint, name string, seq string, plus string, qual string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, number, before, held = None, 0, 0, []
        for batch in batches:
            for key, at, n in _runs(batch):
                if key != split:
                    split, held = key, []
                    number, before = batch.column(3)[at].as_py(), batch.column(4)[at].as_py()
                values = batch.column(2).slice(at, n).to_pylist()
                if not held:
                    # lines of a record that began in an earlier split
                    skip = min(-number % LINES, len(values))
                    values, number = values[skip:], number + skip
                first, values = number - len(held), held + values
                whole = len(values) // LINES
                if whole:
                    ords = pa.array(np.arange(whole) + before + first // LINES)
                    yield pa.RecordBatch.from_arrays([ords, *[pa.array(values[k : whole * LINES : LINES], pa.string()) for k in range(LINES)]], names=["ord", *FIELDS])
                held = values[whole * LINES :]
                number = first + len(values)

    # a row a split, so the side that is sent to all tasks is as small as the listing of splits
    within = lines.join(F.broadcast(splits), ["file", "block"]).select("file", "block", "value", "line", "ord").mapInArrow(run, schema)
    fields = [F.get("border", F.lit(k)).alias(name) for k, name in enumerate(FIELDS)]
    across = splits.where("border IS NOT NULL").select((F.col("ord") + F.floor(F.col("border_line") / LINES)).alias("ord"), *fields)
    return within.unionByName(across)
