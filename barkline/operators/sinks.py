"""Result files. Every sink writes a folder of part files, so it works at any size.

Results of regions are partitions of a folder, ``region=...``. Writing some regions replaces theirs and leaves
those of other regions, also where several jobs write to one folder at once.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from barkline.functions.sequences import contig_order, pair_text


def _region_files(rows: DataFrame, path: str, regions: list[str]) -> dict[str, list[str]]:
    """Folder of each of ``regions`` that has one -> the names of its files."""
    sc = rows.sparkSession.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(sc._jsc.hadoopConfiguration())
    if not regions or not fs.exists(at):
        return {}
    found = {unquote(f.getPath().getName().removeprefix("region=")): f.getPath() for f in fs.listStatus(at) if f.isDirectory()}
    return {found[r].toString(): sorted(f.getPath().getName() for f in fs.listStatus(found[r])) for r in regions if r in found}


def by_region(rows: DataFrame, path: str, regions: list[str] | None, save: Callable[[DataFrameWriter], None]) -> None:
    """Write ``rows`` in a partition a region, in place of what these regions had.

    Spark stages the partitions in a folder of the job's own and moves each to its place, so jobs for other
    regions don't meet. A region among ``regions`` that has no rows now loses its files: those that are
    the same after the write are old, as each write names its files anew.
    """
    before = _region_files(rows, path, regions or [])
    save(rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("region"))
    after = _region_files(rows, path, regions or [])
    sc = rows.sparkSession.sparkContext
    for folder in (f for f, names in before.items() if after.get(f) == names):
        at = sc._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def tsv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, sep="\t", header=header, quote="", emptyValue="")


def fastq(reads: DataFrame, read: str, path: str) -> None:
    """Four lines a read, compressed, in the order of the input within each part."""
    r = F.col(read)
    text = F.concat_ws("\n", r["name"], r["seq"], r["plus"], r["qual"])
    reads.repartitionByRange("ord").sortWithinPartitions("ord").select(text.alias("value")).write.mode("overwrite").text(path, compression="gzip")


def json_rows(df: DataFrame, path: str) -> None:
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def datafile(summary: DataFrame, path: str, regions: list[str] | None = None) -> None:
    """A row a region: its place, parents, children, and their numbers."""
    part = lambda k: F.regexp_extract("region", r"^(.+):(\d+)-(\d+)$", k)
    listed = lambda c: F.concat_ws(",", F.col(c).cast("array<string>"))
    rows = summary.select(
        "region", part(1).alias("CHR"), part(2).alias("START"), part(3).alias("END"), F.col("ptu").alias("PTU"), F.col("ctu").alias("CTU"),
        listed("child_nums").alias("CHILD_NUMS"), listed("freq_parents").alias("FREQ_PARENTS"),
    )
    by_region(rows, path, regions, lambda w: w.csv(path, sep="\t", header=True, quote="", emptyValue=""))


def families_json(groups: DataFrame, families: DataFrame, path: str, regions: list[str] | None = None) -> None:
    """One row a (region, umi), partitioned by region: parent and positions, keys sorted."""
    at = F.struct(F.concat(F.split("region", ":")[0], F.lit(":"), F.col("fam_pos").cast("string")).alias("k"), F.col("fam_n").alias("v"))
    lists = families.groupBy("region", "parent").agg(F.map_from_entries(F.array_sort(F.collect_list(at))).alias("positions"))
    rows = groups.join(lists, ["region", "parent"]).select("region", F.to_json(F.create_map("umi", F.struct("parent", "positions"))).alias("value"))
    by_region(rows, path, regions, lambda w: w.text(path))


def positions_json(positions: DataFrame, path: str, regions: list[str] | None = None) -> None:
    at = F.struct(F.concat(F.split("region", ":")[0], F.lit(":"), F.col("pos").cast("string")).alias("k"), F.col("n").alias("v"))
    rows = positions.groupBy("region", "parent", "umi").agg(F.map_from_entries(F.array_sort(F.collect_list(at))).alias("m"))
    by_region(rows.select("region", F.to_json(F.create_map("parent", F.create_map("umi", "m"))).alias("value")), path, regions, lambda w: w.text(path))


def mapped_counts_json(flags: DataFrame, path: str, regions: list[str] | None = None) -> None:
    """{region: {mapped, unmapped, secondary, supplementary}}, an object a region."""
    counts = F.struct("mapped", "unmapped", "secondary", "supplementary")
    by_region(flags.select("region", F.to_json(F.create_map("region", counts)).alias("value")), path, regions, lambda w: w.text(path))


def relationships(rows: DataFrame, path: str, regions: list[str] | None = None) -> None:
    named = {"umi": "Umi", "type": "Type", "count": "Count", "parent": "Parent", "distance": "Distance", "position": "Position"}
    out = rows.select("region", *[F.col(a).alias(b) for a, b in named.items()])
    by_region(out, path, regions, lambda w: w.csv(path, sep="\t", header=True))


#: The columns of a consensus file.
CONSENSUS_HEADER = (
    "CHROM", "POS", "REF", "A", "C", "G", "T", "N", "I_(ref,ins)", "I_counts", "D_(ref,del)", "D_counts", "RAWDP", "CONSDP", "FAM", "REF_FREQ", "MEAN_FAM",
)


def consensus(wide: DataFrame, path: str, regions: list[str] | None = None) -> None:
    """Consensus rows by region, sorted by position and family size; pos becomes 1-based."""
    n = lambda c: F.concat_ws(";", F.transform(c, lambda x: x["n"].cast("string")))
    columns = [
        F.split("region", ":")[0], F.col("pos") + 1, F.col("ref"), *map(F.col, "ACGTN"), pair_text(F.col("insertions")), n("insertions"),
        pair_text(F.col("deletions")), n("deletions"), F.col("rawdp"), F.col("consdp"), F.col("fam"), F.col("ref_freq"), F.col("mean_fam"),
    ]
    # ranges rather than hashes of regions, so a large region is in several files, in order
    rows = wide.repartitionByRange("region", "pos", "fam").sortWithinPartitions("region", "pos", "fam")
    rows = rows.select("region", *[c.alias(name) for c, name in zip(columns, CONSENSUS_HEADER, strict=True)])
    by_region(rows, path, regions, lambda w: w.csv(path, sep="\t", header=True))


#: The information fields of a record.
VCF_INFO = (
    ("RDP", "1", "Integer", "Raw depth"), ("CDP", "1", "Integer", "Consensus depth"), ("MIF", "1", "Integer", "Minimum family size"), ("MNF", "1", "Float", "Mean family size"),
    ("AD", "1", "Integer", "Depth of the reference allele"), ("AL", "A", "Integer", "Depth of each alternative allele"), ("AF", "A", "Float", "Share of each alternative allele"),
)


def vcf(records: DataFrame, path: str, min_depth: int, reference: str = "", source: str = "barkline") -> None:
    """VCF 4.1: header lines first, then the records in contig order, as one file, which one task sorts and writes."""
    spark = records.sparkSession
    head = ["##fileformat=VCFv4.1", f"##fileDate={time.strftime('%Y%m%d')}", f"##reference={reference}", f"##source={source}"]
    head += [f'##INFO=<ID={i},Number={n},Type={t},Description="{d}">' for i, n, t, d in VCF_INFO]
    head += [f'##FILTER=<ID=a{min_depth},Description="Fewer than {min_depth} reads of every alternative allele">', "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]
    keys = [F.lit(1).alias("part"), F.col("`#CHROM`").alias("contig"), F.col("POS").cast("bigint").alias("at"), "REF", "ALT"]
    lines = records.select(*keys, F.concat_ws("\t", *[F.col(f"`{c}`").cast("string") for c in ("#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO")]).alias("value"))
    first = spark.createDataFrame(list(enumerate(head)), "at bigint, value string").withColumn("part", F.lit(0))
    whole = first.unionByName(lines, allowMissingColumns=True)
    whole.repartition(1).sortWithinPartitions("part", *contig_order(F.col("contig")), "at", "REF", "ALT").select("value").write.mode("overwrite").text(path)


def bed(intervals: DataFrame, path: str) -> None:
    """1-based inclusive intervals, contigs in order."""
    tsv(intervals.orderBy(*contig_order(F.col("region")), "start").select("region", "start", "end"), path, header=False)


def coverage(rows: DataFrame, path: str, regions: list[str] | None = None) -> None:
    """``region: depth`` lines."""
    out = rows.select("region", F.concat("region", F.lit(": "), F.col("mean_depth").cast("string")).alias("value"))
    by_region(out, path, regions, lambda w: w.text(path))
