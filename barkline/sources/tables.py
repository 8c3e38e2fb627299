"""Intermediate and result files as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barkline.functions.sequences import text_pairs

#: Region in a file name such as ``families_chr1_5-9.json``; Hadoop cannot read names with a colon.
_NAME = r"(chr[^:_/-]+)[:_-](\d+)[-_](\d+)"

CONSENSUS = (
    "CHROM string, POS bigint, REF string, A bigint, C bigint, G bigint, T bigint, N bigint, I string, I_counts string, D string, D_counts string, "
    "RAWDP bigint, CONSDP bigint, FAM int, REF_FREQ double, MEAN_FAM double"
)
DATAFILE = "CHR string, START bigint, END bigint, PTU bigint, CTU bigint, CHILD_NUMS string, FREQ_PARENTS string"
RELATIONS = "Umi string, Type string, Count double, Parent string, Distance int, Position double"


def region_of_file() -> Column:
    """``chrN:a-b`` out of the name of the file that a row was read from; null where it has none."""
    name = F.col("_metadata.file_name")
    return F.when(name.rlike(_NAME), F.concat(F.regexp_extract(name, _NAME, 1), F.lit(":"), F.regexp_extract(name, _NAME, 2), F.lit("-"), F.regexp_extract(name, _NAME, 3)))


def region_of_folder() -> Column:
    """The region of the partition folder ``region=...`` of a row's file, else that of the file's name."""
    # a path is a URI whose folder names are escaped once more; a plus stands for itself
    plain = F.regexp_replace(F.regexp_extract("_metadata.file_path", "region=([^/]+)/", 1), r"\+", "%2B")
    return F.coalesce(F.nullif(F.try_url_decode(F.regexp_replace(F.try_url_decode(plain), r"\+", "%2B")), F.lit("")), region_of_file())


def _documents(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(region, m) of JSON region files: an object a line, as the sinks write, or one over many lines.

    The lines of a file that has one that is no object by itself are put together again.
    """
    file, region = F.col("_metadata.file_path"), region_of_folder()
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("k"))
    lines = spark.read.text(path).select(region.alias("region"), file.alias("file"), at.alias("at"), "value").where("trim(value) <> ''")
    lines = lines.withColumn("m", F.from_json("value", kind))
    over = lines.where("m IS NULL").select("file").distinct()
    whole = lines.join(over, "file", "left_semi").groupBy("file", "region").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("x"))
    whole = whole.select("region", F.from_json(F.array_join("x.value", "\n"), kind).alias("m"))
    return lines.join(over, "file", "left_anti").select("region", "m").unionByName(whole)


def bed(spark: SparkSession, path: str) -> DataFrame:
    """(contig, start, end): 0-based half-open from lines that start with chr (1-based inclusive)."""
    f = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where(F.startswith("value", F.lit("chr")) & (F.size(f) >= 3))
    return rows.select(f[0].alias("contig"), (f[1].cast("bigint") - 1).alias("start"), f[2].cast("bigint").alias("end"))


def consensus(spark: SparkSession, path: str) -> DataFrame:
    """Consensus rows; ``checked_unique`` of the caller tells whether keys repeat."""
    return spark.read.csv(path, sep="\t", header=True, schema=CONSENSUS)


def consensus_alleles(table: DataFrame) -> DataFrame:
    """(region, pos, fam, ref, alt, n, rawdp, consdp, mean_fam): the allele columns as rows, pos 0-based."""
    bases = [F.struct(F.col("REF").alias("ref"), F.lit(b).alias("alt"), F.col(b).alias("n")) for b in "ACGTN"]

    def pairs(alleles: str, counts: str) -> Column:
        found = F.filter(F.split(F.coalesce(counts, F.lit("")), ";"), lambda x: x != "")
        return F.zip_with(text_pairs(F.col(alleles)), found, lambda a, n: F.struct(a["ref"].alias("ref"), a["alt"].alias("alt"), n.cast("bigint").alias("n")))

    every = F.concat(F.array(*bases), pairs("I", "I_counts"), pairs("D", "D_counts"))
    rows = table.select("*", F.explode(every).alias("x")).where("x.n > 0")
    return rows.select(
        F.col("CHROM").alias("region"), (F.col("POS") - 1).alias("pos"), F.col("FAM").alias("fam"), "x.ref", "x.alt", "x.n",
        F.col("RAWDP").alias("rawdp"), F.col("CONSDP").alias("consdp"), F.col("MEAN_FAM").alias("mean_fam"),
    )


def _umis(spark: SparkSession, path: str) -> DataFrame:
    """(region, umi, x) out of region files: {umi: {parent, positions: {"chr:pos": count}}}."""
    return _documents(spark, path, "map<string,struct<parent:string,positions:map<string,bigint>>>").select("region", F.explode("m").alias("umi", "x"))


def umi_relations(spark: SparkSession, path: str) -> DataFrame:
    """(region, umi, parent, fam_pos, fam_n): each barcode of the region files at each position of its family."""
    rows = _umis(spark, path).select("region", "umi", F.col("x.parent").alias("parent"), F.explode_outer("x.positions").alias("at", "fam_n"))
    return rows.select("region", "umi", "parent", F.element_at(F.split("at", ":"), -1).cast("bigint").alias("fam_pos"), "fam_n")


def families_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(groups, families) out of region files: {umi: {parent, positions: {"chr:pos": count}}}."""
    umis = _umis(spark, path)
    groups = umis.select("region", "umi", F.col("x.parent").alias("parent"))
    own = umis.where("umi = x.parent").select("region", F.col("umi").alias("parent"), F.explode("x.positions").alias("at", "fam_n"))
    return groups, own.select("region", "parent", F.element_at(F.split("at", ":"), -1).cast("bigint").alias("fam_pos"), "fam_n")


def positions_json(spark: SparkSession, path: str) -> DataFrame:
    """(region, parent, umi, pos, n) out of {parent: {umi: {"chr:pos": count}}}."""
    raw = _documents(spark, path, "map<string,map<string,map<string,bigint>>>")
    rows = raw.select("region", F.explode("m").alias("parent", "a")).select("region", "parent", F.explode("a").alias("umi", "b")).select("region", "parent", "umi", F.explode("b").alias("at", "n"))
    return rows.select("region", "parent", "umi", F.element_at(F.split("at", ":"), -1).cast("bigint").alias("pos"), "n")


def mapped_counts_json(spark: SparkSession, path: str) -> DataFrame:
    """(region, mapped, unmapped, secondary, supplementary) out of {region: {mapped: ...}}."""
    raw = _documents(spark, path, "map<string,struct<mapped:bigint,unmapped:bigint,secondary:bigint,supplementary:bigint>>")
    return raw.select(F.explode("m").alias("region", "x")).select("region", "x.*")


def datafile(spark: SparkSession, path: str) -> DataFrame:
    """(region, ptu, ctu, child_nums, freq_parents) of region summaries."""
    ints = lambda c: F.transform(F.split(c, ","), lambda x: x.cast("bigint"))
    rows = spark.read.csv(path, sep="\t", header=True, schema=DATAFILE)
    name = F.concat("CHR", F.lit(":"), F.col("START").cast("string"), F.lit("-"), F.col("END").cast("string"))
    return rows.select(name.alias("region"), F.col("PTU").alias("ptu"), F.col("CTU").alias("ctu"), ints("CHILD_NUMS").alias("child_nums"), ints("FREQ_PARENTS").alias("freq_parents"))


def relations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema=RELATIONS).select(*[c.split()[0] for c in RELATIONS.split(", ")], region_of_folder().alias("region"))


def umi_counts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema="Umi string, Count bigint")


def coverage(spark: SparkSession, path: str) -> DataFrame:
    """(region, mean_depth) of ``region: value`` lines; of repeated regions the last line holds."""
    lines = spark.read.text(path).withColumn("k", F.monotonically_increasing_id())
    rows = lines.select("k", F.regexp_extract("value", r"^\s*['\"]?(.+?)['\"]?\s*:\s+(\S+)\s*$", 1).alias("region"), F.regexp_extract("value", r":\s+(\S+)\s*$", 1).try_cast("double").alias("v"))
    return rows.where("region <> '' AND v IS NOT NULL").groupBy("region").agg(F.max_by("v", "k").alias("mean_depth"))
