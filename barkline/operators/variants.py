"""Variant rows from consensus alleles, their filter labels and VCF text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barkline.functions.sequences import contig_order, percent


def variants(calls: DataFrame, ref_threshold: float = 95.0, alt_threshold: float = 2.0) -> DataFrame:
    """(region, pos, fam, ref, alt, depth, freq, rawdp, consdp, ref_freq, ref_depth, mean_fam) of alternative alleles.

    Positions whose reference share is at most ``ref_threshold``; alleles other than the reference
    whose share is at least ``alt_threshold``. One window over the calls, no second pass.
    """
    at = Window.partitionBy("region", "pos", "fam")
    is_ref = F.upper("ref") == F.upper("alt")
    out = calls.withColumns({
        "ref_freq": percent(F.sum(F.when(is_ref, F.col("n")).otherwise(0)).over(at), F.col("consdp")),
        "freq": percent(F.col("n"), F.col("consdp")),
        "ref_depth": F.sum(F.when(is_ref & (F.length("ref") == 1), F.col("n")).otherwise(0)).over(at),
        "mean_fam": F.col("mean_fam") if "mean_fam" in calls.columns else F.lit(0.0),
    })
    out = out.where((F.col("ref_freq") <= ref_threshold) & ~is_ref & (F.col("freq") >= alt_threshold))
    return out.select("region", "pos", "fam", "ref", "alt", F.col("n").alias("depth"), "freq", "rawdp", "consdp", "ref_freq", "ref_depth", "mean_fam")


def labelled(found: DataFrame, min_depth: int = 10) -> DataFrame:
    """Adds filter: PASS where the allele's depth reaches ``min_depth``, else ``a<min_depth>``."""
    return found.withColumn("filter", F.when(F.col("depth") >= min_depth, "PASS").otherwise(f"a{min_depth}"))


#: Order of bases in a record.
_ORDER = "ACGTN"


def vcf_records(found: DataFrame, contig: str = "region", min_depth: int = 10) -> DataFrame:
    """One record a position and family size; SNVs share one, each indel has its own.

    Columns are those of VCF; pos is 1-based; numbers are rounded here only, where text is made. AD is the
    depth of the reference base, AL and AF are depths and shares of the alternative alleles in order.
    """
    snv = (F.length("ref") == 1) & (F.length("alt") == 1)
    alone = F.when(snv, F.lit("")).otherwise(F.concat(F.col("ref"), F.lit(">"), F.col("alt")))
    rows = F.array_sort(F.collect_list(F.struct(F.instr(F.lit(_ORDER), F.col("alt")).alias("o"), "alt", "depth", "freq")))
    out = found.groupBy(F.col(contig).alias("chrom"), "pos", "fam", "ref", alone.alias("indel")).agg(
        rows.alias("rows"), F.max("rawdp").alias("rawdp"), F.max("consdp").alias("consdp"), F.max("depth").alias("deepest"), F.max("mean_fam").alias("mean_fam"), F.max("ref_depth").alias("ref_depth"),
    )
    rounded = lambda x, k: (F.floor(x * 10**k + 0.5) / 10**k).cast("string")
    text = lambda c, f: F.concat_ws(",", F.transform(F.col(f"rows.{c}"), f))
    info = F.concat_ws(
        ";",
        F.concat(F.lit("RDP="), F.col("rawdp").cast("string")), F.concat(F.lit("CDP="), F.col("consdp").cast("string")),
        F.concat(F.lit("MIF="), F.col("fam").cast("string")), F.concat(F.lit("MNF="), rounded(F.col("mean_fam"), 2)),
        F.concat(F.lit("AD="), F.col("ref_depth").cast("string")), F.concat(F.lit("AL="), text("depth", lambda d: d.cast("string"))),
        F.concat(F.lit("AF="), text("freq", lambda x: rounded(x, 4))),
    )
    return out.select(
        F.col("chrom").alias("#CHROM"), (F.col("pos") + 1).alias("POS"), F.lit(".").alias("ID"), F.col("ref").alias("REF"), F.concat_ws(",", "rows.alt").alias("ALT"),
        F.lit("0").alias("QUAL"), F.when(F.col("deepest") >= min_depth, "PASS").otherwise(f"a{min_depth}").alias("FILTER"), info.alias("INFO"), "fam",
    )


def vcf_order(records: DataFrame) -> DataFrame:
    return records.orderBy(*contig_order(F.col("`#CHROM`")), "POS", "REF", "ALT")
