"""Nearest families, allele counts, consensus alleles by family size, coverage.

The pileup is (region, pos, read_id, umi, start, ref, alt, q): one row for each base of a read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barkline.functions.sequences import BASES, known_base, percent
from barkline.session import durable


def nearest_family(reads: DataFrame, groups: DataFrame, families: DataFrame) -> DataFrame:
    """Reads with parent and the nearest family of the parent: fam_pos, fam_n, dist.

    Ties: the family with more reads, then the larger position. The family is found once for each start of a
    barcode, however many rows (reads, or bases of a pileup) have it, and staged, so that the join with the rows is
    planned by its true size.
    """
    lists = families.groupBy("region", "parent").agg(F.collect_list(F.struct("fam_pos", "fam_n")).alias("list"))
    of_umi = groups.join(lists, ["region", "parent"]).select("region", "umi", "parent", "list")
    near = F.array_min(F.transform("list", lambda f: F.struct(F.abs(f["fam_pos"] - F.col("start")).alias("dist"), (-f["fam_n"]).alias("n"), (-f["fam_pos"]).alias("p"))))
    starts = reads.select("region", "umi", "start").distinct().join(of_umi, ["region", "umi"]).withColumn("near", near)
    found = starts.select("region", "umi", "start", "parent", F.col("near.dist").alias("dist"), (-F.col("near.p")).alias("fam_pos"), (-F.col("near.n")).alias("fam_n"))
    return reads.join(durable(found), ["region", "umi", "start"])


def family_allele_counts(pileup: DataFrame, groups: DataFrame, families: DataFrame, quality: int = 25, threshold: int = 10) -> DataFrame:
    """(region, pos, parent, fam_pos, fam_n, dist, ref, alt, n) of bases of good quality near a family."""
    return family_alleles(durable(base_counts(pileup, quality)), groups, families, threshold)


def base_counts(pileup: DataFrame, quality: int = 25) -> DataFrame:
    """(region, umi, start, pos, ref, alt, n) of bases of good quality: all that alleles need of a pileup.

    Reads of a barcode and start share family and distance, so equal bases of them are one row before any join.
    """
    return pileup.where(F.col("q") >= quality).groupBy("region", "umi", "start", "pos", "ref", "alt").agg(F.count(F.lit(1)).alias("n"))


def family_alleles(bases: DataFrame, groups: DataFrame, families: DataFrame, threshold: int = 10) -> DataFrame:
    """``family_allele_counts`` from ``base_counts``, which are read twice."""
    near = nearest_family(bases, groups, families).where(F.col("dist") <= threshold)
    return near.groupBy("region", "pos", "parent", "fam_pos", "fam_n", "dist", "ref", "alt").agg(F.sum("n").alias("n"))


def uncollapsed_alleles(pileup: DataFrame, quality: int = 25) -> DataFrame:
    """(region, pos, ref, alt, n) of bases of good quality, barcodes aside."""
    return pileup.where(F.col("q") >= quality).groupBy("region", "pos", "ref", "alt").agg(F.count(F.lit(1)).alias("n"))


def all_alleles(bases: DataFrame) -> DataFrame:
    """``uncollapsed_alleles`` from ``base_counts``."""
    return bases.groupBy("region", "pos", "ref", "alt").agg(F.sum("n").alias("n"))


def consensus(alleles: DataFrame, sizes: list[int], percent_threshold: float = 50.0, count_threshold: int = 1) -> DataFrame:
    """(region, pos, fam, ref, alt, n, rawdp, consdp) for every family size at once.

    A family's top allele (ties: ref, then alt) counts once where it has the share and the count that
    the thresholds ask for. rawdp sums the reads of all families of the size, consdp the families that
    count. Allele counts are made once; a size is an exploded column behind the first aggregation.
    """
    per = alleles.groupBy("region", "pos", "parent", "fam_pos", "fam_n", "ref", "alt").agg(F.sum("n").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("m"), "ref", "alt")).alias("best")
    family = per.groupBy("region", "pos", "parent", "fam_pos", "fam_n").agg(F.sum("n").alias("reads"), best)
    top = -F.col("best.m")
    family = family.withColumn("passes", (percent(top, F.col("reads")) >= percent_threshold) & (top >= count_threshold))
    sized = family.withColumn("fam", F.explode(F.array(*[F.lit(s) for s in sizes]))).where(F.col("fam_n") >= F.col("fam"))
    allele = sized.groupBy("region", "pos", "fam", "best.ref", "best.alt").agg(F.count_if("passes").alias("n"), F.sum("reads").alias("reads"))
    at = Window.partitionBy("region", "pos", "fam")
    out = allele.withColumns({"rawdp": F.sum("reads").over(at), "consdp": F.sum("n").over(at)})
    return out.where("n > 0").select("region", "pos", "fam", "ref", "alt", "n", "rawdp", "consdp")


def uncollapsed(alleles: DataFrame) -> DataFrame:
    """The same columns at family size 0: every base counts."""
    at = Window.partitionBy("region", "pos")
    depth = F.sum("n").over(at)
    return alleles.select("region", "pos", F.lit(0).alias("fam"), "ref", "alt", "n", depth.alias("rawdp"), depth.alias("consdp"))


def family_sizes(alleles: DataFrame, sizes: list[int]) -> DataFrame:
    """(region, pos, fam, min_fam, mean_fam) over distinct (parent, distance) at a position."""
    per = alleles.groupBy("region", "pos", "parent", "dist").agg(F.max("fam_n").alias("fam_n"))
    sized = per.withColumn("fam", F.explode(F.array(*[F.lit(s) for s in sizes]))).where(F.col("fam_n") >= F.col("fam"))
    return sized.groupBy("region", "pos", "fam").agg(F.min("fam_n").alias("min_fam"), F.avg("fam_n").alias("mean_fam"))


def with_mean_family(calls: DataFrame, sizes: DataFrame) -> DataFrame:
    """Calls with the mean family size of their position and size; 0 at size 0."""
    return calls.join(sizes.select("region", "pos", "fam", "mean_fam"), ["region", "pos", "fam"], "left").withColumn("mean_fam", F.coalesce("mean_fam", F.lit(0.0)))


def consensus_wide(calls: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """One row a (region, pos, fam): base counts, indel lists, depths, ref share and family size.

    Alleles of one letter on both sides are bases; a longer alt is an insertion, a longer ref a
    deletion. Indel lists are ordered by (count, allele).
    """
    one = (F.length("ref") == 1) & (F.length("alt") == 1)
    letter = known_base(F.col("alt"))
    counts = [F.sum(F.when(one & (letter == b), F.col("n")).otherwise(0)).alias(b) for b in BASES]

    def listed(long: str):
        return F.array_sort(F.collect_list(F.when(F.length(long) > 1, F.struct("n", "ref", "alt"))))

    is_ref = F.upper("alt") == F.upper("ref")
    out = calls.groupBy("region", "pos", "fam").agg(
        F.min(F.upper(F.substring("ref", 1, 1))).alias("ref"), *counts, listed("alt").alias("insertions"), listed("ref").alias("deletions"),
        F.max("rawdp").alias("rawdp"), F.max("consdp").alias("consdp"), F.sum(F.when(is_ref & one, F.col("n")).otherwise(0)).alias("ref_n"),
    )
    out = out.withColumn("ref_freq", percent(F.col("ref_n"), F.col("consdp"))).drop("ref_n")
    if sizes is None:
        return out
    return out.join(sizes.select("region", "pos", "fam", "mean_fam"), ["region", "pos", "fam"], "left").withColumn("mean_fam", F.coalesce("mean_fam", F.lit(0.0)))


def depths(pileup: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(region, pos, depth); ``max_depth`` caps the reads of a column as the depth option does."""
    out = pileup.groupBy("region", "pos").agg(F.count(F.lit(1)).alias("depth"))
    return out if max_depth is None else out.withColumn("depth", F.least("depth", F.lit(max_depth)))


def mean_coverage(pileup: DataFrame, quality: int = 25) -> DataFrame:
    """(region, mean_depth): mean over positions of the bases of good quality."""
    per = pileup.groupBy("region", "pos").agg(F.count_if(F.col("q") >= quality).alias("depth"))
    return per.groupBy("region").agg(F.avg("depth").alias("mean_depth"))


def running_coverage(pileup: DataFrame, quality: int = 25) -> DataFrame:
    """(region, mean_depth) as the mean of a running count over the reads of each column (quirk).

    Rows of equal read_id stand in the order of their quality, barcode and start, so ties don't matter.
    """
    w = Window.partitionBy("region", "pos").orderBy("read_id", "q", "umi", "start").rowsBetween(Window.unboundedPreceding, 0)
    run = pileup.withColumn("run", F.sum((F.col("q") >= quality).cast("bigint")).over(w))
    return run.groupBy("region").agg(F.avg("run").alias("mean_depth"))


def islands(depth: DataFrame, min_depth: int, min_size: int = 1) -> DataFrame:
    """(region, start, end): runs of adjacent positions of at least ``min_depth``, 1-based inclusive.

    Runs are found within bins of ``BIN`` positions, then joined where they touch at bin borders, so
    a contig isn't sorted in one task.
    """
    deep = depth.where(F.col("depth") >= min_depth).withColumn("bin", F.floor(F.col("pos") / BIN))
    in_bin = Window.partitionBy("region", "bin").orderBy("pos")
    runs = deep.withColumn("k", F.col("pos") - F.row_number().over(in_bin)).groupBy("region", "bin", "k").agg(F.min("pos").alias("a"), F.max("pos").alias("b"))
    return joined_runs(runs, min_size)


def joined_runs(runs: DataFrame, min_size: int) -> DataFrame:
    """(region, start, end) of runs (region, bin, a, b) joined where they touch at bin borders, 1-based inclusive.

    Only runs that touch a border of their bin are sorted together, at most two a bin; the others are whole.
    """
    low, high = F.col("a") == F.col("bin") * BIN, F.col("b") == (F.col("bin") + 1) * BIN - 1
    inner = runs.where(~low & ~high).select("region", "a", (F.col("b") + 1).alias("b"))
    by = Window.partitionBy("region").orderBy("a")
    edge = runs.where(low | high).withColumn("new", F.coalesce((F.col("a") > F.lag("b").over(by) + 1).cast("int"), F.lit(1)))
    edge = edge.withColumn("island", F.sum("new").over(by)).groupBy("region", "island").agg(F.min("a").alias("a"), (F.max("b") + 1).alias("b")).drop("island")
    return inner.unionByName(edge).where(F.col("b") - F.col("a") >= min_size).select("region", (F.col("a") + 1).alias("start"), F.col("b").alias("end"))


#: Positions of a bin of the island search.
BIN = 100_000
