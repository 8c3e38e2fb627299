"""The aggregates behind figures and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barkline.functions.sequences import percent


def coverage_stats(depths: DataFrame, value: str = "depth") -> DataFrame:
    """(region, mean, sem): mean and standard error of the mean."""
    return depths.groupBy("region").agg(F.avg(value).alias("mean"), (F.stddev_samp(value) / F.sqrt(F.count(value).cast("double"))).alias("sem"))


def region_totals(summary: DataFrame) -> DataFrame:
    """(region, ptu, ctu, children_per_parent) from the highest; regions without parents are left out."""
    out = summary.where("ptu > 0").select("region", "ptu", "ctu", (F.col("ctu").cast("double") / F.col("ptu")).alias("children_per_parent"))
    return out.orderBy(F.col("children_per_parent").desc(), F.col("region").desc())


def low_or_high(rows: DataFrame, value: str, least: float) -> DataFrame:
    return rows.withColumn("label", F.when(F.col(value) < least, "Low").otherwise("High"))


def family_size_track(consensus: DataFrame) -> DataFrame:
    return consensus.where("fam <> 0").select("region", "fam", "pos", "mean_fam")


def parent_frequency(summary: DataFrame) -> DataFrame:
    """(region, children, share): share of parents by number of children."""
    pairs = summary.select("region", "ptu", F.explode(F.arrays_zip("child_nums", "freq_parents")).alias("x"))
    return pairs.select("region", F.col("x.child_nums").alias("children"), (F.col("x.freq_parents").cast("double") / F.col("ptu")).alias("share"))


def family_read_depth(families: DataFrame) -> DataFrame:
    """(region, parent, fam_pos, depth), each family once."""
    return families.select("region", "parent", "fam_pos", F.col("fam_n").alias("depth")).distinct()


def family_umi_size(positions: DataFrame, families: DataFrame, threshold: int = 10) -> DataFrame:
    """(region, parent, fam_pos, umis): distinct barcodes whose reads lie within a family."""
    near = positions.join(families, ["region", "parent"]).where(F.abs(F.col("pos") - F.col("fam_pos")) <= threshold)
    return near.groupBy("region", "parent", "fam_pos").agg(F.countDistinct("umi").alias("umis"))


def size_and_depth(umis: DataFrame, depth: DataFrame) -> DataFrame:
    return umis.join(depth, ["region", "parent", "fam_pos"])


def umi_occurrence(relations: DataFrame) -> DataFrame:
    """(region, umi, count, parents_only): counts of all barcodes, parents marked."""
    return relations.select("region", "umi", "count", (F.col("distance") == 0).alias("parents_only"))


def dominant_split(families: DataFrame) -> DataFrame:
    """(region, parent, fam_pos, fam_n, kind): the dominant family of a parent and the others."""
    best = families.groupBy("region", "parent").agg(F.max(F.struct("fam_n", "fam_pos")).alias("best"))
    out = families.join(best, ["region", "parent"])
    kind = F.when(F.struct("fam_n", "fam_pos") == F.col("best"), "dominant").otherwise("other").alias("kind")
    return out.select("region", "parent", "fam_pos", "fam_n", kind)


def degree_histogram(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(region, degree, nodes) of in- plus out-degree, zero-filled up to the largest degree."""
    ends = edges.select("region", F.col("src").alias("umi")).unionAll(edges.select("region", F.col("dst").alias("umi")))
    degree = ends.groupBy("region", "umi").agg(F.count(F.lit(1)).alias("degree"))
    every = nodes.select("region", "umi").join(degree, ["region", "umi"], "left").withColumn("degree", F.coalesce("degree", F.lit(0).cast("bigint")))
    seen = every.groupBy("region", "degree").agg(F.count(F.lit(1)).alias("nodes"))
    span = seen.groupBy("region").agg(F.max("degree").alias("top")).select("region", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("top"))).alias("degree"))
    return span.join(seen, ["region", "degree"], "left").withColumn("nodes", F.coalesce("nodes", F.lit(0).cast("bigint")))


def network_edges(groups: DataFrame) -> DataFrame:
    """(region, parent, child) star edges; a parent without children has a null child."""
    star = groups.where("umi <> parent").select("region", "parent", F.col("umi").alias("child"))
    alone = groups.where("umi = parent").select("region", "parent").join(star.select("region", "parent").distinct(), ["region", "parent"], "left_anti")
    return star.unionByName(alone.withColumn("child", F.lit(None).cast("string")))


def histogram(rows: DataFrame, value: str, bins: int) -> DataFrame:
    """(region, bin, low, high, n): equal-width bins between a region's extremes, the last one closed."""
    ends = rows.groupBy("region").agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))
    width = F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / bins).otherwise(F.lit(1.0 / bins))
    at = rows.join(ends, "region").withColumn("width", width)
    at = at.withColumn("bin", F.least(F.floor((F.col(value) - F.col("lo")) / F.col("width")), F.lit(bins - 1)).cast("bigint"))
    out = at.groupBy("region", "bin", "lo", "width").agg(F.count(F.lit(1)).alias("n"))
    return out.select("region", "bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("low"), (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("high"), "n")


def density(rows: DataFrame, value: str, points: int = 100) -> DataFrame:
    """(region, x, density): Gaussian kernel estimate (Scott's bandwidth) from a region's value counts.

    Values are counted first, so the work is distinct values times points, not rows.
    """
    counted = rows.groupBy("region", F.col(value).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("c"))
    s = rows.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"), F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("sd"))
    s = s.withColumn("h", F.greatest(F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)), F.lit(1e-9)))
    grid = s.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    grid = grid.withColumn("x", F.col("lo") - 3 * F.col("h") + F.col("k") * (F.col("hi") - F.col("lo") + 6 * F.col("h")) / (points - 1))
    z = (F.col("x") - F.col("v")) / F.col("h")
    out = grid.join(counted, "region").groupBy("region", "x", "n", "h").agg(F.sum(F.col("c") * F.exp(-0.5 * z * z)).alias("s"))
    return out.select("region", "x", (F.col("s") / (F.col("n") * F.col("h") * 2.5066282746310002)).alias("density"))


def correlation(rows: DataFrame, x: str, y: str) -> DataFrame:
    return rows.groupBy("region").agg(F.corr(x, y).alias("r"))


def read_proportions(totals: DataFrame) -> DataFrame:
    """Adds the share of correct and incorrect reads."""
    return totals.withColumns({"correct_pct": percent(F.col("correct"), F.col("total")), "incorrect_pct": percent(F.col("incorrect"), F.col("total"))})


def mapping_proportions(flags: DataFrame) -> DataFrame:
    other = F.col("unmapped") + F.col("secondary") + F.col("supplementary")
    return flags.withColumns({"mapped_pct": percent(F.col("mapped"), F.col("mapped") + other), "other_pct": percent(other, F.col("mapped") + other)})


def non_reference(consensus: DataFrame) -> DataFrame:
    return consensus.select("region", "fam", "pos", (100 - F.col("ref_freq")).alias("non_ref_freq"))


def consensus_depth(consensus: DataFrame) -> DataFrame:
    return consensus.select("region", "fam", "pos", F.when(F.col("fam") == 0, F.col("rawdp")).otherwise(F.col("consdp")).alias("depth"))


def filled_positions(track: DataFrame, value: str) -> DataFrame:
    """Every position at every family size of a region; 0 where a size has none."""
    pos, fam = track.select("region", "pos").distinct(), track.select("region", "fam").distinct()
    return pos.join(fam, "region").join(track.select("region", "pos", "fam", value), ["region", "pos", "fam"], "left").withColumn(value, F.coalesce(value, F.lit(0).cast(dict(track.dtypes)[value])))


def interval_sizes(regions: DataFrame) -> DataFrame:
    return regions.withColumn("size", (F.col("end") - F.col("start")).cast("double"))


def missing_figures(expected: DataFrame, existing: DataFrame) -> DataFrame:
    """(section, expected, missing) from (section, name) and the names that exist."""
    have = existing.select("name").distinct().withColumn("have", F.lit(1))
    return expected.join(have, "name", "left").groupBy("section").agg(F.count(F.lit(1)).alias("expected"), F.count_if(F.col("have").isNull()).alias("missing"))
