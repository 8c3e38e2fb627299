"""Barcode tallies, directional grouping, position families and their summaries.

Reads are (region, read_id, umi, start, end, flag); regions are a column, all are handled at once.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barkline.functions.sequences import (
    FLAG_SECONDARY, FLAG_SUPPLEMENTARY, FLAG_UNMAPPED, contained, hamming, has_flag, is_primary, slice_bounds, within,
)
from barkline.session import durable


def usable_reads(reads: DataFrame, truncate: bool = False) -> DataFrame:
    """Primary mapped reads; ``truncate`` drops those that lie inside the region (sic)."""
    kept = reads.where(is_primary(F.col("flag")))
    if truncate:
        kept = kept.where(~contained(F.col("start"), F.col("end"), F.col("region_start"), F.col("region_end")))
    return kept


def umi_counts(reads: DataFrame) -> DataFrame:
    """(region, umi, n, first_seen): reads of each barcode and the first read that carries it."""
    return reads.groupBy("region", "umi").agg(F.count(F.lit(1)).alias("n"), F.min("read_id").alias("first_seen"))


def start_counts(reads: DataFrame) -> DataFrame:
    """(region, umi, pos, n, first_seen): ``umi_counts`` by start; all that grouping needs of the reads."""
    return reads.groupBy("region", "umi", F.col("start").alias("pos")).agg(F.count(F.lit(1)).alias("n"), F.min("read_id").alias("first_seen"))


def flag_tally(reads: DataFrame) -> DataFrame:
    """(region, mapped, unmapped, secondary, supplementary); a read may count as both of the last two."""
    flag = F.col("flag")
    return reads.groupBy("region").agg(
        F.count_if(is_primary(flag)).alias("mapped"), F.count_if(has_flag(flag, FLAG_UNMAPPED)).alias("unmapped"),
        F.count_if(has_flag(flag, FLAG_SECONDARY)).alias("secondary"), F.count_if(has_flag(flag, FLAG_SUPPLEMENTARY)).alias("supplementary"),
    )


def busy_regions(reads: DataFrame, least: int = 0) -> DataFrame:
    """Regions with more than ``least`` reads of any kind."""
    return reads.groupBy("region").agg(F.count(F.lit(1)).alias("n_reads")).where(F.col("n_reads") > least)


def checked_counts(counts: DataFrame) -> DataFrame:
    """Fails at run time if the barcodes of a region differ in length."""
    lengths = counts.groupBy("region").agg(F.min(F.length("umi")).alias("a"), F.max(F.length("umi")).alias("b"))
    bad = lengths.where("a <> b").limit(1).collect()
    if bad:
        raise ValueError(f"barcodes of {bad[0]['region']} have {bad[0]['a']} to {bad[0]['b']} letters")
    return counts


def umi_edges(counts: DataFrame, length: int, distance: int = 1) -> DataFrame:
    """(region, src, dst) with Hamming distance <= ``distance`` and n_src >= 2 n_dst - 1.

    Barcodes within the distance agree in at least one of distance + 1 slices, so an equality join on
    a slice finds all pairs. A pair is kept at the first slice in which it agrees, hence once.
    """
    bounds = slice_bounds(length, distance + 1)
    pieces = F.array(*[F.substring("umi", s + 1, n) for s, n in bounds])
    sliced = counts.select("region", "umi", "n", F.posexplode(pieces).alias("k", "piece"))
    a = sliced.select("region", "k", "piece", F.col("umi").alias("src"), F.col("n").alias("n_src"))
    b = sliced.select("region", "k", "piece", F.col("umi").alias("dst"), F.col("n").alias("n_dst"))
    first = F.lit(True)
    for k, (s, n) in enumerate(bounds[:-1]):
        first = first & ((F.col("k") <= k) | (F.substring("src", s + 1, n) != F.substring("dst", s + 1, n)))
    pairs = a.join(b, ["region", "k", "piece"]).where((F.col("src") != F.col("dst")) & (F.col("n_src") >= 2 * F.col("n_dst") - 1) & first)
    return pairs.where(within(F.col("src"), F.col("dst"), bounds, distance)).select("region", "src", "dst")


#: Rounds before labels jump, and copies of a row that many barcodes of a giant group look up.
PLAIN_ROUNDS, SALTS = 4, 16


def umi_groups(counts: DataFrame, edges: DataFrame) -> DataFrame:
    """(region, umi, parent): parent is the highest ranked barcode from which an edge path leads here.

    Rank is (n descending, first_seen, umi). Each round sends the labels that changed in the round before along
    their edges. Changes are a log of small tables; as labels only get better, a barcode's label is the least
    that the log has for it. A late round so reads the log and the edges, and shuffles what its few changes
    touch. It ends when nothing changes.

    Counts at least double along a path while they exceed one, so only chains of single reads are long; for them
    a changed label gives way to its own barcode's label from the fifth round on, which doubles its way each round.
    """
    key = ["region", "umi"]
    rank = F.struct((-F.col("n")).alias("n"), F.col("first_seen").alias("s"), F.col("umi").alias("u"))
    edges = durable(edges)
    log = changed = counts.select("region", "umi", rank.alias("label"))
    for k in count():
        sent = edges.join(changed.withColumnRenamed("umi", "src"), ["region", "src"]).groupBy("region", F.col("dst").alias("umi")).agg(F.min("label").alias("sent"))
        # what beats the least label that the log has
        known = log.join(sent, key).groupBy(*key).agg(F.min("label").alias("label"), F.min("sent").alias("sent"))
        changed = durable(known.where("sent < label").select(*key, F.col("sent").alias("label")))
        if changed.isEmpty():
            return log.groupBy(*key).agg(F.min("label").alias("label")).select("region", "umi", F.col("label.u").alias("parent"))
        log = log.unionByName(changed)
        if k >= PLAIN_ROUNDS:
            changed = durable(_jumped(changed, log))
            log = log.unionByName(changed)


def _jumped(changed: DataFrame, log: DataFrame) -> DataFrame:
    """``changed`` with the labels of the barcodes that its labels name, where these are better.

    All of a giant group name one barcode, and few of such named ones have a label other than their own, so only
    these are joined to, in ``SALTS`` copies.
    """
    named = changed.select("region", F.col("label.u").alias("umi")).distinct()
    over = log.join(named, ["region", "umi"]).groupBy("region", "umi").agg(F.min("label").alias("over")).where("over.u <> umi")
    over = over.select("region", F.col("umi").alias("u"), "over", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = changed.withColumns({"u": F.col("label.u"), "salt": F.pmod(F.xxhash64("umi"), F.lit(SALTS)).cast("int")})
    return salted.join(over, ["region", "u", "salt"], "left").select("region", "umi", F.least("label", "over").alias("label"))


def group_summary(groups: DataFrame) -> DataFrame:
    """(region, ptu, ctu, child_nums, freq_parents): parents, children, and parents by child count."""
    sizes = groups.groupBy("region", "parent").agg((F.count(F.lit(1)) - 1).alias("children"))
    by = sizes.groupBy("region", "children").agg(F.count(F.lit(1)).alias("parents"))
    rows = F.array_sort(F.collect_list(F.struct("children", "parents")))
    out = by.groupBy("region").agg(F.sum("parents").alias("ptu"), F.sum(F.col("children") * F.col("parents")).alias("ctu"), rows.alias("rows"))
    return out.select("region", "ptu", "ctu", F.col("rows.children").alias("child_nums"), F.col("rows.parents").alias("freq_parents"))


def umi_positions(starts: DataFrame, groups: DataFrame) -> DataFrame:
    """(region, parent, umi, pos, n): reads of each barcode by start, from ``start_counts``."""
    return starts.join(groups, ["region", "umi"]).select("region", "parent", "umi", "pos", "n")


def umi_families(positions: DataFrame, threshold: int = 10, dominant: bool = False) -> DataFrame:
    """(region, parent, fam_pos, fam_n): greedy families of a parent's (position, count) entries.

    The largest entry (ties: the largest position) seeds a family and takes all entries within the
    threshold; repeat on the rest. In that order this is one fold: an entry joins the earliest seed
    within reach, else becomes a seed.
    """
    entries = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), (-F.col("pos")).alias("p"))))

    def put(acc: Column, e: Column) -> Column:
        pos, n = -e["p"], -e["n"]
        at = F.array_position(F.transform(acc, lambda s: F.abs(s["pos"] - pos) <= threshold), F.lit(True))
        added = F.transform(acc, lambda s, i: F.struct(s["pos"].alias("pos"), (s["n"] + F.when(i == at - 1, n).otherwise(F.lit(0))).alias("n")))
        return F.when(at > 0, added).otherwise(F.concat(acc, F.array(F.struct(pos.alias("pos"), n.alias("n")))))

    empty = F.from_json(F.lit("[]"), "array<struct<pos:bigint,n:bigint>>")
    grouped = positions.groupBy("region", "parent").agg(entries.alias("entries"))
    folded = grouped.withColumn("families", F.aggregate("entries", empty, put))
    out = folded.select("region", "parent", F.inline("families")).withColumnsRenamed({"pos": "fam_pos", "n": "fam_n"})
    return dominant_families(out) if dominant else out


def dominant_families(families: DataFrame) -> DataFrame:
    """The family with most reads of each parent; ties: the largest position."""
    best = F.max(F.struct("fam_n", "fam_pos")).alias("best")
    return families.groupBy("region", "parent").agg(best).select("region", "parent", "best.fam_pos", "best.fam_n")


def qc_relationships(positions: DataFrame) -> DataFrame:
    """(region, umi, type, count, parent, distance, position): medians over a barcode's positions."""
    out = positions.groupBy("region", "parent", "umi").agg(F.median("n").alias("count"), F.median("pos").alias("position"))
    kind = F.when(F.col("umi") == F.col("parent"), "parent").otherwise("children").alias("type")
    return out.select("region", "umi", kind, "count", "parent", hamming(F.col("umi"), F.col("parent")).alias("distance"), "position")


def get_families(reads: DataFrame, umi_length: int, distance: int = 1, threshold: int = 10, ignore_others: bool = False, truncate: bool = False) -> dict[str, DataFrame]:
    """Counts, groups, positions and families of all regions, from one table of reads.

    The reads are read once, for their counts by barcode and start, and once more where flags are asked for.
    """
    starts = durable(start_counts(usable_reads(reads, truncate)))
    counts = checked_counts(durable(starts.groupBy("region", "umi").agg(F.sum("n").alias("n"), F.min("first_seen").alias("first_seen"))))
    groups = umi_groups(counts, umi_edges(counts, umi_length, distance))
    positions = durable(umi_positions(starts, groups))
    return {"counts": counts, "flags": flag_tally(reads), "groups": groups, "positions": positions, "families": umi_families(positions, threshold, ignore_others)}
