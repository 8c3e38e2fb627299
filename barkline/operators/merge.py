"""Merging region results: rows in contig order, duplicates at region borders once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barkline.functions.sequences import contig_order


def merge_rows(parts: list[DataFrame], contig: str = "contig", start: str = "start") -> DataFrame:
    """All rows, by contig name and start."""
    return reduce(DataFrame.unionByName, parts).orderBy(contig, start)


def merge_consensus(rows: DataFrame, keys: tuple[str, ...] = ("contig", "pos", "fam"), first: str = "region_start") -> DataFrame:
    """Overlapping regions report a position twice; the row of the region that starts first stays.

    An aggregate with map-side combine rather than a window: a struct of the order and the row.
    """
    rest = [c for c in rows.columns if c not in keys]
    best = F.min(F.struct(F.col(first), *[F.col(c) for c in rest if c != first])).alias("best")
    return rows.groupBy(*keys).agg(best).select(*keys, *[F.col(f"best.{c}").alias(c) for c in rest])


def ordered(rows: DataFrame) -> DataFrame:
    return rows.orderBy(*contig_order(F.col("contig")), "pos", "fam")


def unique_keys(rows: DataFrame, keys: tuple[str, ...] = ("contig", "fam", "pos")) -> DataFrame:
    """Keys that occur more than once; empty for a valid consensus table."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def keep_first(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in an order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
