"""Connected components of an edge table, by hooking roots, pointer jumping and contracting edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

#: Copies of a parent's row in the join that jumps, so that the nodes of a giant component are dealt out.
SALTS = 16


def _jumped(parents: DataFrame) -> DataFrame:
    """(node, p, moved): each node's parent replaced by the parent's parent.

    Most parents are roots; only the others are looked up, so the side of one row a parent is small
    beside the nodes, and it is repeated for each salt.
    """
    inner = parents.where("node <> p").select(F.col("node").alias("p"), F.col("p").alias("over"))
    inner = inner.join(parents.select("p").distinct(), "p").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = parents.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    return salted.join(inner, ["p", "salt"], "left").select("node", F.coalesce("over", "p").alias("p"), F.col("over").isNotNull().alias("moved"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every end of an edge (a, b); component is the least node reachable.

    A parent is a node of the same component that isn't larger. Each round jumps (a parent becomes the
    parent's parent), contracts edges to the parents of their ends, drops those within one parent and
    hooks the larger end of each that is left under the least end it meets. Of the roots that have edges
    at least half are hooked in two rounds once paths are flat, and jumps halve paths, so rounds grow
    with the logarithm of the nodes; there is no limit to them. It ends when no edge is left and nothing
    moved. All tables are distributed; two booleans a round reach the driver. Rounds are written to the
    shared folder, so a lost executor costs one round at most.
    """
    apart = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    left = staged(apart, "edges")
    parents = left.select(F.col("hi").alias("node"), F.col("lo").alias("p")).unionByName(left.select(F.col("lo").alias("node"), F.col("lo").alias("p")))
    parents = parents.groupBy("node").agg(F.min("p").alias("p"))
    while True:
        known = staged(_jumped(staged(parents, "parents")), "parents")
        at = known.select("node", "p")
        ends = left.join(at.select(F.col("node").alias("hi"), F.col("p").alias("x")), "hi").join(at.select(F.col("node").alias("lo"), F.col("p").alias("y")), "lo")
        left = staged(ends.where("x <> y").select(F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo")).distinct(), "edges")
        if left.isEmpty() and known.where("moved").isEmpty():
            return at.withColumnRenamed("p", "component")
        hooks = left.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("hook"))
        parents = at.join(hooks, "node", "left").select("node", F.least("p", "hook").alias("p"))
