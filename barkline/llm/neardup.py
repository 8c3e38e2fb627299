"""Near-duplicate embeddings: spherical k-means cells and blocked cosine products.

1. Equal vectors of a label become one class with a multiplicity, so a group of copies is one row.
2. Spherical k-means on a bounded sample gives each label its own centroids, as many as its classes ask
   for; a class is assigned to the nearest one of its label (its home). For unit vectors x, y with homes
   c, d the gaps x(c - d) and y(d - c) are not negative and add up to at most |x - y| |c - d|, so one is
   at most half of that. A class visits each cell whose gap allows it at the threshold, and a pair is
   compared when either end visits the other's home: no pair at the threshold is missed.
3. A cell's rows are cut into blocks of bounded size, those at home apart from visitors, and blocks are
   compared pair by pair in double precision, visitors not with each other. A block pair returns, for
   each vector, the weight of its links and its least linked vector: rows in proportion to the block,
   not to the pairs.
4. Components are least labels over these rows; the least id of a component stays.

Vectors that are null, zero, or hold null or non-finite components, and vectors without a label,
link with nothing. Vectors of different lengths never link. A null vec_id keeps its row, links
nothing and has a null component. Repeated ids are one node; repeated rows link with each other. A pair
exactly at the threshold links, ties of centroids go to the first. An empty table gives an empty result,
and columns other than vec_id, embedding and label are not read, whatever their names.
"""

from __future__ import annotations

import collections
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SEED, staged
from .components import components

THRESHOLD = 0.93
#: Vectors that k-means is fitted on at most.
SAMPLE = 20_000
#: Vectors a cell holds on average; labels of fewer are one cell.
PER_CELL = 1000
#: Centroids of all labels together, which bounds the broadcast; beyond it cells get larger, with equal results.
MOST_CELLS = 4096
#: Rounding that a visit allows for.
SLACK = 1e-9
#: Rows of a block.
BLOCK = 2048


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = SEED) -> np.ndarray:
    """Unit centroids of unit rows; an empty cell takes the row farthest from its centroid."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        s = x @ c.T
        home = s.argmax(1)
        new = np.zeros_like(c)
        np.add.at(new, home, x)
        norm = np.linalg.norm(new, axis=1)
        empty = norm == 0
        if empty.any():
            new[empty] = x[np.argsort(s.max(1))[: empty.sum()]]
            norm = np.linalg.norm(new, axis=1)
        c = new / norm[:, None]
    return c


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all components one after another in double precision, length of each vector)."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.diff(column.offsets.to_numpy())


def _classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable rows, classes): one class (label, embedding, rep, m) for equal vectors of a label."""
    e = F.col("embedding")
    good = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    usable = vectors.where(F.col("label").isNotNull() & e.isNotNull() & F.col("vec_id").isNotNull()).where(F.coalesce(good, F.lit(False)))
    usable = usable.select("vec_id", "label", "embedding")
    return usable, usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("m"))


def _visits(x: np.ndarray, home: np.ndarray, other: np.ndarray, threshold: float) -> np.ndarray:
    """Whether rows of ``x`` visit the cells of ``other`` centroids from those of ``home``, row by row."""
    d = home - other
    return (x * d).sum(1) <= math.sqrt(max(0.0, (1 - threshold) / 2)) * np.sqrt((d * d).sum(1)) + SLACK


def centroids(classes: DataFrame) -> dict:
    """Label -> its unit centroids, for labels of more than one cell; from at most SAMPLE vectors."""
    big = classes.groupBy("label").count().where(F.col("count") > PER_CELL).orderBy(F.desc("count"), "label").limit(MOST_CELLS // 2)
    wanted = {r["label"]: math.ceil(r["count"] / PER_CELL) for r in big.collect()}
    if not wanted:
        return {}
    share = min(1.0, MOST_CELLS / sum(wanted.values()))
    rows = classes.orderBy(F.xxhash64("rep", F.lit(SEED)), "rep", "label").limit(SAMPLE).select("label", "embedding").toArrow()
    of: dict = {}
    for label, vector in zip(rows.column("label").to_pylist(), rows.column("embedding").combine_chunks(), strict=True):
        if label in wanted:
            of.setdefault(label, []).append(vector.values.to_numpy(zero_copy_only=False).astype(np.float64))
    out = {}
    for label, vectors in of.items():
        dim = max(collections.Counter(map(len, vectors)).items(), key=lambda x: (x[1], x[0]))[0]
        fitted = np.array([v for v in vectors if len(v) == dim])
        k = min(max(1, int(wanted[label] * share)), max(1, len(fitted) // 4))
        if k > 1:
            out[label] = spherical_kmeans(_unit(fitted), k)
    return out


def _assign(classes: DataFrame, sent: Broadcast, threshold: float) -> DataFrame:
    """(label, cell, home, rep, m, embedding), a row for each cell that a class is in."""
    reach = math.sqrt(max(0.0, (1 - threshold) / 2))

    def cells(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, cell, home) of unit rows."""
        s = x @ c.T
        h = s.argmax(1)
        apart = np.sqrt(np.maximum(0.0, 2 - 2 * (c[h] @ c.T)))
        # near enough by fast sums, then by those that _compare takes again
        i, at = np.nonzero(s[np.arange(len(h)), h][:, None] - s <= reach * apart + 1e-6)
        ok = np.concatenate([_visits(x[i[k : k + 16384]], c[h[i[k : k + 16384]]], c[at[k : k + 16384]], threshold) for k in range(0, len(i), 16384)])
        return i[ok], at[ok], h[i[ok]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = sent.value
        for whole in batches:
            for lo in range(0, whole.num_rows, 1024):
                batch = whole.slice(lo, 1024)
                flat, n = _values(batch.column("embedding"))
                start = np.cumsum(n) - n
                labels = batch.column("label").dictionary_encode()
                codes = labels.indices.to_numpy(zero_copy_only=False)
                take, cell, home = [], [], []
                for code, label in enumerate(labels.dictionary.to_pylist()):
                    rows = np.flatnonzero(codes == code)
                    c = of.get(label)
                    fit = rows[n[rows] == c.shape[1]] if c is not None else rows[:0]
                    rest = np.setdiff1d(rows, fit)
                    take.append(rest)
                    cell.append(np.full(len(rest), -1))
                    home.append(np.full(len(rest), -1))
                    if len(fit):
                        i, at, h = cells(_unit(flat[start[fit][:, None] + np.arange(c.shape[1])]), c)
                        take.append(fit[i])
                        cell.append(at)
                        home.append(h)
                take, cell, home = map(np.concatenate, (take, cell, home))
                for part in range(0, len(take), 4096):
                    got = batch.take(pa.array(take[part : part + 4096]))
                    yield pa.RecordBatch.from_arrays(
                        [got.column("label"), pa.array(cell[part : part + 4096], pa.int32()), pa.array(home[part : part + 4096], pa.int32()),
                         got.column("rep"), got.column("m"), got.column("embedding")],
                        names=["label", "cell", "home", "rep", "m", "embedding"],
                    )

    label = dict(classes.dtypes)["label"]
    kind = dict(classes.dtypes)["embedding"]
    return classes.select("label", "rep", "m", "embedding").mapInArrow(
        run, f"label {label}, cell int, home int, rep bigint, m bigint, embedding {kind}"
    )


def _compare(cell: int, left: tuple, right: tuple | None, threshold: float, c: np.ndarray | None) -> list[np.ndarray]:
    """(rep, weight of new links, least linked rep) from one block, or between two blocks of a cell.

    A side is (home, rep, m, unit vectors). Rows of ``left`` are at home; those of ``right`` all are, or all visit.
    """
    same = right is None
    right = left if same else right
    (_, ra, ma, a), (hb, rb, mb, b) = left, right
    link = (a @ b.T) >= threshold
    if same:
        np.fill_diagonal(link, False)
    i, j = np.nonzero(link)
    # a pair may meet in the homes of both ends; it counts in the lesser of those where it does
    twice = np.flatnonzero(hb[j] < cell)
    if len(twice):
        k = len(c)
        pairs, of = np.unique(i[twice] * k + hb[j[twice]], return_inverse=True)
        own, other = np.divmod(pairs, k)
        meets = np.concatenate([
            _visits(a[own[at : at + 16384]], c[np.full(len(own[at : at + 16384]), cell)], c[other[at : at + 16384]], threshold) for at in range(0, len(pairs), 16384)
        ])
        keep = np.ones(len(i), bool)
        keep[twice[meets[of]]] = False
        i, j = i[keep], j[keep]
    out = []
    for x, y, own, other, weight in ((i, j, ra, rb, mb), (j, i, rb, ra, ma))[: 1 if same else 2]:
        n = np.bincount(x, weights=weight[y], minlength=len(own)).astype(np.int64)
        least = np.full(len(own), np.iinfo(np.int64).max)
        np.minimum.at(least, x, other[y])
        some = np.flatnonzero(n)
        out.append((own[some], n[some], least[some]))
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def links(classes: DataFrame, threshold: float = THRESHOLD, block: int | None = None) -> DataFrame:
    """(rep, n, other): for each block pair and vector, the weight of its links and the least of them."""
    spark, block = classes.sparkSession, block or BLOCK
    sent = spark.sparkContext.broadcast(centroids(classes))
    cells = staged(_assign(classes, sent, threshold).withColumn("dim", F.size("embedding")), "cells")
    group = ["label", "dim", "cell"]
    own = F.col("home") == F.col("cell")
    some = lambda of: F.ceil(F.count_if(of) / block).cast("int")
    blocks = cells.groupBy(*group).agg(some(own).alias("k"), some(~own).alias("visiting"))
    at = lambda n: F.pmod(F.xxhash64("rep", F.lit(7)), n).cast("int")
    placed = cells.join(blocks.where("k > 0"), group).withColumn("block", F.when(own, at(F.col("k"))).otherwise(F.col("k") + at(F.col("visiting"))))
    # a row of block i is on the left of pairs (i, j >= i) and on the right of pairs (j < i, i); visitors' blocks come last
    others = F.transform(
        F.sequence(F.lit(0), F.when(own, F.col("k") + F.col("visiting")).otherwise(F.col("k")) - 1),
        lambda j: F.struct(F.least("block", j).alias("i"), F.greatest("block", j).alias("j"), (F.col("block") > j).alias("right")),
    )
    dealt = placed.withColumn("pair", F.explode(others)).select("*", "pair.i", "pair.j", "pair.right")
    keys = [*group, "i", "j"]
    cols = [*keys, "right", "home", "rep", "m", "embedding"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.select(*cols).repartition(parts, *keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(key: tuple, parts: list) -> Iterator[pa.RecordBatch]:
            right, home, rep, m = (np.concatenate(x) for x in list(zip(*parts, strict=True))[:4])
            x = _unit(np.concatenate([p[4] for p in parts]).reshape(len(rep), -1))
            left, other = [(home[s], rep[s], m[s], x[s]) for s in (~right, right)]
            if key[3] == key[4] or (len(left[1]) and len(other[1])):
                got = _compare(key[2], left, None if key[3] == key[4] else other, threshold, sent.value.get(key[0]))
                yield pa.RecordBatch.from_arrays([pa.array(g, pa.int64()) for g in got], names=["rep", "n", "other"])

        key, parts = None, []
        for batch in batches:
            change = np.zeros(batch.num_rows, bool)
            for at in range(len(keys)):
                codes = batch.column(at).dictionary_encode().indices.to_numpy(zero_copy_only=False)
                change[1:] |= codes[1:] != codes[:-1]
            change[:1] = True
            cuts = [*np.flatnonzero(change).tolist(), batch.num_rows]
            numbers = [batch.column(at).to_numpy(zero_copy_only=False) for at in range(5, 9)]
            flat, n = _values(batch.column(9))
            ends = np.cumsum(n)
            for lo, hi in zip(cuts, cuts[1:]):
                now = tuple(batch.column(at)[lo].as_py() for at in range(len(keys)))
                if now != key:
                    if parts:
                        yield from flush(key, parts)
                    key, parts = now, []
                parts.append((*[x[lo:hi] for x in numbers], flat[ends[lo] - n[lo] : ends[hi - 1]]))
        if parts:
            yield from flush(key, parts)

    return dealt.mapInArrow(run, "rep bigint, n bigint, other bigint")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, embedding, label)."""
    usable, classes = _classes(vectors)
    classes = staged(classes, "classes")
    found = staged(links(classes, threshold), "links")
    label = components(found.select(F.col("rep").alias("a"), F.col("other").alias("b")))
    counted = found.groupBy("rep").agg(F.sum("n").alias("far"))
    known = classes.join(counted, "rep", "left").join(label.withColumnRenamed("node", "rep"), "rep", "left").select(
        "label", "embedding", (F.coalesce("far", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    hit = usable.join(known, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    e = F.col("embedding")
    good = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    whole = F.col("label").isNotNull() & e.isNotNull() & F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False))
    rest = vectors.where(~whole).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return hit.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
