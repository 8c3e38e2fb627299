"""N-gram Jaccard join by a token-group matrix.

Documents are sets of hashed 4-word shingles; two link when 100 * intersection >= 85 * union.

1. A sketch of bounded size counts shingles over the corpus; its quantised counts and the hashes give
   one total order, rare first. Any order is exact; this one keeps common passages out of prefixes.
2. Equal sets become one class. Two sets that link share a shingle among the first
   n - ceil(0.85 n) + 1 of each in that order (their prefixes).
3. Partition: a class joins the group of the prefix shingle that most classes have too, and of its size
   within 4 %. Most of a large group of near copies share these, so they meet in few groups.
4. Token-group matrix: which groups hold a prefix shingle. The number of a set's prefix shingles in a
   group's union bounds its overlap with any member; a set opens only the groups that reach what a
   link needs, and two groups meet only with the sets that open the other one.
5. Groups are cut into blocks of bounded size. In a pair of blocks the same bound is taken with whole
   sets, and the exact overlaps of what is left are matrix products. A block pair returns for each
   set the least set it reaches there, so rows follow the blocks, not the pairs.
6. Components are least labels over these rows.

Memory of a task is that of two blocks. Copies are one row from step 2 on.

Edge cases: a text of fewer than four words is one shingle, its whole sequence; without words (null,
empty) the set is empty and links with nothing. Rows of one doc_id are one document, so their texts
are in one component. Rows with a null doc_id take the component of an equal set, else null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, staged, text_batches
from .components import components

SHINGLE = 4
#: Link when 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Hash buckets of the sketch (one byte each when broadcast) and of a row of it.
SKETCH = 1 << 22
_ROW = 1 << 12
_SHIFT = np.uint64(64 - 22)
#: Sets of a group differ in size by this factor at most, so that the bound on their overlap is tight.
BAND = 1.04
#: Sets and shingles of a block.
BLOCK_SETS = 256
BLOCK_TOKENS = 400_000

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


class Shingler:
    """Sorted hashed shingle sets of texts; keeps the hashes of words that it has met."""

    def __init__(self, most: int = 150_000):
        self.known: dict[bytes, int] = {}
        self.most = most

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > self.most:
            self.known.clear()
        known, ids = self.known, []
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh64_intdigest(w)
            ids.append(h)
        h = np.array(ids, np.uint64)
        k = min(len(h), SHINGLE)
        n = len(h) - k + 1
        total = np.full(n, k * 0x27D4EB2F165667C5 % 2**64, np.uint64)
        for i in range(k):
            total += h[i : i + n] * _MULTIPLIERS[i]
        total ^= total >> np.uint64(31)
        total *= np.uint64(0x94D049BB133111EB)
        total ^= total >> np.uint64(29)
        return np.unique(total)


def digest(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def sketch(docs: DataFrame) -> np.ndarray:
    """Quantised counts (8 steps a doubling) of SKETCH hash buckets over all texts; 4 MB."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, shingles, some = np.zeros(SKETCH, np.int32), Shingler(), False
        for batch in batches:
            for part in slices(batch):
                for text in part.column(0).to_pylist():
                    np.add.at(counts, (shingles(text) >> _SHIFT).astype(np.int64), 1)
                    some = True
        if some:
            rows = np.minimum(counts, 65535).astype(np.uint16).reshape(-1, _ROW)
            at = np.flatnonzero(rows.any(1))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([rows[i].tobytes() for i in at], pa.binary())], names=["part", "counts"])

    def total(table: pa.Table) -> pa.Table:
        counts = np.zeros(_ROW, np.int64)
        for c in table.column("counts").to_pylist():
            counts += np.frombuffer(c, np.uint16)
        return pa.table({"part": table.column("part")[:1].cast(pa.int32()), "counts": pa.array([quantised(counts).tobytes()], pa.binary())})

    def quantised(counts: np.ndarray) -> np.ndarray:
        return np.minimum(8 * np.log2(1.0 + counts), 254).astype(np.uint8)

    parts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "part int, counts binary")
    out = np.zeros((SKETCH // _ROW, _ROW), np.uint8)
    # at most SKETCH / _ROW rows of _ROW bytes
    for r in parts.groupBy("part").applyInArrow(total, "part int, counts binary").collect():
        out[r["part"]] = np.frombuffer(bytes(r["counts"]), np.uint8)
    return out.ravel()


def shingle_features(docs: DataFrame) -> DataFrame:
    """(doc_id, n, sig, prefix) of each row: set size, digest of the set, prefix keys in order."""
    sent = docs.sparkSession.sparkContext.broadcast(sketch(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, shingles = sent.value, Shingler()
        for part in (p for batch in batches for p in slices(batch)):
            n, sig, prefix = [], [], []
            for text in part.column(1).to_pylist():
                t = shingles(text)
                n.append(len(t))
                sig.append(digest(t) if len(t) else None)
                key = counts[(t >> _SHIFT).astype(np.int64)].astype(np.uint64) << np.uint64(55) | t >> np.uint64(9)
                first = len(t) - -(-PERCENT * len(t) // 100) + 1 if len(t) else 0
                order = np.lexsort((t, key))[:first]
                prefix.append(key[order].astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n, pa.int64()), pa.array(sig, pa.binary()), pa.array(prefix, pa.list_(pa.int64()))],
                names=["doc_id", "n", "sig", "prefix"],
            )

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id bigint, n bigint, sig binary, prefix array<bigint>")


def block_links(left: list[tuple[int, np.ndarray]], right: list[tuple[int, np.ndarray]] | None) -> tuple[list[int], list[int]]:
    """(node, least node it reaches) for links between two blocks of sets, or within one."""
    same = right is None
    right = left if same else right
    if len(right) == 1 and len(left) == 1:  # the usual pair of near copies
        (x, s), (y, t) = left[0], right[0]
        common = len(np.intersect1d(s, t, assume_unique=True))
        linked = x != y and 100 * common >= PERCENT * (len(s) + len(t) - common)
        return ([max(x, y)], [min(x, y)]) if linked else ([], [])

    def flat(rows):
        return np.concatenate([t for _, t in rows]), np.repeat(np.arange(len(rows)), [len(t) for _, t in rows])

    (lt, lo), (rt, ro) = flat(left), flat(right)
    ln, rn = np.array([len(t) for _, t in left]), np.array([len(t) for _, t in right])
    # overlap with the other block's token union bounds the overlap with any of its sets
    if same:
        u, of, times = np.unique(lt, return_inverse=True, return_counts=True)
        shared = times[of] > 1
        l_open = 100 * np.bincount(lo, weights=shared, minlength=len(left)) >= PERCENT * ln
        r_open = l_open
        # a shingle of one set alone adds to no overlap with another; the diagonal is a link anyway
        lt, lo = lt[shared], lo[shared]
        rt, ro = lt, lo
    else:
        l_open = 100 * np.bincount(lo, weights=np.isin(lt, rt), minlength=len(left)) >= PERCENT * ln
        r_open = 100 * np.bincount(ro, weights=np.isin(rt, lt[l_open[lo]]), minlength=len(right)) >= PERCENT * rn
    li, ri = np.flatnonzero(l_open), np.flatnonzero(r_open)
    if not len(li) or not len(ri):
        return [], []
    lk, rk = l_open[lo], r_open[ro]
    lt, lo, rt, ro = lt[lk], np.searchsorted(li, lo[lk]), rt[rk], np.searchsorted(ri, ro[rk])
    union = np.intersect1d(lt, rt)
    common = np.zeros((len(li), len(ri)))
    for a in range(0, len(union), 8192):
        part = union[a : a + 8192]
        sides = []
        for t, o, n in ((lt, lo, len(li)), (rt, ro, len(ri))):
            at = np.searchsorted(part, t)
            hit = (at < len(part)) & (part[np.minimum(at, len(part) - 1)] == t)
            m = np.zeros((n, len(part)), np.float32)
            m[o[hit], at[hit]] = 1.0
            sides.append(m)
        common += sides[0] @ sides[1].T
    link = 100 * common >= PERCENT * (ln[li][:, None] + rn[ri][None, :] - common)
    a = np.array([left[i][0] for i in li], np.int64)
    b = np.array([right[i][0] for i in ri], np.int64)
    big = np.iinfo(np.int64).max
    la, lb = a.copy(), b.copy()
    while True:
        na = np.minimum(la, np.where(link, lb[None, :], big).min(1))
        nb = np.minimum(lb, np.where(link, na[:, None], big).min(0))
        if (na == la).all() and (nb == lb).all():
            break
        la, lb = na, nb
    nodes, least = np.concatenate([a, b]), np.concatenate([la, lb])
    keep = nodes != least
    return nodes[keep].tolist(), least[keep].tolist()


def _least_overlap(n: Column, low: Column, high: Column) -> Column:
    """Prefix shingles that a set of ``n`` shares at least with a set of low to high that it links to.

    A link needs ceil(0.85 (n + m) / 1.85) common shingles, so all but few of the shingles of the
    prefix that ends first are common, and all those are in both prefixes. One less is asked for, as
    rounding moves the bound by one. Null where no size of the range allows a link.
    """
    up = lambda x, y: F.ceil(x / y).cast("bigint")
    lo, hi = F.greatest(low, up(n * PERCENT, 100)), F.least(high, F.floor(n * 100 / PERCENT))
    need = lambda m, own: up((n + m) * PERCENT, 100 + PERCENT) - up(own * PERCENT, 100)
    return F.when(lo <= hi, F.greatest(F.least(need(lo, n), need(hi, hi)), F.lit(1).cast("bigint")))


def open_groups(shared: DataFrame) -> DataFrame:
    """(node, n, own, other): the groups that a set opens; its own group may be among them.

    A document may name several sets, so they are told apart by their size here; sets of one document
    and size are taken together, which opens more.

    ``shared`` is (key, sets, node, n): prefix shingles that two sets or more have, and how many. The matrix has a cell
    (key, g) for each group that holds the shingle, with the number of its sets. A set's overlap with
    a group's union of prefixes bounds its overlap with any member's prefix.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / np.log(BAND))
    members = shared.groupBy("node", "n").agg(F.max(F.struct("sets", "key")).alias("top"))
    members = staged(members.select("node", "n", F.xxhash64("top.key", band).alias("g")), "members")
    span = members.groupBy("g").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    posted = shared.select("key", "node", "n").join(members, ["node", "n"])
    posted = staged(posted, "posted")
    matrix = posted.groupBy("key", "g").agg(F.count(F.lit(1)).alias("sets")).join(span, "g").withColumnRenamed("g", "other")
    met = posted.withColumnRenamed("g", "own").join(matrix, "key").where((F.col("own") != F.col("other")) | (F.col("sets") > 1))
    met = met.where((F.col("high") * 100 >= F.col("n") * PERCENT) & (F.col("n") * 100 >= F.col("low") * PERCENT))
    counted = met.groupBy("node", "n", "own", "other", "low", "high").agg(F.count(F.lit(1)).alias("common"))
    return counted.where(F.col("common") >= _least_overlap(F.col("n"), F.col("low"), F.col("high"))).select("node", "n", "own", "other")


def _dealt(opened: DataFrame) -> DataFrame:
    """(g1, g2, i, j, right, node): for each pair of groups that open each other, pairs of blocks."""
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_TOKENS)).cast("int")
    sides = opened.groupBy("own", "other").agg(blocks.alias("k"))
    back = sides.select(F.col("own").alias("other"), F.col("other").alias("own"), F.col("k").alias("k_other"))
    rows = opened.join(sides.join(back, ["own", "other"]), ["own", "other"]).withColumn("x", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
    x, own, other = F.col("x"), F.col("own"), F.col("other")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("k_other") - 1),
        lambda j: F.when(own == other, F.struct(F.least(x, j).alias("i"), F.greatest(x, j).alias("j"), (x > j).alias("right")))
        .when(own < other, F.struct(x.alias("i"), j.alias("j"), F.lit(False).alias("right")))
        .otherwise(F.struct(j.alias("i"), x.alias("j"), F.lit(True).alias("right"))),
    )
    return rows.select("node", F.least(own, other).alias("g1"), F.greatest(own, other).alias("g2"), F.inline(pairs))


def links(docs: DataFrame, features: DataFrame) -> DataFrame:
    """(a, b): links between classes, each class named by its least doc_id; a forest in each block pair."""
    known = features.where("n > 0 AND doc_id IS NOT NULL")
    classes = known.groupBy("sig").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    posted = classes.select("node", "n", F.explode("prefix").alias("key"))
    lists = Window.partitionBy("key")
    shared = posted.withColumn("sets", F.count(F.lit(1)).over(lists)).where("sets > 1").select("key", "sets", "node", "n")
    opened = staged(open_groups(staged(shared, "shared")), "opened")
    tasks = staged(_dealt(opened), "tasks")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("node"), F.col("text").cast("string").alias("text"))
    keys = ["g1", "i", "g2", "j"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # merged at any size: the tasks grow with the corpus, so they are never broadcast
    rows = tasks.hint("merge").join(texts, "node").select(*keys, "right", "node", "text")
    rows = rows.repartition(parts, *keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler()

        def flush(key, sides):
            if key[:2] == key[2:]:
                got = block_links(sides[0], None) if len(sides[0]) > 1 else ([], [])
            else:
                got = block_links(sides[0], sides[1]) if sides[0] and sides[1] else ([], [])
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in got], names=["a", "b"])

        key, sides = None, ([], [])
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                k = [part.column(i).to_pylist() for i in range(4)]
                for *at, on_right, node, text in zip(*k, *[part.column(i).to_pylist() for i in (4, 5, 6)], strict=True):
                    if at != key:
                        if key is not None:
                            yield flush(key, sides)
                        key, sides = at, ([], [])
                    tokens = shingles(text)
                    if len(tokens):
                        sides[on_right].append((node, tokens))
        if key is not None:
            yield flush(key, sides)

    return rows.mapInArrow(run, "a bigint, b bigint")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text)."""
    text_batches(docs.sparkSession)
    features = staged(shingle_features(docs), "features")
    known = features.where("n > 0 AND doc_id IS NOT NULL").select("doc_id", "sig")
    nodes = staged(known.groupBy("sig").agg(F.min("doc_id").alias("node")), "nodes")
    found = links(docs, features)
    # rows of one id are one document: where they differ, the id is linked to the classes of both
    twice = known.groupBy("doc_id").agg(F.min("sig").alias("x"), F.max("sig").alias("y")).where("x <> y").select("doc_id")
    again = known.join(twice, "doc_id", "left_semi").join(nodes, "sig").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    label = components(found.unionByName(again))
    named = nodes.join(label, "node", "left").select("sig", F.coalesce("component", "node").alias("component_id"))
    out = features.select("doc_id", F.col("n").alias("n_shingles"), "sig").join(named, "sig", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
