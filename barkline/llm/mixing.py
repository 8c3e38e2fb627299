"""Mixing sources to target weights by systematic sampling; DataFrame functions only.

Documents of a source stand in the order (size, digest of doc_id and text). Each has the same expected
number of copies, target / source size. The prefix sum of these, plus one random offset a source,
crosses integer boundaries; a document is emitted once for each boundary crossed in its interval.
Because the order starts with the size, what a source emits has nearly the sizes of the source, so
its words come near the target.

The prefix sum never puts a source into one task: counts are taken by (source, size, slice), where a slice
is the digest's first ``SLICE`` hex digits, summed over slices within a size and over sizes within a
source, and only the rows of one slice are numbered together.

Edge cases: a null text has size 0; sources may be null (last in order); a source without words has
target 0 and none of it is taken; an empty table gives an empty result; rows that repeat id and text
stand side by side, ordered by their other columns, so reruns agree; a very long text counts whole;
extra columns are carried, except ones named like an output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SEED, col

#: Words are runs of characters other than space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: A source gives at most this multiple of its size.
MOST = 3
#: Hex digits of a slice: 65,536 slices of a (source, size) group are numbered apart.
SLICE = 4

OUTPUTS = ["size", "source_size", "target", "copies", "taken"]


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) a source.

    Sources by code point, nulls last, take the weights in turn. A target of weight * level stops at
    ``most`` times its size; the level rises until the targets share the total. Sources by rising
    (cap / weight) reach their caps first, so the capped ones are a prefix of that order.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.row_number().over(ordered) - 1) % len(weights)) + 1)
    s = sizes.withColumn("w", w.cast("bigint")).withColumn("cap", F.col("source_size") * most)
    rising = Window.orderBy((F.col("cap").cast("double") / F.col("w")), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    s = s.withColumn(
        "level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double")
        / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))),
    ).withColumn("capped", F.col("cap").cast("double") / F.col("w") <= F.col("level"))
    level = F.min(F.when(~F.col("capped"), F.struct(F.col("cap").cast("double") / F.col("w"), "level"))).over(everything)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(level["level"] * F.col("w"))
    return s.select("source", "source_size", target.alias("target"))


def offset(source: Column, seed: int = SEED) -> Column:
    """The random offset of a source in [0, 1): 32 bits of an MD5 of seed and source."""
    name = F.concat_ws(":", F.lit(str(seed)), F.coalesce(source, F.lit("\u0000none")))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def mix(docs: DataFrame, seed: int = SEED, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``docs`` with size, source_size, target, copies (times the mix holds the row) and taken."""
    kept = [c for c in docs.columns if c not in OUTPUTS]
    named = [col(c).alias(f"in_{i}") for i, c in enumerate(kept)]
    text = F.col("text").cast("string")
    digest = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))
    # a map can't be hashed; its text can
    rest = [F.to_json(F.struct(col(c))) if isinstance(docs.schema[c].dataType, (T.MapType, T.VariantType)) else col(c) for c in kept if c not in ("doc_id", "text")]
    rows = docs.select(
        *named, digest.alias("digest"), F.xxhash64(F.lit(0), *rest).alias("tie"), F.col("source").cast("string").alias("source"), words(text).alias("size"),
    ).withColumn("slice", F.substring("digest", 1, SLICE))
    by_slice = rows.groupBy("source", "size", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = Window.unboundedPreceding
    by_slice = by_slice.withColumn(
        "in_size", F.sum("n").over(Window.partitionBy("source", "size").orderBy("slice").rowsBetween(before, 0)) - F.col("n")
    )
    by_size = by_slice.groupBy("source", "size").agg(F.sum("n").alias("m"))
    by_size = by_size.withColumn(
        "in_source", F.sum("m").over(Window.partitionBy("source").orderBy("size").rowsBetween(before, 0)) - F.col("m")
    )
    sizes = by_size.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"))
    aims = targets(sizes, weights, most)

    def same(a: DataFrame, b: DataFrame, *keys: str) -> DataFrame:
        b = b.withColumnsRenamed({k: f"r_{k}" for k in keys})
        on = F.lit(True)
        for k in keys:
            on = on & a[k].eqNullSafe(b[f"r_{k}"])
        return a.join(b, on).drop(*[f"r_{k}" for k in keys])

    starts = same(same(by_slice.drop("n"), by_size.drop("m"), "source", "size"), aims, "source")
    here = Window.partitionBy("source", "size", "slice").orderBy("digest", "tie")
    rows = rows.withColumn("nth", F.row_number().over(here))
    rows = same(rows, starts, "source", "size", "slice")
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    last = F.col("in_source") + F.col("in_size") + F.col("nth")
    copies = F.floor(offset(F.col("source"), seed) + rate * last) - F.floor(offset(F.col("source"), seed) + rate * (last - 1))
    return rows.withColumn("copies", copies.cast("bigint")).select(
        *[F.col(f"in_{i}").alias(c) for i, c in enumerate(kept)], "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def emitted(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as it has copies, without the added columns."""
    kept = [c for c in mixed.columns if c not in OUTPUTS]
    repeated = mixed.where("copies > 0").withColumn("copies", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return repeated.select(*[col(c) for c in kept])


#: The query in DuckDB's SQL.
SQL = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', coalesce(text, ''))) AS digest
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS r
      FROM d GROUP BY source),
w AS (SELECT source, source_size, source_size * {MOST} AS cap,
             CASE (r - 1) % 3 WHEN 0 THEN {WEIGHTS[0]} WHEN 1 THEN {WEIGHTS[1]} ELSE {WEIGHTS[2]} END::BIGINT AS w FROM s),
l AS (SELECT *, cap::DOUBLE / w AS fill,
  ((sum(source_size) OVER ()) - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST
     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
  / ((sum(w) OVER ()) - coalesce(sum(w) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST
     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level FROM w),
f AS (SELECT level FROM l WHERE fill > level ORDER BY fill LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN fill <= level THEN cap::DOUBLE ELSE (SELECT level FROM f) * w END AS target FROM l),
n AS (SELECT d.doc_id, d.source, d.size, row_number() OVER (PARTITION BY d.source
        ORDER BY d.size, d.digest) AS nth FROM d),
u AS (SELECT n.doc_id, n.size, t.source_size, t.target, n.nth,
        CASE WHEN t.source_size = 0 THEN 0.0::DOUBLE ELSE t.target / t.source_size END AS rate,
        ('0x' || substr(md5('{SEED}:' || coalesce(n.source, chr(0) || 'none')), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS o
      FROM n JOIN t ON n.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((floor(o + rate * nth) - floor(o + rate * (nth - 1))) * size)::BIGINT AS taken
FROM u
"""
