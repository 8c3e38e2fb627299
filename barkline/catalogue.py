"""The registered queries and the same results as SQL.

Queries run over the views of ``barkline.plans.views``; the SQL states each result independently:
all pairs instead of slices, recursion instead of label rounds, lists instead of folds.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barkline.functions import sequences as sq
from barkline.operators import consensus as cs
from barkline.operators import grouping as gp
from barkline.operators import merge as mg
from barkline.operators import pileup as pl
from barkline.operators import preprocess as pp
from barkline.operators import summaries as sm
from barkline.operators import variants as vr
from barkline.plans import commands, views
from barkline.session import durable

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

SIZES = [1, 3, 10]
QUALITY = 12
DISTANCE = 1
NEAR = 10

PREP = pp.Prep("INLINE", 1, 1, (1,), (8,), (1,), "ATGGG", True)


def query(name: str, sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


# -- common parts ------------------------------------------------------------------------------


def _families(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return gp.get_families(views.reads(spark, sf_dir, stage=False), views.UMI_LENGTH, DISTANCE, NEAR)


def _bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return durable(cs.base_counts(views.pileup(spark, sf_dir, stage=False), QUALITY))


def _alleles(spark: SparkSession, sf_dir: str, bases: DataFrame | None = None) -> DataFrame:
    f = _families(spark, sf_dir)
    return cs.family_alleles(_bases(spark, sf_dir) if bases is None else bases, f["groups"], f["families"], NEAR)


def _calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _calls_and_alleles(spark, sf_dir)[0]


def _calls_and_alleles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The calls and the family alleles behind them: each of the two views is read once."""
    bases = _bases(spark, sf_dir)
    alleles = durable(_alleles(spark, sf_dir, bases))
    return cs.consensus(alleles, SIZES).unionByName(cs.uncollapsed(cs.all_alleles(bases))), alleles


#: CTEs by name and what they need; ``sql`` puts those that a query names in front of it.
CTE = {
    "reads_v": ((), views.READS),
    "pileup_v": ((), views.PILEUP),
    "fastq_v": ((), views.FASTQ),
    "u": (("reads_v",), "SELECT region, umi, count(*) AS n, min(read_id) AS first_seen FROM reads_v WHERE flag = 0 GROUP BY region, umi"),
    "e": (("u",), f"SELECT a.region, a.umi AS src, b.umi AS dst FROM u a JOIN u b ON a.region = b.region AND a.umi <> b.umi AND a.n >= 2 * b.n - 1 AND hamming(a.umi, b.umi) <= {DISTANCE}"),
    "ranked": (("u",), "SELECT region, umi, row_number() OVER (PARTITION BY region ORDER BY n DESC, first_seen, umi) AS rk FROM u"),
    "reach": (("ranked", "e"), "SELECT region, umi, rk FROM ranked UNION SELECT r.region, e.dst, r.rk FROM reach r JOIN e ON r.region = e.region AND r.umi = e.src"),
    "g": (("reach", "ranked"), "SELECT x.region, x.umi, p.umi AS parent FROM (SELECT region, umi, min(rk) AS rk FROM reach GROUP BY region, umi) x JOIN ranked p ON p.region = x.region AND p.rk = x.rk"),
    "p": (("reads_v", "g"), "SELECT r.region, g.parent, r.umi, r.start AS pos, count(*) AS n FROM reads_v r JOIN g ON r.region = g.region AND r.umi = g.umi WHERE r.flag = 0 GROUP BY r.region, g.parent, r.umi, r.start"),
    "f0": (("p",), "SELECT region, parent, list({'n': n, 'pos': pos} ORDER BY n DESC, pos DESC) AS todo, CAST(NULL AS BIGINT) AS fam_pos, CAST(NULL AS BIGINT) AS fam_n FROM p GROUP BY region, parent"),
    "fr": (("f0",), f"""SELECT * FROM f0 UNION ALL
      SELECT region, parent, list_filter(todo, lambda x: abs(x.pos - todo[1].pos) > {NEAR}), todo[1].pos,
             CAST(list_sum(list_transform(list_filter(todo, lambda x: abs(x.pos - todo[1].pos) <= {NEAR}), lambda x: x.n)) AS BIGINT)
      FROM fr WHERE len(todo) > 0"""),
    "f": (("fr",), "SELECT region, parent, fam_pos, fam_n FROM fr WHERE fam_pos IS NOT NULL"),
    "nf": (("pileup_v", "g", "f"), """SELECT v.region, v.umi, v.start, g.parent, f.fam_pos, f.fam_n, abs(f.fam_pos - v.start) AS dist,
      row_number() OVER (PARTITION BY v.region, v.umi, v.start ORDER BY abs(f.fam_pos - v.start), f.fam_n DESC, f.fam_pos DESC) AS k
      FROM (SELECT DISTINCT region, umi, start FROM pileup_v) v
      JOIN g ON g.region = v.region AND g.umi = v.umi JOIN f ON f.region = g.region AND f.parent = g.parent"""),
    "near": (("nf",), "SELECT v.*, x.parent, x.fam_pos, x.fam_n, x.dist FROM pileup_v v JOIN nf x ON x.region = v.region AND x.umi = v.umi AND x.start = v.start WHERE x.k = 1"),
    "al": (("near",), f"SELECT region, pos, parent, fam_pos, fam_n, dist, ref, alt, count(*) AS n FROM near WHERE q >= {QUALITY} AND dist <= {NEAR} GROUP BY ALL"),
    "ua": (("pileup_v",), f"SELECT region, pos, ref, alt, count(*) AS n FROM pileup_v WHERE q >= {QUALITY} GROUP BY region, pos, ref, alt"),
    "per": (("al",), "SELECT region, pos, parent, fam_pos, fam_n, ref, alt, CAST(sum(n) AS BIGINT) AS n FROM al GROUP BY ALL"),
    "top": (("per",), """SELECT *, sum(n) OVER w AS reads, row_number() OVER (PARTITION BY region, pos, parent, fam_pos, fam_n ORDER BY n DESC, ref, alt) AS k
      FROM per WINDOW w AS (PARTITION BY region, pos, parent, fam_pos, fam_n)"""),
    "sized": (("top",), f"SELECT t.*, s.fam, (100.0 * n / reads >= 50 AND n >= 1) AS passes FROM top t JOIN (VALUES {', '.join(f'({s})' for s in SIZES)}) s(fam) ON t.fam_n >= s.fam WHERE k = 1"),
    "sums": (("sized",), "SELECT region, pos, fam, CAST(sum(reads) AS BIGINT) AS rawdp, count(*) FILTER (WHERE passes) AS consdp FROM sized GROUP BY region, pos, fam"),
    "cc": (("sized", "sums"), "SELECT s.region, s.pos, s.fam, s.ref, s.alt, count(*) AS n, any_value(t.rawdp) AS rawdp, any_value(t.consdp) AS consdp FROM sized s JOIN sums t ON s.region = t.region AND s.pos = t.pos AND s.fam = t.fam WHERE s.passes GROUP BY s.region, s.pos, s.fam, s.ref, s.alt"),
    "calls": (("cc", "ua"), "SELECT * FROM cc UNION ALL SELECT region, pos, 0 AS fam, ref, alt, n, CAST(sum(n) OVER w AS BIGINT), CAST(sum(n) OVER w AS BIGINT) FROM ua WINDOW w AS (PARTITION BY region, pos)"),
    "vv": (("calls",), """SELECT * FROM (SELECT region, pos, fam, ref, alt, n AS depth, n::DOUBLE / consdp * 100 AS freq, rawdp, consdp,
        coalesce(sum(n) FILTER (WHERE ref = alt) OVER (PARTITION BY region, pos, fam), 0)::DOUBLE / consdp * 100 AS ref_freq FROM calls)
      WHERE ref_freq <= 95 AND ref <> alt AND freq >= 2"""),
    "d": (("pileup_v",), "SELECT region, pos, count(*) AS depth FROM pileup_v GROUP BY region, pos"),
    "kids": (("g",), "SELECT region, parent, count(*) - 1 AS children FROM g GROUP BY region, parent"),
    "by_kids": (("kids",), "SELECT region, children, count(*) AS parents FROM kids GROUP BY region, children"),
    "qc": (("p",), """SELECT region, umi, CASE WHEN umi = parent THEN 'parent' ELSE 'children' END AS type, CAST(median(n) AS DOUBLE) AS count, parent,
        CAST(hamming(umi, parent) AS INT) AS distance, CAST(median(pos) AS DOUBLE) AS position FROM p GROUP BY region, umi, parent"""),
}


def sql(body: str, *needs: str) -> str:
    """``body`` behind the CTEs that it needs, in order."""
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for n in CTE[name][0]:
                add(n)
            order.append(name)

    for n in needs:
        add(n)
    ctes = ",\n".join(f"{n} AS ({CTE[n][1]})" for n in order)
    return f"WITH RECURSIVE {ctes}\n{body}"


# -- tallies and grouping ----------------------------------------------------------------------


@query("umi_count", sql("SELECT * FROM u", "u"))
def umi_count(spark, d):
    return gp.umi_counts(gp.usable_reads(views.reads(spark, d)))


@query("umi_count_truncated", sql("SELECT region, umi, count(*) AS n, min(read_id) AS first_seen FROM reads_v WHERE flag = 0 AND NOT (1005 <= start AND start < 2000 AND start + 30 <= 2000) GROUP BY region, umi", "reads_v"))
def umi_count_truncated(spark, d):
    return gp.umi_counts(gp.usable_reads(views.reads(spark, d), truncate=True))


@query("flag_tally", sql("""SELECT region, count(*) FILTER (WHERE (flag & 2308) = 0) AS mapped, count(*) FILTER (WHERE (flag & 4) <> 0) AS unmapped,
  count(*) FILTER (WHERE (flag & 256) <> 0) AS secondary, count(*) FILTER (WHERE (flag & 2048) <> 0) AS supplementary FROM reads_v GROUP BY region""", "reads_v"))
def flag_tally(spark, d):
    return gp.flag_tally(views.reads(spark, d))


@query("busy_regions", sql("SELECT region, count(*) AS n_reads FROM reads_v GROUP BY region HAVING count(*) > 100", "reads_v"))
def busy_regions(spark, d):
    return gp.busy_regions(views.reads(spark, d), 100)


@query("umi_edges", sql("SELECT * FROM e", "e"))
def umi_edges(spark, d):
    return gp.umi_edges(umi_count(spark, d), views.UMI_LENGTH, DISTANCE)


@query("umi_groups", sql("SELECT * FROM g", "g"))
def umi_groups(spark, d):
    return _families(spark, d)["groups"]


@query("group_summary", sql("""SELECT region, CAST(sum(parents) AS BIGINT) AS ptu, CAST(sum(children * parents) AS BIGINT) AS ctu,
  string_agg(CAST(children AS VARCHAR), ',' ORDER BY children) AS child_nums, string_agg(CAST(parents AS VARCHAR), ',' ORDER BY children) AS freq_parents
  FROM by_kids GROUP BY region""", "by_kids"))
def group_summary(spark, d):
    out = gp.group_summary(umi_groups(spark, d))
    return out.withColumns({c: F.concat_ws(",", F.col(c).cast("array<string>")) for c in ("child_nums", "freq_parents")})


@query("umi_positions", sql("SELECT * FROM p", "p"))
def umi_positions(spark, d):
    return _families(spark, d)["positions"]


@query("umi_families", sql("SELECT * FROM f", "f"))
def umi_families(spark, d):
    return _families(spark, d)["families"]


@query("umi_families_dominant", sql("SELECT region, parent, fam_pos, fam_n FROM (SELECT *, row_number() OVER (PARTITION BY region, parent ORDER BY fam_n DESC, fam_pos DESC) AS k FROM f) WHERE k = 1", "f"))
def umi_families_dominant(spark, d):
    return gp.dominant_families(umi_families(spark, d))


@query("qc_relationships", sql("SELECT * FROM qc", "qc"))
def qc_relationships(spark, d):
    return gp.qc_relationships(umi_positions(spark, d)).withColumn("position", F.col("position").cast("double"))


# -- collapse ----------------------------------------------------------------------------------


@query("nearest_family", sql("SELECT read_id, region, umi, start, pos, ref, alt, q, parent, fam_pos, fam_n, dist FROM near", "near"))
def nearest_family(spark, d):
    f = _families(spark, d)
    out = cs.nearest_family(views.pileup(spark, d), f["groups"], f["families"])
    return out.select("read_id", "region", "umi", "start", "pos", "ref", "alt", "q", "parent", "fam_pos", "fam_n", "dist")


@query("family_allele_counts", sql("SELECT * FROM al", "al"))
def family_allele_counts(spark, d):
    return _alleles(spark, d)


@query("uncollapsed_alleles", sql("SELECT * FROM ua", "ua"))
def uncollapsed_alleles(spark, d):
    return cs.uncollapsed_alleles(views.pileup(spark, d), QUALITY)


@query("consensus", sql("SELECT * FROM calls", "calls"))
def consensus(spark, d):
    return _calls(spark, d)


@query("family_sizes", sql(f"""SELECT region, pos, fam, min(m) AS min_fam, CAST(avg(m) AS DOUBLE) AS mean_fam
  FROM (SELECT region, pos, parent, dist, max(fam_n) AS m FROM al GROUP BY region, pos, parent, dist) x
  JOIN (VALUES {', '.join(f'({s})' for s in SIZES)}) s(fam) ON m >= fam GROUP BY region, pos, fam""", "al"))
def family_sizes(spark, d):
    return cs.family_sizes(_alleles(spark, d), SIZES)


_WIDE = ",\n  ".join(f"CAST(coalesce(sum(n) FILTER (WHERE length(ref) = 1 AND length(alt) = 1 AND alt = '{b}'), 0) AS BIGINT) AS \"{b}\"" for b in "ACGTN")


@query("consensus_wide", sql(f"""SELECT region, pos, fam, min(substr(ref, 1, 1)) AS ref, {_WIDE},
  coalesce(string_agg(concat(n, ':', ref, '>', alt), ';' ORDER BY n, ref, alt) FILTER (WHERE length(alt) > 1), '') AS insertions,
  coalesce(string_agg(concat(n, ':', ref, '>', alt), ';' ORDER BY n, ref, alt) FILTER (WHERE length(ref) > 1), '') AS deletions,
  max(rawdp) AS rawdp, max(consdp) AS consdp,
  coalesce(sum(n) FILTER (WHERE ref = alt AND length(ref) = 1), 0)::DOUBLE / max(consdp) * 100 AS ref_freq FROM calls GROUP BY region, pos, fam""", "calls"))
def consensus_wide(spark, d):
    out = cs.consensus_wide(_calls(spark, d))
    text = lambda c: F.concat_ws(";", F.transform(c, lambda x: F.concat(x["n"].cast("string"), F.lit(":"), x["ref"], F.lit(">"), x["alt"])))
    return out.withColumns({c: text(c) for c in ("insertions", "deletions")})


@query("coverage_mean", sql(f"SELECT region, CAST(avg(depth) AS DOUBLE) AS mean_depth FROM (SELECT region, pos, count(*) FILTER (WHERE q >= {QUALITY}) AS depth FROM pileup_v GROUP BY region, pos) GROUP BY region", "pileup_v"))
def coverage_mean(spark, d):
    return cs.mean_coverage(views.pileup(spark, d), QUALITY)


@query("coverage_running", sql(f"""SELECT region, CAST(avg(run) AS DOUBLE) AS mean_depth FROM (SELECT region,
  sum(CASE WHEN q >= {QUALITY} THEN 1 ELSE 0 END) OVER (PARTITION BY region, pos ORDER BY read_id, q, umi, start ROWS UNBOUNDED PRECEDING) AS run FROM pileup_v) GROUP BY region""", "pileup_v"))
def coverage_running(spark, d):
    return cs.running_coverage(views.pileup(spark, d), QUALITY)


@query("islands", sql("""SELECT region, min(pos) + 1 AS start, max(pos) + 1 AS "end" FROM
  (SELECT region, pos, pos - row_number() OVER (PARTITION BY region ORDER BY pos) AS k FROM d WHERE depth >= 5) GROUP BY region, k HAVING max(pos) + 1 - min(pos) >= 2""", "d"))
def islands(spark, d):
    return cs.islands(cs.depths(views.pileup(spark, d)), 5, 2)


# -- variants and merge ------------------------------------------------------------------------


@query("variants", sql("SELECT * FROM vv", "vv"))
def variants(spark, d):
    return vr.variants(_calls(spark, d)).drop("ref_depth", "mean_fam")


@query("variant_filter", sql("SELECT region, pos, fam, ref, alt, depth, CASE WHEN depth >= 10 THEN 'PASS' ELSE 'a10' END AS filter FROM vv", "vv"))
def variant_filter(spark, d):
    return vr.labelled(variants(spark, d)).select("region", "pos", "fam", "ref", "alt", "depth", "filter")


#: The rounding of text fields, in arithmetic that engines do alike.
_ROUND = "CAST(floor({x} * {k} + 0.5) / {k} AS VARCHAR)"
_ORDER = "ORDER BY instr('ACGTN', alt), alt"


@query("vcf_records", sql(f"""SELECT v.region AS contig, v.pos + 1 AS pos, v.fam, v.ref, string_agg(alt, ',' {_ORDER}) AS alt,
  CASE WHEN max(depth) >= 10 THEN 'PASS' ELSE 'a10' END AS filter,
  concat('RDP=', max(v.rawdp), ';CDP=', max(v.consdp), ';MIF=', v.fam, ';MNF=', {_ROUND.format(x="coalesce(max(s.mean_fam), 0.0::DOUBLE)", k=100)}, ';AD=', max(r.ref_depth),
         ';AL=', string_agg(CAST(depth AS VARCHAR), ',' {_ORDER}), ';AF=', string_agg({_ROUND.format(x="freq", k=10000)}, ',' {_ORDER})) AS info
  FROM vv v JOIN (SELECT region, pos, fam, CAST(coalesce(sum(n) FILTER (WHERE ref = alt AND length(ref) = 1), 0) AS BIGINT) AS ref_depth FROM calls GROUP BY region, pos, fam) r
    ON r.region = v.region AND r.pos = v.pos AND r.fam = v.fam
  LEFT JOIN (SELECT region, pos, s.fam, CAST(avg(m) AS DOUBLE) AS mean_fam FROM (SELECT region, pos, parent, dist, max(fam_n) AS m FROM al GROUP BY region, pos, parent, dist) x
    JOIN (VALUES {', '.join(f'({s})' for s in SIZES)}) s(fam) ON m >= s.fam GROUP BY region, pos, s.fam) s ON s.region = v.region AND s.pos = v.pos AND s.fam = v.fam
  GROUP BY v.region, v.pos, v.fam, v.ref, CASE WHEN length(v.ref) = 1 AND length(alt) = 1 THEN '' ELSE concat(v.ref, '>', alt) END""", "vv", "calls", "al"))
def vcf_records(spark, d):
    calls, alleles = _calls_and_alleles(spark, d)
    calls = cs.with_mean_family(calls, cs.family_sizes(alleles, SIZES))
    out = vr.vcf_records(vr.variants(calls))
    return out.select(F.col("`#CHROM`").alias("contig"), F.col("POS").alias("pos"), "fam", F.col("REF").alias("ref"), F.col("ALT").alias("alt"), F.col("FILTER").alias("filter"), F.col("INFO").alias("info"))


_REGIONS = 'SELECT DISTINCT region AS contig, CAST(floor(start / 170) * 170 + 5 AS BIGINT) AS start, CAST(floor(start / 170) * 170 + 95 AS BIGINT) AS "end" FROM reads_v'


@query("region_reads", sql(f"""SELECT concat(g.contig, ':', g.start + 1, '-', g."end") AS region, count(*) AS n_reads
  FROM ({_REGIONS}) g JOIN reads_v r ON r.region = g.contig AND r.start < g."end" AND r.start + 30 > g.start GROUP BY 1""", "reads_v"))
def region_reads(spark, d):
    reads = views.reads(spark, d).withColumnRenamed("region", "contig").select("contig", "start", "end")
    at = (F.floor(F.col("start") / 170) * 170).cast("bigint")
    regions = reads.select("contig", (at + 5).alias("start"), (at + 95).alias("end")).distinct()
    return pl.region_read_counts(reads, regions)


@query("covered_intervals", sql("""SELECT region, min(pos) + 1 AS start, max(pos) + 1 AS "end" FROM
  (SELECT region, pos, pos - row_number() OVER (PARTITION BY region ORDER BY pos) AS k FROM
    (SELECT region, pos FROM (SELECT region, unnest(generate_series(CAST(start AS BIGINT), CAST(start + 29 AS BIGINT))) AS pos FROM reads_v) GROUP BY region, pos HAVING count(*) >= 35))
  GROUP BY region, k HAVING max(pos) + 1 - min(pos) >= 10""", "reads_v"))
def covered_intervals(spark, d):
    reads = views.reads(spark, d).withColumnRenamed("region", "contig").withColumn("cigar", F.lit("30M"))
    return commands.bed(reads, 35, 10)


@query("family_size_track", sql(f"""SELECT region, fam, pos, CAST(avg(m) AS DOUBLE) AS mean_fam
  FROM (SELECT region, pos, parent, dist, max(fam_n) AS m FROM al GROUP BY region, pos, parent, dist) x
  JOIN (VALUES {', '.join(f'({s})' for s in SIZES)}) s(fam) ON m >= fam
  WHERE EXISTS (SELECT 1 FROM calls c WHERE c.region = x.region AND c.pos = x.pos AND c.fam = s.fam) GROUP BY region, fam, pos""", "al", "calls"))
def family_size_track(spark, d):
    calls, alleles = _calls_and_alleles(spark, d)
    wide = cs.consensus_wide(calls, cs.family_sizes(alleles, SIZES))
    return sm.family_size_track(wide).select("region", "fam", "pos", "mean_fam")


@query("merge_dedup", sql("""SELECT contig, pos, fam, region_start, ref, alt, n FROM (SELECT region AS contig, pos, ref AS fam, start AS region_start, ref, alt, count(*) AS n,
  row_number() OVER (PARTITION BY region, pos, ref ORDER BY start, ref, alt, count(*)) AS k FROM pileup_v GROUP BY region, pos, ref, start, alt) WHERE k = 1""", "pileup_v"))
def merge_dedup(spark, d):
    rows = views.pileup(spark, d).groupBy(F.col("region").alias("contig"), "pos", F.col("ref").alias("fam"), F.col("start").alias("region_start"), "ref", "alt").agg(F.count(F.lit(1)).alias("n"))
    return mg.merge_consensus(rows)


@query("unique_keys", sql("SELECT region, pos, ref, count(*) AS n FROM ua GROUP BY region, pos, ref HAVING count(*) > 1", "ua"))
def unique_keys(spark, d):
    return mg.unique_keys(uncollapsed_alleles(spark, d), ("region", "pos", "ref"))


# -- summaries ---------------------------------------------------------------------------------


@query("family_read_depth", sql("SELECT DISTINCT region, parent, fam_pos, fam_n AS depth FROM f", "f"))
def family_read_depth(spark, d):
    return sm.family_read_depth(umi_families(spark, d))


@query("family_umi_size", sql(f"SELECT p.region, p.parent, f.fam_pos, count(DISTINCT p.umi) AS umis FROM p JOIN f ON p.region = f.region AND p.parent = f.parent AND abs(p.pos - f.fam_pos) <= {NEAR} GROUP BY p.region, p.parent, f.fam_pos", "p", "f"))
def family_umi_size(spark, d):
    f = _families(spark, d)
    return sm.family_umi_size(f["positions"], f["families"], NEAR)


@query("size_depth_correlation", sql(f"""SELECT x.region, corr(umis, depth) AS r FROM (SELECT p.region, p.parent, f.fam_pos, count(DISTINCT p.umi) AS umis, any_value(f.fam_n) AS depth
  FROM p JOIN f ON p.region = f.region AND p.parent = f.parent AND abs(p.pos - f.fam_pos) <= {NEAR} GROUP BY p.region, p.parent, f.fam_pos) x GROUP BY x.region""", "p", "f"))
def size_depth_correlation(spark, d):
    f = _families(spark, d)
    both = sm.size_and_depth(sm.family_umi_size(f["positions"], f["families"], NEAR), sm.family_read_depth(f["families"]))
    return sm.correlation(both, "umis", "depth")


@query("dominant_split", sql("SELECT region, parent, fam_pos, fam_n, CASE WHEN row_number() OVER (PARTITION BY region, parent ORDER BY fam_n DESC, fam_pos DESC) = 1 THEN 'dominant' ELSE 'other' END AS kind FROM f", "f"))
def dominant_split(spark, d):
    return sm.dominant_split(umi_families(spark, d))


@query("umi_occurrence", sql("SELECT region, umi, count, distance = 0 AS parents_only FROM qc", "qc"))
def umi_occurrence(spark, d):
    return sm.umi_occurrence(qc_relationships(spark, d))


@query("degree_histogram", sql("""SELECT s.region, s.degree, count(x.umi) AS nodes FROM
  (SELECT region, unnest(generate_series(0, max(degree))) AS degree FROM (SELECT u.region, u.umi, (SELECT count(*) FROM e WHERE e.region = u.region AND e.src = u.umi)
     + (SELECT count(*) FROM e WHERE e.region = u.region AND e.dst = u.umi) AS degree FROM u) GROUP BY region) s
  LEFT JOIN (SELECT u.region, u.umi, (SELECT count(*) FROM e WHERE e.region = u.region AND e.src = u.umi)
     + (SELECT count(*) FROM e WHERE e.region = u.region AND e.dst = u.umi) AS degree FROM u) x ON x.region = s.region AND x.degree = s.degree GROUP BY s.region, s.degree""", "u", "e"))
def degree_histogram(spark, d):
    counts = umi_count(spark, d)
    return sm.degree_histogram(gp.umi_edges(counts, views.UMI_LENGTH, DISTANCE), counts)


@query("network_edges", sql("SELECT region, parent, umi AS child FROM g WHERE umi <> parent UNION ALL SELECT region, parent, NULL FROM kids WHERE children = 0", "g", "kids"))
def network_edges(spark, d):
    return sm.network_edges(umi_groups(spark, d))


@query("parent_freq", sql("SELECT region, children, parents::DOUBLE / sum(parents) OVER (PARTITION BY region) AS share FROM by_kids", "by_kids"))
def parent_freq(spark, d):
    return sm.parent_frequency(gp.group_summary(umi_groups(spark, d)))


@query("region_rank", sql("SELECT region, count(*) AS ptu, CAST(sum(children) AS BIGINT) AS ctu, sum(children)::DOUBLE / count(*) AS children_per_parent FROM kids GROUP BY region", "kids"))
def region_rank(spark, d):
    return sm.region_totals(gp.group_summary(umi_groups(spark, d)))


_HIST = """SELECT h.region, h.bin, lo + h.bin * w AS low, lo + (h.bin + 1) * w AS high, count(*) AS n FROM
  (SELECT x.region, s.lo, s.w, CAST(least(floor((x.v - s.lo) / s.w), {last}) AS BIGINT) AS bin FROM ({rows}) x JOIN
   (SELECT region, min(v)::DOUBLE AS lo, (max(v)::DOUBLE - min(v)::DOUBLE) / {bins} AS w FROM ({rows}) GROUP BY region) s ON s.region = x.region) h GROUP BY h.region, h.bin, lo, w"""


@query("depth_histogram", sql(_HIST.format(rows="SELECT region, depth AS v FROM d", bins=20, last=19), "d"))
def depth_histogram(spark, d):
    return sm.histogram(cs.depths(views.pileup(spark, d)), "depth", 20)


@query("family_size_histogram", sql(_HIST.format(rows="SELECT region, fam_n AS v FROM f", bins=15, last=14), "f"))
def family_size_histogram(spark, d):
    return sm.histogram(umi_families(spark, d), "fam_n", 15)


@query("depth_density", sql("""SELECT g.region, x, sum(c * exp(-0.5 * ((x - v) / h) * ((x - v) / h))) / (n * h * 2.5066282746310002) AS density FROM
  (SELECT region, n, h, lo - 3 * h + k * (hi - lo + 6 * h) / 99 AS x FROM
    (SELECT region, count(*) AS n, min(depth)::DOUBLE AS lo, max(depth)::DOUBLE AS hi, greatest(coalesce(stddev_samp(depth), 0) * pow(count(*)::DOUBLE, -0.2), 1e-9) AS h FROM d GROUP BY region) s,
    generate_series(0, 99) t(k)) g
  JOIN (SELECT region, depth::DOUBLE AS v, count(*) AS c FROM d GROUP BY region, depth) w ON w.region = g.region GROUP BY g.region, x, n, h""", "d"))
def depth_density(spark, d):
    return sm.density(cs.depths(views.pileup(spark, d)), "depth")


@query("sem_coverage", sql("SELECT region, CAST(avg(depth) AS DOUBLE) AS mean, stddev_samp(depth) / sqrt(count(*)::DOUBLE) AS sem FROM d GROUP BY region", "d"))
def sem_coverage(spark, d):
    return sm.coverage_stats(cs.depths(views.pileup(spark, d)))


@query("mapping_proportions", sql("""SELECT *, mapped::DOUBLE / (mapped + unmapped + secondary + supplementary) * 100 AS mapped_pct,
  (unmapped + secondary + supplementary)::DOUBLE / (mapped + unmapped + secondary + supplementary) * 100 AS other_pct FROM (
  SELECT region, count(*) FILTER (WHERE (flag & 2308) = 0) AS mapped, count(*) FILTER (WHERE (flag & 4) <> 0) AS unmapped,
  count(*) FILTER (WHERE (flag & 256) <> 0) AS secondary, count(*) FILTER (WHERE (flag & 2048) <> 0) AS supplementary FROM reads_v GROUP BY region)""", "reads_v"))
def mapping_proportions(spark, d):
    return sm.mapping_proportions(flag_tally(spark, d))


@query("consensus_depth", sql("SELECT region, fam, pos, max(CASE WHEN fam = 0 THEN rawdp ELSE consdp END) AS depth FROM calls GROUP BY region, fam, pos", "calls"))
def consensus_depth(spark, d):
    return sm.consensus_depth(cs.consensus_wide(_calls(spark, d)))


@query("non_reference", sql("SELECT region, fam, pos, 100 - coalesce(sum(n) FILTER (WHERE ref = alt AND length(ref) = 1), 0)::DOUBLE / max(consdp) * 100 AS non_ref_freq FROM calls GROUP BY region, fam, pos", "calls"))
def non_reference(spark, d):
    return sm.non_reference(cs.consensus_wide(_calls(spark, d)))


@query("filled_positions", sql("""SELECT p.region, p.pos, s.fam, coalesce(max(c.consdp), 0) AS consdp FROM (SELECT DISTINCT region, pos FROM calls) p
  JOIN (SELECT DISTINCT region, fam FROM calls) s ON s.region = p.region LEFT JOIN calls c ON c.region = p.region AND c.pos = p.pos AND c.fam = s.fam GROUP BY p.region, p.pos, s.fam""", "calls"))
def filled_positions(spark, d):
    return sm.filled_positions(cs.consensus_wide(_calls(spark, d)), "consdp")


@query("low_coverage", sql("SELECT region, CAST(avg(depth) AS DOUBLE) AS mean, stddev_samp(depth) / sqrt(count(*)::DOUBLE) AS sem, CASE WHEN avg(depth) < 50 THEN 'Low' ELSE 'High' END AS label FROM d GROUP BY region", "d"))
def low_coverage(spark, d):
    return sm.low_or_high(sem_coverage(spark, d), "mean", 50)


# -- preprocess --------------------------------------------------------------------------------


@cache
def _ok() -> str:
    return "starts_with(substr(upper(seq), 9), 'ATGGG')"


def _extracted(spark: SparkSession, d: str) -> DataFrame:
    return pp.extract(pp.zip_mates([views.fastq(spark, d)]), PREP)


@query("umi_extract", sql(f"SELECT ord, substr(seq, 1, 8) AS umi, {_ok()} AS correct FROM fastq_v", "fastq_v"))
def umi_extract(spark, d):
    return _extracted(spark, d).select("ord", "umi", "correct")


@query("spacer_filter", sql(f"SELECT count(*) AS total, count(*) FILTER (WHERE {_ok()}) AS correct, count(*) FILTER (WHERE NOT {_ok()}) AS incorrect, CAST(min(length(seq)) AS INT) AS length_read1 FROM fastq_v", "fastq_v"))
def spacer_filter(spark, d):
    return pp.totals(_extracted(spark, d), PREP)


@query("umi_histogram", sql(f"SELECT substr(seq, 1, 8) AS umi, count(*) AS count FROM fastq_v WHERE {_ok()} GROUP BY 1", "fastq_v"))
def umi_histogram(spark, d):
    return pp.umi_histogram(_extracted(spark, d))


@query("reheader", sql(f"SELECT ord, concat(split_part(name, ' ', 1), ':', substr(seq, 1, 8), ' ', split_part(name, ' ', 2)) AS name, substr(seq, 14) AS seq, plus, substr(qual, 14) AS qual FROM fastq_v WHERE {_ok()}", "fastq_v"))
def reheader(spark, d):
    return pp.reheadered(_extracted(spark, d), PREP).select("ord", "out1.*")


@query("read_proportions", sql(f"""SELECT *, correct::DOUBLE / total * 100 AS correct_pct, incorrect::DOUBLE / total * 100 AS incorrect_pct FROM (
  SELECT count(*) AS total, count(*) FILTER (WHERE {_ok()}) AS correct, count(*) FILTER (WHERE NOT {_ok()}) AS incorrect, CAST(min(length(seq)) AS INT) AS length_read1 FROM fastq_v)""", "fastq_v"))
def read_proportions(spark, d):
    return sm.read_proportions(spacer_filter(spark, d))


@query("umi_from_name", sql("SELECT ord, upper(split_part(split_part(concat(name, ':', lower(substr(seq, 1, 8))), ' ', 2), ':', -1)) AS umi FROM fastq_v", "fastq_v"))
def umi_from_name(spark, d):
    name = F.concat(F.lit("x:"), F.lower(F.substring("seq", 1, 8)), F.lit(" "), F.col("name"))
    return views.fastq(spark, d).select("ord", sq.umi_from_name(name).alias("umi"))


@query("chrom_sort", "SELECT c AS contig, row_number() OVER (ORDER BY try_cast(replace(c, 'chr', '') AS INT) IS NULL, try_cast(replace(c, 'chr', '') AS INT), c) AS place FROM (SELECT DISTINCT concat('chr', CASE WHEN s_nationkey < 20 THEN CAST(s_nationkey AS VARCHAR) ELSE concat('X', CAST(s_nationkey AS VARCHAR)) END) AS c FROM supplier)")
def chrom_sort(spark, d):
    from pyspark.sql import Window

    nation = F.col("s_nationkey").cast("string")
    contigs = spark.read.parquet(f"{d}/supplier.parquet").select(F.concat(F.lit("chr"), F.when(F.col("s_nationkey") < 20, nation).otherwise(F.concat(F.lit("X"), nation))).alias("contig")).distinct()
    return contigs.withColumn("place", F.row_number().over(Window.orderBy(*sq.contig_order(F.col("contig")))).cast("bigint"))


CAP = 4


@query("depth_cap", sql(f"SELECT region, pos, count(*) AS depth, sum(q) AS q, max(read_id) AS last_read FROM (SELECT *, row_number() OVER (PARTITION BY region, pos ORDER BY read_id) AS nth FROM pileup_v) WHERE nth <= {CAP} GROUP BY region, pos", "pileup_v"))
def depth_cap(spark, d):
    kept = pl.capped(durable(views.pileup(spark, d)), CAP)
    return kept.groupBy("region", "pos").agg(F.count(F.lit(1)).alias("depth"), F.sum("q").alias("q"), F.max("read_id").alias("last_read"))


@query("allele_text", sql("SELECT DISTINCT region, pos, ref, alt FROM pileup_v WHERE length(ref) + length(alt) > 2", "pileup_v"))
def allele_text(spark, d):
    """Indels of a position written as text and read again."""
    indels = views.pileup(spark, d).where("length(ref) + length(alt) > 2")
    text = indels.groupBy("region", "pos").agg(sq.pair_text(F.array_sort(F.collect_set(F.struct("ref", "alt")))).alias("text"))
    return text.select("region", "pos", F.inline(sq.text_pairs(F.col("text"))))


@query("unknown_contigs", "SELECT DISTINCT concat('chr', CAST(l_suppkey % 40 AS VARCHAR)) AS contig FROM lineitem WHERE l_suppkey % 40 NOT IN (SELECT n_nationkey FROM nation)")
def unknown_contigs(spark, d):
    contig = lambda c: F.concat(F.lit("chr"), c.cast("string")).alias("contig")
    regions = spark.read.parquet(f"{d}/lineitem.parquet").select(contig(F.col("l_suppkey") % 40))
    return commands.unknown_contigs(regions, spark.read.parquet(f"{d}/nation.parquet").select(contig(F.col("n_nationkey"))))


@query("region_format", sql("SELECT DISTINCT concat(region, ':', CAST(start + 1 AS VARCHAR), '-', CAST(start + 30 AS VARCHAR)) AS name, region AS contig, CAST(start AS BIGINT) AS start, CAST(start + 30 AS BIGINT) AS \"end\" FROM reads_v", "reads_v"))
def region_format(spark, d):
    names = views.reads(spark, d).select(sq.region_text(F.col("region"), F.col("start"), F.col("end")).alias("name")).distinct()
    return names.select("name", sq.region_struct(F.col("name")).alias("x")).select("name", "x.*")


@query("mate_zip", sql("SELECT a.ord, a.seq AS seq1, upper(b.seq) AS seq2 FROM fastq_v a JOIN fastq_v b ON a.ord = b.ord AND b.ord % 3 <> 0", "fastq_v"))
def mate_zip(spark, d):
    reads = views.fastq(spark, d)
    mates = pp.zip_mates([reads, reads.where("ord % 3 <> 0").withColumn("seq", F.upper("seq"))])
    return mates.select("ord", F.col("r1.seq").alias("seq1"), F.col("r2.seq").alias("seq2"))


@query("file_prefix", "SELECT o_orderkey, concat('run', CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderkey % 3 = 2 THEN '.fastq' ELSE '' END) AS prefix FROM orders")
def file_prefix(spark, d):
    end = F.element_at(F.array(F.lit(".fastq.gz"), F.lit(".fq.gz"), F.lit(".fastq")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    path = F.concat(F.lit("/data/a.fq.gz.d/run"), F.col("o_orderkey").cast("string"), end)
    return spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", sq.file_prefix(path).alias("prefix"))
