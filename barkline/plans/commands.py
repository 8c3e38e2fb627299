"""The commands as plans over all regions at once: reads in, result folders out."""

from __future__ import annotations

import os
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barkline.functions.sequences import contig_order, file_prefix, region_text, umi_from_name
from barkline.operators import consensus as cs
from barkline.operators import grouping as gp
from barkline.operators import merge as mg
from barkline.operators import pileup as pl
from barkline.operators import preprocess as pp
from barkline.operators import sinks, summaries as sm
from barkline.operators import variants as vr
from barkline.session import durable
from barkline.sources import alignments as al
from barkline.sources import tables
from barkline.sources.config import Settings

#: Folders of a run.
FOLDERS = ("Umifiles", "Consfiles", "Datafiles", "VCFfiles", "Stats", "Figures", "Report", "Coverage")


def make_folders(outdir: str) -> dict[str, str]:
    out = {f: os.path.join(outdir, f) for f in FOLDERS}
    for path in out.values():
        os.makedirs(path, exist_ok=True)
    return out


def read_alignments(spark: SparkSession, path: str, regions: DataFrame | None = None) -> DataFrame:
    """BAM through the data source (with an index only what ``regions`` need), SAM text, or a Parquet table of the same columns."""
    if path.endswith(".bam"):
        return al.bam(spark, path, regions)
    return al.sam(spark, path) if path.endswith(".sam") else spark.read.parquet(path)


def header_contigs(spark: SparkSession, path: str) -> DataFrame | None:
    """(contig, length) of the header of BAM or SAM files; a table of reads has none."""
    if path.endswith(".bam"):
        return al.bam_contigs(spark, path)
    return al.sam_contigs(spark, path) if path.endswith(".sam") else None


def unknown_contigs(regions: DataFrame, contigs: DataFrame) -> DataFrame:
    return regions.join(contigs, "contig", "left_anti").select("contig").distinct()


def checked_regions(regions: DataFrame, contigs: DataFrame | None) -> DataFrame:
    """``regions``, if the header has the contig of each; raises before any read is scanned."""
    if contigs is None or contigs.isEmpty():
        return regions
    unknown = unknown_contigs(regions, contigs).orderBy("contig").limit(20).collect()
    if unknown:
        known = [r["contig"] for r in contigs.select("contig").distinct().orderBy(*contig_order(F.col("contig"))).limit(200).collect()]
        raise ValueError(f"{', '.join(r['contig'] for r in unknown)} not among the contigs of the header: {', '.join(known)}")
    return regions


def region_names(regions: DataFrame) -> list[str]:
    """Names of the regions that a command was asked for, a list of targets."""
    return [r[0] for r in regions.select(region_text(F.col("contig"), F.col("start"), F.col("end"))).distinct().collect()]


def preprocess(spark: SparkSession, paths: list[str], prep: pp.Prep, outdir: str, prefix: str | None = "reads") -> DataFrame:
    """Write reheadered and discarded FASTQ, totals and barcode counts; returns the totals.

    Where the prefix is None the first file's name gives it.
    """
    if prefix is None:
        prefix = spark.range(1).select(file_prefix(F.lit(paths[0]))).first()[0]
    if len(paths) != prep.input_reads:
        raise ValueError(f"{prep.name} needs {prep.input_reads} files, {len(paths)} were given")
    extracted = durable(pp.extract(pp.zip_mates([al.fastq(spark, p) for p in paths]), prep))
    good = pp.reheadered(extracted, prep)
    for k in range(1, prep.output_reads + 1):
        sinks.fastq(good, f"out{k}", f"{outdir}/{prefix}_reheadered_R{k}")
    if prep.spacer:
        bad = extracted.where(~F.col("correct"))
        for k in range(1, prep.input_reads + 1):
            sinks.fastq(bad, f"r{k}", f"{outdir}/{prefix}_discarded_R{k}")
    totals = pp.totals(extracted, prep)
    sinks.json_rows(totals, f"{outdir}/Processing_Read_Info")
    sinks.tsv(pp.umi_histogram(extracted).select(F.col("umi").alias("Umi"), F.col("count").alias("Count")), f"{outdir}/Umi_counts")
    return totals


def bed(alignments: DataFrame, min_depth: int, min_size: int, max_depth: int = 1_000_000, ignore_orphans: bool = False, stepper: str = "nofilter") -> DataFrame:
    """(region = contig, start, end) of covered intervals, 1-based inclusive; a column counts ``max_depth`` reads at most."""
    reads = pl.stepped(alignments, stepper, ignore_orphans).where("contig IS NOT NULL AND cigar IS NOT NULL AND cigar <> '*'").where("end > start")
    # the depth at a position from starts and ends, an event table instead of a row a base; each bin that a
    # read touches has an event at its start
    borders = F.transform(F.sequence(F.floor(F.col("start") / cs.BIN), F.floor((F.col("end") - 1) / cs.BIN)), lambda b: F.struct((b * cs.BIN).alias("at"), F.lit(0).alias("step")))
    ends = F.array(F.struct(F.col("start").cast("bigint").alias("at"), F.lit(1).alias("step")), F.struct(F.col("end").cast("bigint").alias("at"), F.lit(-1).alias("step")))
    events = reads.select("contig", F.inline(F.concat(ends, borders)))
    steps = events.groupBy("contig", "at").agg(F.sum("step").alias("step")).withColumn("bin", F.floor(F.col("at") / cs.BIN))
    return _deep_intervals(steps, min_depth, min_size, max_depth)


def _deep_intervals(steps: DataFrame, min_depth: int, min_size: int, max_depth: int) -> DataFrame:
    """Depths are summed within bins of a contig and, for what enters a bin, over bins."""
    before = Window.partitionBy("contig").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    entering = steps.groupBy("contig", "bin").agg(F.sum("step").alias("sum")).select("contig", "bin", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("contig", "bin").orderBy("at")
    runs = steps.withColumns({"depth": F.sum("step").over(order.rowsBetween(Window.unboundedPreceding, 0)), "next": F.coalesce(F.lead("at").over(order), (F.col("bin") + 1) * cs.BIN)})
    deep = runs.join(entering, ["contig", "bin"]).where(F.least(F.col("depth") + F.col("base"), F.lit(max_depth)) >= min_depth)
    deep = deep.withColumn("new", F.coalesce((F.lag("next").over(order) < F.col("at")).cast("int"), F.lit(1))).withColumn("k", F.sum("new").over(order))
    whole = deep.groupBy(F.col("contig").alias("region"), "bin", "k").agg(F.min("at").alias("a"), (F.max("next") - 1).alias("b"))
    return cs.joined_runs(whole.drop("k"), min_size)


def region_reads(alignments: DataFrame, regions: DataFrame, separator: str = ":", read_count: int = 0) -> DataFrame:
    """Reads of regions that have more than ``read_count`` reads, with their barcodes."""
    hit = pl.in_regions(alignments, regions).withColumn("umi", umi_from_name(F.col("qname"), separator))
    if read_count <= 0:
        return hit
    return hit.join(gp.busy_regions(hit, read_count).select("region"), "region", "left_semi")


def group(reads: DataFrame, settings: Settings, ignore_others: bool = False, truncate: bool = False) -> dict[str, DataFrame]:
    """Counts, flags, groups, positions, families, summary and relations of all regions."""
    length = reads.agg(F.max(F.length("umi"))).first()[0] or 1
    out = gp.get_families(reads, length, settings.distance, settings.position, ignore_others, truncate)
    return out | {"summary": gp.group_summary(out["groups"]), "relations": gp.qc_relationships(out["positions"])}


def write_group(found: dict[str, DataFrame], folders: dict[str, str], regions: list[str] | None = None) -> None:
    """Write a grouping, in place of earlier results of the same regions only."""
    sinks.datafile(found["summary"], f"{folders['Datafiles']}/datafile", regions)
    sinks.families_json(found["groups"], found["families"], f"{folders['Umifiles']}/families", regions)
    sinks.relationships(found["relations"], f"{folders['Stats']}/UMI_relationships", regions)
    sinks.positions_json(found["positions"], f"{folders['Stats']}/Umis_before_grouping", regions)
    sinks.mapped_counts_json(found["flags"], f"{folders['Stats']}/Mapped_read_counts", regions)


def write_collapse(made: dict[str, DataFrame], folders: dict[str, str], regions: list[str] | None = None) -> None:
    """Write consensus rows and coverage, in place of earlier results of the same regions only."""
    sinks.consensus(made["consensus"], f"{folders['Consfiles']}/consensus", regions)
    sinks.coverage(made["coverage"], f"{folders['Coverage']}/coverage", regions)


def collapse(reads: DataFrame, groups: DataFrame, families: DataFrame, settings: Settings, separator: str = ":", truncate: bool = False, stepper: str = "nofilter", ignore_orphans: bool = False, max_depth: int = 1_000_000) -> dict[str, DataFrame]:
    """Consensus calls of every family size (0 included), their wide rows, and mean coverage.

    A column counts its first ``max_depth`` reads.
    """
    seen = gp.usable_reads(pl.stepped(reads, stepper, ignore_orphans))
    piled = pl.capped(durable(pl.pileup(seen, separator, truncate)), max_depth)
    bases = durable(cs.base_counts(piled, settings.quality))
    alleles = durable(cs.family_alleles(bases, groups, families, settings.position))
    calls = cs.consensus(alleles, list(settings.sizes), settings.percent, settings.count).unionByName(cs.uncollapsed(cs.all_alleles(bases)))
    calls = durable(calls)
    sizes = cs.family_sizes(alleles, list(settings.sizes))
    wide = cs.consensus_wide(calls, sizes)
    calls = cs.with_mean_family(calls, sizes)
    return {"calls": calls, "consensus": wide, "coverage": cs.mean_coverage(piled, settings.quality)}


def call(calls: DataFrame, settings: Settings, contig: str = "region") -> DataFrame:
    """VCF records of every family size."""
    found = vr.variants(calls, settings.ref, settings.alt)
    chrom = F.split(F.col(contig), ":")[0]
    return vr.vcf_records(found.withColumn(contig, chrom), contig, settings.filter)


def run(spark: SparkSession, alignment_path: str, bed_path: str, outdir: str, settings: Settings = Settings(), reference: str = "", **options) -> dict[str, DataFrame]:
    """All steps for the regions of a BED file, as one application: regions are rows, not jobs."""
    folders = make_folders(outdir)
    regions = checked_regions(tables.bed(spark, bed_path), header_contigs(spark, alignment_path))
    names = region_names(regions)
    reads = durable(region_reads(read_alignments(spark, alignment_path, regions), regions, options.get("separator", ":"), options.get("read_count", 0)))
    found = group(reads, settings, options.get("ignore_others", False), options.get("truncate", False))
    write_group(found, folders, names)
    collapsing = {k: options[k] for k in ("separator", "truncate", "stepper", "ignore_orphans", "max_depth") if k in options}
    made = collapse(reads, found["groups"], found["families"], settings, **collapsing)
    write_collapse(made, folders, names)
    # a position that two regions report is called once, in the region that starts first
    start = F.regexp_extract("region", r":(\d+)-", 1).cast("bigint")
    alleles = made["calls"].withColumns({"contig": F.split("region", ":")[0], "region_start": start})
    first = alleles.groupBy("contig", "pos", "fam").agg(F.min(F.struct("region_start", "region")).alias("best"))
    once = alleles.join(first, ["contig", "pos", "fam"]).where("region = best.region").drop("best")
    records = durable(call(once, settings))
    for size in (0, *settings.sizes):
        sinks.vcf(records.where(F.col("fam") == size), f"{folders['VCFfiles']}/famsize_{size}", settings.filter, reference)
    return found | made | {"records": records} | {"settings": spark.createDataFrame([{k: str(v) for k, v in asdict(settings).items()}])}


def merge(spark: SparkSession, paths: list[str], kind: str) -> DataFrame:
    """Rows of several region results as one table, duplicates at borders once."""
    if kind == "datafiles":
        return mg.merge_rows([tables.datafile(spark, p).withColumns({"contig": F.split("region", ":")[0], "start": F.regexp_extract("region", r":(\d+)-", 1).cast("bigint")}) for p in paths])
    if kind == "umifiles":
        return mg.merge_rows([tables.umi_relations(spark, p).withColumn("contig", F.split("region", ":")[0]) for p in paths], "contig", "fam_pos")
    if kind == "consensusfiles":
        rows = [tables.consensus(spark, p).withColumn("file", F.col("_metadata.file_path")) for p in paths]
        every = rows[0]
        for r in rows[1:]:
            every = every.unionByName(r)
        # the region's start is in the name of the folder or file; without one the path decides
        start = F.regexp_extract(F.try_url_decode(F.regexp_replace("file", r"\+", "%2B")), r"[:_-](\d+)[-_]\d+[^/]*(?:/[^/]*)?$", 1).try_cast("bigint")
        first = mg.merge_consensus(every.withColumn("first", F.struct(start.alias("start"), "file")).drop("file"), ("CHROM", "POS", "FAM"), "first")
        return first.orderBy(*contig_order(F.col("CHROM")), "POS", "FAM")
    raise ValueError("kind is datafiles, consensusfiles or umifiles")


def figure_data(found: dict[str, DataFrame], min_coverage: float = 1000, min_ratio: float = 0.1, min_umis: float = 1000, min_children: float = 500) -> dict[str, DataFrame]:
    """One table for each figure of the report."""
    totals = sm.region_totals(found["summary"])
    wide, umis = found["consensus"], sm.family_umi_size(found["positions"], found["families"])
    depth = sm.family_read_depth(found["families"])
    return {
        "coverage": sm.low_or_high(sm.coverage_stats(wide.where("fam = 0"), "rawdp"), "mean", min_coverage),
        "children_ratio": sm.low_or_high(totals, "children_per_parent", min_ratio),
        "total_umis": sm.low_or_high(totals.withColumn("umis", F.col("ptu") + F.col("ctu")), "umis", min_umis),
        "children": sm.low_or_high(totals, "ctu", min_children),
        "mean_family_size": sm.family_size_track(wide), "non_reference": sm.filled_positions(sm.non_reference(wide), "non_ref_freq"),
        "consensus_depth": sm.filled_positions(sm.consensus_depth(wide), "depth"), "parent_frequency": sm.parent_frequency(found["summary"]),
        "network": sm.network_edges(found["groups"]), "network_degree": sm.degree_histogram(sm.network_edges(found["groups"]).where("child IS NOT NULL").select("region", F.col("parent").alias("src"), F.col("child").alias("dst")), found["groups"]),
        "family_size_depth": sm.size_and_depth(umis, depth), "umi_frequency": sm.histogram(found["relations"], "count", 20),
        "umi_density": sm.density(found["relations"], "count"), "read_depth": sm.dominant_split(found["families"]), "mapping": sm.mapping_proportions(found["flags"]),
    }


#: Report sections and their figures.
SECTIONS = {
    "Coverage": ("coverage",), "Mapping": ("mapping",), "Before grouping": ("umi_frequency", "umi_density"),
    "Grouping": ("children_ratio", "total_umis", "children", "parent_frequency", "network", "network_degree", "family_size_depth", "read_depth"),
    "Collapsing": ("mean_family_size", "non_reference", "consensus_depth"),
}


def plot(found: dict[str, DataFrame], folder: str, **limits: float) -> None:
    """Write each figure's table; any plotting tool draws them."""
    for name, table in figure_data(found, **limits).items():
        sinks.tsv(table.select(*[F.col(f"`{c}`").cast("string") for c in table.columns]), f"{folder}/{name}")


def report(spark: SparkSession, folder: str, sample: str = "", rows: int = 500) -> str:
    """An HTML page with the figures' tables (their first ``rows`` rows) and what is missing."""
    import html

    have = sorted(os.listdir(folder)) if os.path.isdir(folder) else []
    expected = spark.createDataFrame([(s, n) for s, names in SECTIONS.items() for n in names], "section string, name string")
    existing = spark.createDataFrame([(n,) for n in have], "name string")
    missing = {r["section"]: r for r in sm.missing_figures(expected, existing).collect()}
    title = f"Report for {sample}" if sample else "Report"
    parts = [f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>"]
    for section, names in SECTIONS.items():
        parts.append(f"<h2>{section}</h2><p>{missing[section]['missing']} of {missing[section]['expected']} tables are missing.</p>")
        for n in [n for n in names if n in have]:
            t = spark.read.csv(f"{folder}/{n}", sep="\t", header=True).limit(rows)
            cells = "".join("<tr>" + "".join(f"<td>{html.escape(str(v))}</td>" for v in r) + "</tr>" for r in t.collect())
            parts.append(f"<h3>{n}</h3><table><tr>{''.join(f'<th>{c}</th>' for c in t.columns)}</tr>{cells}</table>")
    return "\n".join(parts)
