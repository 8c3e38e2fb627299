"""Command line: preprocess, bed, group, collapse, call, run, merge, report."""

from __future__ import annotations

import argparse
import sys

from barkline.plans import commands
from barkline.session import session
from barkline.sources import tables
from barkline.sources.config import as_bool, path_of, read_prep, settings


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="barkline")
    subs = top.add_subparsers(dest="command", required=True)

    def add(name: str, *options: tuple) -> None:
        sub = subs.add_parser(name)
        for flags, kw in options:
            sub.add_argument(*flags, **kw)

    out, config = (("-o", "--outdir"), {}), (("-c", "--config"), {})
    bam, sep = (("-b", "--bamfile"), {}), (("-s", "--separator"), {"default": ":"})
    region = (("-r", "--region"), {"required": True})
    depth = (("-m", "--maxdepth"), {"type": int, "default": 1_000_000})
    orphans, stepper = {"action": "store_true"}, (("-stp", "--stepper"), {"choices": ["all", "nofilter"], "default": "nofilter"})
    add("preprocess", out, config, (("-r1", "--read1"), {"required": True}), (("-r2", "--read2"), {}), (("-r3", "--read3"), {}), (("-p", "--prepname"), {"required": True}), (("-pf", "--prepfile"), {}), (("-px", "--prefix"), {}))
    add("bed", (("-b", "--bamfile"), {"required": True}), (("-bd", "--bedfile"), {"required": True}), (("-mv", "--mincov"), {"type": int, "required": True}), (("-r", "--regionsize"), {"type": int, "required": True}), depth, (("-io", "--ignoreorphans"), orphans), stepper)
    add("group", out, config, bam, region, (("-d", "--distance"), {"type": int}), (("-p", "--position"), {"type": int}), (("-i", "--ignore"), {"type": as_bool, "default": False}), (("-t", "--truncate"), {"type": as_bool, "default": False}), sep, (("-rc", "--readcount"), {"type": int, "default": 0}))
    collapse = [(("-f", "--famsize"), {}), (("-ct", "--countthreshold"), {"type": int}), (("-pt", "--percentthreshold"), {"type": float}), (("-p", "--position"), {"type": int}), depth, (("-t", "--truncate"), {"type": as_bool, "default": False}), (("-i", "--ignoreorphans"), {"type": as_bool, "default": False}), stepper, sep, (("-bq", "--quality"), {"type": int, "default": 25})]
    add("collapse", out, config, bam, (("-rf", "--reference"), {}), region, (("-u", "--umifile"), {"required": True}), *collapse)
    thresholds = [(("-rt", "--refthreshold"), {"type": float}), (("-at", "--altthreshold"), {"type": float}), (("-ft", "--filterthreshold"), {"type": int})]
    add("call", out, config, (("-rf", "--reference"), {}), *thresholds, (("-f", "--famsize"), {"type": int, "required": True}), (("-cf", "--consfiles"), {"nargs": "+", "required": True}))
    limits = [(("-mv", "--mincov"), {"type": float, "default": 1000}), (("-mr", "--minratio"), {"type": float, "default": 0.1}), (("-mu", "--minumis"), {"type": float, "default": 1000}), (("-mc", "--minchildren"), {"type": float, "default": 500})]
    add("run", out, config, bam, (("-bd", "--bedfile"), {"required": True}), (("-rf", "--reference"), {"default": ""}), (("-d", "--distance"), {"type": int}), (("-p", "--position"), {"type": int}), (("-f", "--famsize"), {}), (("-ct", "--countthreshold"), {"type": int}), (("-pt", "--percentthreshold"), {"type": float}), *thresholds, (("-i", "--ignore"), {"type": as_bool, "default": False}), (("-t", "--truncate"), {"type": as_bool, "default": False}), (("-bq", "--quality"), {"type": int, "default": 25}), (("-pl", "--noplot"), {"action": "store_true"}), (("-rp", "--noreport"), {"action": "store_true"}), (("-sp", "--sample"), {"default": ""}), depth, (("-io", "--ignoreorphans"), orphans), stepper, sep, (("-rc", "--readcount"), {"type": int, "default": 0}), *limits)
    add("merge", (("-o", "--outdir"), {"required": True}), (("-f", "--files"), {"nargs": "+", "required": True}), (("-dt", "--datatype"), {"choices": ["datafiles", "consensusfiles", "umifiles"], "required": True}))
    add("report", (("-d", "--directory"), {"required": True}), (("-s", "--sample"), {"default": ""}))
    return top


def _settings(a: argparse.Namespace):
    get = lambda n: getattr(a, n, None)
    return settings(get("config"), distance=get("distance"), position=get("position"), sizes=get("famsize") if isinstance(get("famsize"), str) else None, count=get("countthreshold"), percent=get("percentthreshold"), ref=get("refthreshold"), alt=get("altthreshold"), filter=get("filterthreshold"), quality=get("quality"))


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = session()
    outdir = path_of(getattr(a, "config", None), "outdir", getattr(a, "outdir", None))
    if a.command == "preprocess":
        prep = read_prep(a.prepname, path_of(a.config, "prep_file", a.prepfile, needed=False))
        commands.preprocess(spark, [p for p in (a.read1, a.read2, a.read3) if p], prep, outdir, a.prefix)
    elif a.command == "bed":
        commands.sinks.bed(commands.bed(commands.read_alignments(spark, a.bamfile), a.mincov, a.regionsize, a.maxdepth, a.ignoreorphans, a.stepper), a.bedfile)
    elif a.command in ("group", "collapse"):
        from pyspark.sql import functions as F

        from barkline.functions.sequences import region_struct

        folders = commands.make_folders(outdir)
        regions = spark.createDataFrame([(a.region,)], "r string").select(region_struct(F.col("r")).alias("x")).where("x IS NOT NULL").select("x.*")
        if regions.isEmpty():
            raise ValueError(f"{a.region} is no region such as chr1:100-200")
        alignments = path_of(a.config, "bam_file", a.bamfile)
        commands.checked_regions(regions, commands.header_contigs(spark, alignments))
        reads = commands.region_reads(commands.read_alignments(spark, alignments, regions), regions, a.separator, getattr(a, "readcount", 0))
        if a.command == "group":
            commands.write_group(commands.group(reads, _settings(a), a.ignore, a.truncate), folders, [a.region])
        else:
            groups, families = tables.families_json(spark, a.umifile)
            here = [t.where(F.col("region").isNull() | (F.col("region") == a.region)).withColumn("region", F.lit(a.region)) for t in (groups, families)]
            made = commands.collapse(reads, *here, _settings(a), a.separator, a.truncate, a.stepper, a.ignoreorphans, a.maxdepth)
            commands.write_collapse(made, folders, [a.region])
    elif a.command == "call":
        s, folders = _settings(a), commands.make_folders(outdir)
        alleles = tables.consensus_alleles(tables.consensus(spark, a.consfiles)).where(f"fam = {a.famsize}")
        commands.sinks.vcf(commands.call(alleles, s), f"{folders['VCFfiles']}/famsize_{a.famsize}", s.filter, a.reference or "")
    elif a.command == "run":
        found = commands.run(spark, path_of(a.config, "bam_file", a.bamfile), a.bedfile, outdir, _settings(a), a.reference, ignore_others=a.ignore, truncate=a.truncate, separator=a.separator, read_count=a.readcount, stepper=a.stepper, ignore_orphans=a.ignoreorphans, max_depth=a.maxdepth)
        if not a.noplot:
            commands.plot(found, f"{outdir}/Figures", min_coverage=a.mincov, min_ratio=a.minratio, min_umis=a.minumis, min_children=a.minchildren)
            if not a.noreport:
                with open(f"{outdir}/Report/report.html", "w") as f:
                    f.write(commands.report(spark, f"{outdir}/Figures", a.sample))
    elif a.command == "merge":
        commands.sinks.json_rows(commands.merge(spark, a.files, a.datatype), f"{a.outdir}/merged_{a.datatype}")
    else:
        print(commands.report(spark, f"{a.directory}/Figures", a.sample))
    return 0


if __name__ == "__main__":
    sys.exit(main())
