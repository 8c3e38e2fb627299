"""Results of regions beside each other, the depth cap, and the text formats of files."""

import threading

import pytest
from pyspark.sql import functions as F

from barkline import cli
from barkline.functions import sequences as sq
from barkline.operators import pileup as pl
from barkline.operators import sinks
from barkline.plans import commands
from barkline.sources import tables
from barkline.sources.config import Settings

A, B = "chr1:11-20", "chr2:101-110"
FOLDERS = ("Datafiles/datafile", "Umifiles/families", "Stats/UMI_relationships", "Stats/Umis_before_grouping", "Stats/Mapped_read_counts")


def sam(path, more=()):
    reads = [("a:ACGTAC", 0, "chr1", 11, "6M", "ACGTAC", "6"), ("b:ACGTAC", 0, "chr1", 11, "3M2I3M", "ACGTTTAC", "6"), ("c:ACGTAA", 0, "chr1", 12, "4M", "CTTA", "1G2"), ("g:ACGTAC", 0, "chr2", 101, "2M3D2M", "ACGT", "2^GGG2"), *more]
    head = "@SQ\tSN:chr1\tLN:1000\n@SQ\tSN:chr2\tLN:2000\n"
    path.write_text(head + "".join("\t".join([q, str(f), c, str(p), "60", cg, "*", "0", "0", s, "I" * len(s), f"MD:Z:{md}"]) + "\n" for q, f, c, p, cg, s, md in reads))
    return str(path)


@pytest.fixture
def as_session(spark, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda: spark)


def texts(root):
    """{(folder, region): lines}"""
    found = {}
    for f in root.rglob("part-*"):
        lines = found.setdefault((str(f.parent.parent.relative_to(root)), f.parent.name), [])
        lines += f.read_text().splitlines()
    return {k: sorted(v) for k, v in found.items()}


def test_regions_written_one_after_the_other_stay(spark, tmp_path, as_session):
    path = sam(tmp_path / "x.sam")
    (tmp_path / "x.bed").write_text("chr1 11 20\nchr2 101 110\n")
    out = tmp_path / "out"
    for region in (A, B, A):
        assert cli.main(["group", "-o", str(out), "-b", path, "-r", region, "-d", "1", "-p", "10"]) == 0
        assert cli.main(["collapse", "-o", str(out), "-b", path, "-r", region, "-u", f"{out}/Umifiles/families", "-f", "1,2", "-ct", "1", "-pt", "50", "-p", "10"]) == 0
    commands.run(spark, path, str(tmp_path / "x.bed"), str(tmp_path / "both"), Settings(sizes=(1, 2), distance=1, position=10))
    one, both = texts(out), texts(tmp_path / "both")
    for folder in (*FOLDERS, "Consfiles/consensus", "Coverage/coverage"):
        regions = {k[1] for k in one if k[0] == folder}
        assert len(regions) == 2, folder
        assert {k: v for k, v in one.items() if k[0] == folder} == {k: v for k, v in both.items() if k[0] == folder}
    assert {r["region"] for r in tables.relations(spark, f"{out}/Stats/UMI_relationships").collect()} == {A, B}
    counts = {r["region"]: (r["mapped"], r["unmapped"]) for r in tables.mapped_counts_json(spark, f"{out}/Stats/Mapped_read_counts").collect()}
    assert counts == {A: (3, 0), B: (1, 0)}
    assert {r["region"]: r["mean_depth"] for r in tables.coverage(spark, f"{out}/Coverage/coverage").collect()}.keys() == {A, B}


def test_concurrent_regions_and_regions_without_rows(spark, tmp_path):
    path = f"{tmp_path}/coverage"
    rows = lambda r, v: spark.createDataFrame([(r, v)], "region string, mean_depth double")
    work = [threading.Thread(target=sinks.coverage, args=(rows(f"chr{k}:1-9", float(k)), path, [f"chr{k}:1-9"])) for k in range(6)]
    for t in work:
        t.start()
    for t in work:
        t.join()
    read = lambda: {r["region"]: r["mean_depth"] for r in tables.coverage(spark, path).collect()}
    assert read() == {f"chr{k}:1-9": float(k) for k in range(6)}
    sinks.coverage(rows("chr3:1-9", 30.0).where("false"), path, ["chr3:1-9"])
    sinks.coverage(rows("chr4:1-9", 40.0), path, ["chr4:1-9", "chr5:1-9", "chr9:1-9"])
    assert read() == {"chr0:1-9": 0.0, "chr1:1-9": 1.0, "chr2:1-9": 2.0, "chr4:1-9": 40.0}


def test_depth_cap(spark, tmp_path):
    rows = [("r", p, i, i % 7) for p, n in ((1, 40), (2, 3), (3, 4), (5, 900)) for i in range(n)] + [("s", 5, 1 << 50, 1), ("s", 5, 3, 2)]
    piled = spark.createDataFrame(rows, "region string, pos bigint, read_id bigint, q int").repartition(5)
    for most in (1, 3, 100, 5000):
        got = sorted(map(tuple, pl.capped(piled, most).collect()))
        at = {}
        for r in sorted(rows, key=lambda r: r[2]):
            at.setdefault(r[:2], []).append(r)
        assert got == sorted(r for own in at.values() for r in own[:most])
    path = sam(tmp_path / "x.sam", [(f"z{k}:ACGTAC", 0, "chr1", 13, "2M", "TT", "0G1") for k in range(5)])
    regions = spark.createDataFrame([("chr1", 10, 20)], "contig string, start bigint, end bigint")
    reads = commands.region_reads(commands.read_alignments(spark, path), regions)
    found = commands.group(reads, Settings(distance=1, position=10))
    calls = lambda most: {(r["ref"], r["alt"]): r["n"] for r in commands.collapse(reads, found["groups"], found["families"], Settings(sizes=(1,), distance=1, position=10), max_depth=most)["calls"].where("fam = 0 AND pos = 12").collect()}
    assert calls(1_000_000) == {("G", "G"): 1, ("G", "GTT"): 1, ("G", "T"): 6}
    assert calls(3) == {("G", "G"): 1, ("G", "GTT"): 1, ("G", "T"): 1}
    assert calls(2) == {("G", "G"): 1, ("G", "GTT"): 1}


def test_consensus_files_with_pairs_as_text(spark, tmp_path):
    """A file as other tools write it: pairs in brackets, several of them, none, and other blanks and quotes."""
    lines = ["\t".join(sinks.CONSENSUS_HEADER), "chr1\t14\tA\t7\t0\t0\t2\t0\t('A', 'ATT');('A', 'AG')\t3;1\t('AC', 'A')\t4\t17\t17\t1\t41.2\t1.5", "chr1\t15\tC\t0\t9\t0\t0\t0\t\t\t\t\t9\t9\t1\t100.0\t1.5", 'chr1\t16\tC\t0\t9\t0\t0\t0\t("C","CA")\t2\tCG>C\t1\t12\t12\t1\t75.0\t1.5']
    (tmp_path / "chr1:11-20.cons").write_text("\n".join(lines) + "\n")
    alleles = tables.consensus_alleles(spark.read.csv(spark.sparkContext.parallelize(lines[1:]), sep="\t", schema=tables.CONSENSUS))
    got = {(r["pos"], r["ref"], r["alt"]): r["n"] for r in alleles.collect()}
    assert got == {(13, "A", "A"): 7, (13, "A", "T"): 2, (13, "A", "ATT"): 3, (13, "A", "AG"): 1, (13, "AC", "A"): 4, (14, "C", "C"): 9, (15, "C", "C"): 9, (15, "C", "CA"): 2, (15, "CG", "C"): 1}
    records = commands.call(alleles, Settings(ref=95.0, alt=2.0, filter=3))
    assert {(r["POS"], r["REF"], r["ALT"]) for r in records.collect()} >= {("14", "A", "ATT"), ("14", "AC", "A")} or records.where("REF = 'AC' AND ALT = 'A'").count() == 1
    wide = spark.createDataFrame([(A, 13, "A", 7, 0, 0, 2, 0, [(3, "A", "ATT")], [(4, "AC", "A")], 17, 17, 1, 41.2, 1.5)], "region string, pos bigint, ref string, A bigint, C bigint, G bigint, T bigint, N bigint, insertions array<struct<n:bigint,ref:string,alt:string>>, deletions array<struct<n:bigint,ref:string,alt:string>>, rawdp bigint, consdp bigint, fam int, ref_freq double, mean_fam double")
    sinks.consensus(wide, f"{tmp_path}/cons", [A])
    (part,) = [f for f in (tmp_path / "cons").rglob("part-*.csv")]
    assert part.read_text().splitlines() == [lines[0], "chr1\t14\tA\t7\t0\t0\t2\t0\t('A', 'ATT')\t3\t('AC', 'A')\t4\t17\t17\t1\t41.2\t1.5"]
    back = tables.consensus_alleles(tables.consensus(spark, f"{tmp_path}/cons"))
    assert {(r["ref"], r["alt"], r["n"]) for r in back.collect()} == {("A", "A", 7), ("A", "T", 2), ("A", "ATT", 3), ("AC", "A", 4)}


def test_unknown_contigs_and_prefixes(spark, tmp_path, as_session):
    path = sam(tmp_path / "x.sam")
    with pytest.raises(ValueError, match="chr7 not among the contigs of the header: chr1, chr2"):
        cli.main(["group", "-o", str(tmp_path / "o"), "-b", path, "-r", "chr7:1-9"])
    (tmp_path / "x.bed").write_text("chr1 11 20\nchr9 1 10\n")
    with pytest.raises(ValueError, match="chr9"):
        commands.run(spark, path, str(tmp_path / "x.bed"), str(tmp_path / "o"))
    names = spark.createDataFrame([("/a/b_R1.fastq.gz",), ("x.fq.gz",), ("dir.fq.gz/y.fastq",), ("s3://k/z.fastq.gz.1",)], "p string")
    assert [r[0] for r in names.select(sq.file_prefix(F.col("p"))).collect()] == ["b_R1", "x", "y.fastq", "z"]
