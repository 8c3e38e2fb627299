"""Golden cases: expansion of alignments, SAM and BAM readers, FASTQ preprocessing, commands."""

import gzip
import json
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barkline.operators import consensus as cs
from barkline.operators import pileup as pl
from barkline.operators import preprocess as pp
from barkline.plans import commands
from barkline.sources import alignments as al
from barkline.sources import tables
from barkline.sources.config import PREPS, Settings, as_bool, read_prep, settings

# qname, flag, contig, pos (1-based), cigar, seq, md
READS = [
    ("a:ACGTAC", 0, "chr1", 11, "6M", "ACGTAC", "6"),
    ("b:ACGTAC", 0, "chr1", 11, "3M2I3M", "ACGTTTAC", "6"),
    ("c:ACGTAA", 0, "chr1", 11, "2M2D2M", "ACAC", "2^GT2"),
    ("d:TTTTTT", 0, "chr1", 12, "1S4M", "GCGAA", "2T1"),
    ("e:TTTTTT", 256, "chr1", 12, "4M", "CGTA", "4"),
    ("f:TTTTTT", 4, "*", 0, "*", "ACGT", None),
    ("g:ACGTAC", 0, "chr2", 101, "2M3N2M", "ACGT", "4"),
]


def sam_text():
    head = "@HD\tVN:1.6\n@SQ\tSN:chr1\tLN:1000\n@SQ\tSN:chr2\tLN:2000\n"
    lines = []
    for q, flag, c, p, cigar, seq, md in READS:
        lines.append("\t".join([q, str(flag), c, str(p), "60", cigar, "*", "0", "0", seq, "I" * len(seq)] + ([f"MD:Z:{md}"] if md else [])))
    return head + "\n".join(lines) + "\n"


def bam_bytes():
    contigs = [("chr1", 1000), ("chr2", 2000)]
    out = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", 2)
    for n, length in contigs:
        out += struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", length)
    import re

    for q, flag, c, p, cigar, seq, md in READS:
        ops = [(int(n), "MIDNSHP=X".index(o)) for n, o in re.findall(r"(\d+)([MIDNSHP=X])", cigar)]
        ref = {"chr1": 0, "chr2": 1}.get(c, -1)
        nib = ["=ACMGRSVTWYHKDBN".index(b) for b in seq] + [0] * (len(seq) % 2)
        body = struct.pack("<iiBBHHHiiii", ref, p - 1, len(q) + 1, 60, 0, len(ops), flag, len(seq), -1, -1, 0) + q.encode() + b"\0"
        body += b"".join(struct.pack("<I", n << 4 | o) for n, o in ops) + bytes(a << 4 | b for a, b in zip(nib[::2], nib[1::2])) + bytes([40] * len(seq))
        body += b"NMC\1" + b"XAZ" + b"text\0" + b"XBBs" + struct.pack("<ihh", 2, 1, 2) + (b"MDZ" + md.encode() + b"\0" if md else b"")
        out += struct.pack("<i", len(body)) + body
    blocks = b""
    for at in range(0, len(out), 100):  # small blocks, so that records cross their borders
        part = out[at : at + 100]
        z = zlib.compressobj(6, zlib.DEFLATED, -15)
        data = z.compress(part) + z.flush()
        blocks += b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(data) + 25) + data + struct.pack("<II", zlib.crc32(part), len(part))
    return blocks


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("reads")
    (d / "x.sam").write_text(sam_text())
    (d / "x.bam").write_bytes(bam_bytes())
    (d / "x.bed").write_text("track x\nchr1 11 20\nchr2\t101\t110\textra\n")
    return d


def test_many_reads_expand_as_one_by_one():
    rng = random.Random(4)
    reads = []
    for k in range(400):
        ops = [(rng.randrange(1, 6), rng.choice("MMMM=XIDNSP")) for _ in range(rng.randrange(0, 7))]
        if k % 3 == 0:
            ops = [(4, "M"), (2, rng.choice("ID")), (5, "M")]
        length = sum(n for n, op in ops if op in "M=XIS")
        seq = "".join(rng.choice("ACGTacgtN") for _ in range(length))
        md, left = "", sum(n for n, op in ops if op in "M=X")
        for n, op in ops:  # matches, a mismatch each now and then, deletions
            if op in "M=X":
                md += rng.choice([str(n), f"{n - 1}{rng.choice('ACGT')}"])
            elif op == "D":
                md += "^" + "".join(rng.choice("ACgt") for _ in range(n)) + "0"
        cigar = "".join(f"{n}{op}" for n, op in ops) or rng.choice(["*", None])
        reads.append((rng.randrange(1000), cigar, rng.choice([md, md, None]), seq, rng.choice([[], None, [rng.randrange(60) for _ in range(length)]])))
    columns = [pa.array(c, t) for c, t in zip(zip(*reads), (pa.int64(), pa.string(), pa.string(), pa.string(), pa.list_(pa.int32())))]
    low, high = np.array([r[0] + 2 for r in reads]), np.array([r[0] + 9 for r in reads])
    for cut in (slice(None), slice(37, 300)):  # slices of a batch have offsets
        some = [c[cut] for c in columns]
        for bounds in ((), (low[cut], high[cut])):
            rows, bases = pl.expand_reads(*some, *bounds)
            got = sorted(zip(rows.tolist(), *[c.to_pylist() for c in bases.columns]))
            want = [(i, *x) for i, r in enumerate(reads[cut]) for x in pl.expand(r[0], r[1] or "", r[2], r[3], r[4] or [])]
            assert got == sorted(w for w in want if not bounds or bounds[0][w[0]] <= w[1] < bounds[1][w[0]])


def test_reads_without_their_sequence_have_no_bases():
    one = [pa.array([5], pa.int64()), *[pa.array([x], pa.string()) for x in ("4M", "4", "*")], pa.array([[]], pa.list_(pa.int32()))]
    assert pl.expand_reads(*one)[1].num_rows == 0
    assert pl.expand_reads(*[c[:0] for c in one])[1].num_rows == 0


def test_table_function_of_bases(spark):
    pl.register_read_bases(spark)
    got = spark.sql("""SELECT r.id, b.* FROM VALUES (1, 10L, '2M2D2M', '2^GT2', 'ACAC', array(1, 1, 1, 1)), (2, 7L, '3M', NULL, 'acg', NULL), (3, NULL, NULL, NULL, NULL, NULL)
        AS r(id, start, cigar, md, seq, qual), LATERAL read_bases(r.start, r.cigar, r.md, r.seq, r.qual) AS b""").collect()
    want = [(1, 10, "A", "A", 1), (1, 11, "CGT", "C", 1), (1, 14, "A", "A", 1), (1, 15, "C", "C", 1), (2, 7, "A", "A", 0), (2, 8, "C", "C", 0), (2, 9, "G", "G", 0)]
    assert sorted(map(tuple, got)) == want


def test_expand():
    assert pl.expand(10, "6M", "6", "ACGTAC", [1] * 6)[0] == (10, "A", "A", 1)
    assert pl.expand(10, "3M2I3M", "6", "ACGTTTAC", [1] * 8)[2] == (12, "G", "GTT", 1)
    assert pl.expand(10, "2M2D2M", "2^GT2", "ACAC", [1] * 4) == [(10, "A", "A", 1), (11, "CGT", "C", 1), (14, "A", "A", 1), (15, "C", "C", 1)]
    assert pl.expand(11, "1S4M", "2T1", "GCGAA", [9, 1, 2, 3, 4]) == [(11, "C", "C", 1), (12, "G", "G", 2), (13, "T", "A", 3), (14, "A", "A", 4)]
    assert [p for p, *_ in pl.expand(100, "2M3N2M", "4", "ACGT", [1] * 4)] == [100, 101, 105, 106]
    assert pl.expand(0, "*", None, "ACGT", []) == []


def test_sam_and_bam_agree(spark, files):
    columns = ["read_id", "qname", "flag", "contig", "start", "end", "cigar", "md", "seq", "qual"]
    a = sorted(map(tuple, al.sam(spark, str(files / "x.sam")).where("contig IS NOT NULL").select(*columns[1:]).collect()))
    b = sorted(map(tuple, al.bam(spark, str(files / "x.bam")).where("contig IS NOT NULL").select(*columns[1:]).collect()))
    assert a == b and len(a) == 6
    assert {tuple(r) for r in al.bam_contigs(spark, str(files / "x.bam")).collect()} == {tuple(r) for r in al.sam_contigs(spark, str(files / "x.sam")).collect()} == {("chr1", 1000), ("chr2", 2000)}


def test_regions_and_bins(spark):
    reads = spark.createDataFrame([(k, "c", s, s + 25) for k, s in enumerate(range(0, 300, 7))], "read_id bigint, contig string, start bigint, end bigint")
    regions = spark.createDataFrame([("c", 10, 60), ("c", 55, 200), ("d", 0, 10)], "contig string, start bigint, end bigint")
    got = sorted((r["region"], r["read_id"]) for r in pl.in_regions(reads, regions, 16).collect())
    want = sorted((f"c:{a + 1}-{b}", k) for k, s in enumerate(range(0, 300, 7)) for a, b in ((10, 60), (55, 200)) if s < b and s + 25 > a)
    assert got == want


def test_run_command(spark, files, tmp_path):
    s = Settings(sizes=(1, 2), distance=1, position=10, filter=1, alt=1.0)
    out = commands.run(spark, str(files / "x.bam"), str(files / "x.bed"), str(tmp_path), s)
    calls = {tuple(r) for r in out["calls"].where("region = 'chr1:11-20' AND fam = 0 AND pos = 13").select("ref", "alt", "n").collect()}
    assert calls == {("T", "T", 2), ("T", "A", 1)}
    lines = [r["value"] for r in spark.read.text(f"{tmp_path}/VCFfiles/famsize_0").collect()]
    assert lines[0] == "##fileformat=VCFv4.1" and any(x.startswith("chr1\t13\t.\tG\tGTT") for x in lines)
    assert len([f for f in (tmp_path / "VCFfiles/famsize_0").iterdir() if f.name.startswith("part-")]) == 1
    info = {x.split("\t")[1]: x.split("\t")[7] for x in lines if x.startswith("chr1\t14\t")}["14"]
    assert info == "RDP=3;CDP=3;MIF=0;MNF=0.0;AD=2;AL=1;AF=33.3333"
    wide = spark.read.option("recursiveFileLookup", "true").csv(f"{tmp_path}/Consfiles/consensus", sep="\t", header=True, schema=tables.CONSENSUS)
    assert wide.where("CHROM = 'chr1' AND POS = 14 AND FAM = 0").first()["A"] == 1
    back = tables.consensus_alleles(wide).where("fam = 0")
    assert back.where("pos = 12 AND alt = 'GTT'").count() == 1
    commands.plot(out, f"{tmp_path}/Figures")
    assert "0 of 1 tables are missing" in commands.report(spark, f"{tmp_path}/Figures", "S")
    assert out["groups"].where("umi = 'ACGTAA'").first()["parent"] == "ACGTAC"


def test_bed_command(spark):
    rows = [(k, 0, "chr1", s, e, "9M") for k, (s, e) in enumerate([(0, 10), (5, 15), (10, 20), (30, 40), (30, 40), (40, 45), (40, 45)])]
    reads = spark.createDataFrame(rows, "read_id bigint, flag int, contig string, start bigint, end bigint, cigar string")
    got = [tuple(r) for r in commands.bed(reads, 2, 1).orderBy("start").collect()]
    assert got == [("chr1", 6, 15), ("chr1", 31, 45)]
    assert commands.bed(reads, 2, 11).count() == 1


def test_islands(spark):
    depth = spark.createDataFrame([("c", p, 5) for p in (1, 2, 3, 7, 8, 99_999, 100_000, 100_001)] + [("c", 4, 1)], "region string, pos bigint, depth bigint")
    got = sorted(tuple(r) for r in cs.islands(depth, 5, 2).collect())
    assert got == [("c", 2, 4), ("c", 8, 9), ("c", 100_000, 100_002)]


def test_preprocess(spark, tmp_path):
    def write(name, seqs):
        with gzip.open(tmp_path / name, "wt") as f:
            for k, s in enumerate(seqs):
                f.write(f"@r{k} 1:N\n{s}\n+\n{'I' * len(s)}\n")
        return str(tmp_path / name)

    umi = "ACGTACGTACGT"
    r1 = write("1.fq.gz", [umi + "TGACT" + "GGGG", umi + "tgact" + "CCCC", umi + "TGAGT" + "AAAA", umi + "TGACT"])
    r2 = write("2.fq.gz", [umi[::-1] + "TGACT" + "TTTT"] * 3)
    totals = commands.preprocess(spark, [r1, r2], PREPS["EPIC-DS"], str(tmp_path / "out")).first()
    assert (totals["total"], totals["correct"], totals["incorrect"], totals["length_read1"]) == (3, 2, 1, 21)
    lines = sorted(r["value"] for r in spark.read.text(str(tmp_path / "out/reads_reheadered_R1")).collect())
    assert "GGGG" in lines and f"@r0:{umi}{umi[::-1]} 1:N" in lines
    assert {r["Umi"]: r["Count"] for r in tables.umi_counts(spark, str(tmp_path / "out/Umi_counts")).collect()} == {umi: 2, umi[::-1]: 2}
    with pytest.raises(ValueError):
        commands.preprocess(spark, [r1], PREPS["EPIC-DS"], str(tmp_path / "out"))


def test_settings(tmp_path):
    ini = tmp_path / "c.ini"
    ini.write_text("[PATHS]\noutdir = /x\n[SETTINGS]\nmin_family_sizes = 1,4\npercent_consensus_threshold = 60\n[REPORT]\n")
    s = settings(str(ini), percent=70.0, distance=2)
    assert s.sizes == (1, 4) and s.percent == 60 and s.distance == 2
    with pytest.raises(ValueError):
        settings(None, percent=120.0)
    assert as_bool("T") and not as_bool("no")
    prep = tmp_path / "p.ini"
    prep.write_text("[custom]\nINPUT_READS=1\nOUTPUT_READS=1\nUMI_LOCS=1\nUMI_LENS=4\nUMI_POS=2\nSPACER=TRUE\nSPACER_SEQ=AXC\nUMI_INLINE=TRUE\n")
    with pytest.raises(ValueError):
        read_prep("CUSTOM", str(prep))
    prep.write_text(prep.read_text().replace("AXC", "ANC"))
    assert read_prep("CUSTOM", str(prep)).spacer == "ANC"


def test_tables(spark, tmp_path, files):
    assert [tuple(r) for r in tables.bed(spark, str(files / "x.bed")).collect()] == [("chr1", 10, 20), ("chr2", 100, 110)]
    (tmp_path / "chr1_5-9.json").write_text('{"AC": {"parent": "AC", "positions": {"chr1:7": 3}}, "AG": {"parent": "AC", "positions": {"chr1:7": 3}}}')
    groups, families = tables.families_json(spark, str(tmp_path))
    assert sorted(map(tuple, groups.collect())) == [("chr1:5-9", "AC", "AC"), ("chr1:5-9", "AG", "AC")]
    assert [tuple(r) for r in families.collect()] == [("chr1:5-9", "AC", 7, 3)]
    (tmp_path / "cov.yml").write_text("chr1:5-9: 3.5\nchr1:5-9: 4.5\n")
    assert [tuple(r) for r in tables.coverage(spark, str(tmp_path / "cov.yml")).collect()] == [("chr1:5-9", 4.5)]


def test_umi_files_come_back(spark, tmp_path):
    from barkline.operators import sinks

    groups = [(r, u, u[:3] + "A") for r in ("chr1:5-9", "chr2:1-90", "GL+1_2:3-4") for u in ("AAAA", "AAAC", "CCCA", "CCCT", "GGGA")]
    families = [(r, p, k, k + n) for r in ("chr1:5-9", "chr2:1-90", "GL+1_2:3-4") for n, p in enumerate(("AAAA", "CCCA", "GGGA")) for k in (5, 7)]
    positions = [(r, p, u, k, 2) for r, u, p in groups for k in (5, 8)]
    g = spark.createDataFrame(groups, "region string, umi string, parent string").coalesce(1)
    f = spark.createDataFrame(families, "region string, parent string, fam_pos bigint, fam_n bigint").coalesce(1)
    sinks.families_json(g, f, f"{tmp_path}/families")
    sinks.positions_json(spark.createDataFrame(positions, "region string, parent string, umi string, pos bigint, n bigint").coalesce(1), f"{tmp_path}/positions")
    back = tables.families_json(spark, f"{tmp_path}/families")
    assert [sorted(map(tuple, x.collect())) for x in back] == [sorted(groups), sorted(families)]
    assert sorted(map(tuple, tables.positions_json(spark, f"{tmp_path}/positions").collect())) == sorted(positions)
    # one region's folder alone, and a file of several lines an object as json.dump(indent=4) writes it
    (one,) = [str(p) for p in (tmp_path / "families").iterdir() if "chr2" in p.name]
    (tmp_path / "more").mkdir()
    doc = {u: {"parent": "TTTT", "positions": {"chr3:7": 3, "chr3:9": 1}} for u in ("TTTT", "TTTG")}
    (tmp_path / "more/chr3_5-9.json").write_text(json.dumps(doc, sort_keys=True, indent=4))
    got = commands.merge(spark, [one, f"{tmp_path}/more"], "umifiles").select("region", "umi", "parent", "fam_pos", "fam_n").collect()
    at = {(r, p): [] for r, p, *_ in families}
    for r, p, k, n in families:
        at[r, p].append((k, n))
    want = [(r, u, p, k, n) for r, u, p in groups if r == "chr2:1-90" for k, n in at[r, p]]
    assert sorted(map(tuple, got)) == sorted(want + [("chr3:5-9", u, "TTTT", k, n) for u in ("TTTT", "TTTG") for k, n in ((7, 3), (9, 1))])


def test_streaming_equals_batch(spark, sf_dir, tmp_path):
    from barkline.operators import grouping as gp
    from barkline.plans import views
    from barkline.streaming import counts as st

    reads = views.reads(spark, sf_dir).select(F.col("read_id"), "region", "umi", F.col("start").cast("bigint"), F.col("flag").cast("int"))
    reads.repartition(3).write.parquet(str(tmp_path / "in"))
    st.keep_counts(st.arriving(spark, str(tmp_path / "in"), 1), "tally", str(tmp_path / "cp")).awaitTermination(120)
    assert {tuple(r) for r in spark.table("tally").collect()} == {tuple(r) for r in gp.umi_counts(gp.usable_reads(reads)).collect()}


def test_single_valued_prep_lists_and_depth_cap(spark, tmp_path):
    (tmp_path / "p.ini").write_text("[EPIC-DS]\nINPUT_READS = 2\nOUTPUT_READS = 2\nUMI_LOCS = 1,2\nUMI_LENS = 12\nUMI_POS = 1\nSPACER = TRUE\nSPACER_SEQ = TGACT\nUMI_INLINE = TRUE\n")
    assert read_prep("EPIC-DS", str(tmp_path / "p.ini")) == PREPS["EPIC-DS"]
    rows = [(k, 0, "chr1", s, e, "9M") for k, (s, e) in enumerate([(5, 250_005), (5, 250_005), (249_990, 250_020), (300_000, 300_010)])]
    reads = spark.createDataFrame(rows, "read_id bigint, flag int, contig string, start bigint, end bigint, cigar string")
    assert [tuple(r) for r in commands.bed(reads, 1, 1).orderBy("start").collect()] == [("chr1", 6, 250_020), ("chr1", 300_001, 300_010)]
    assert [tuple(r) for r in commands.bed(reads, 2, 1).collect()] == [("chr1", 6, 250_005)]
    assert commands.bed(reads, 2, 1, max_depth=1).count() == 0


def test_grouping_of_a_long_chain_of_single_reads(spark):
    from barkline.operators import grouping as gp

    n = 300
    counts = spark.createDataFrame([("r", f"u{k:04d}", 1, k) for k in range(n)], "region string, umi string, n bigint, first_seen bigint")
    edges = spark.createDataFrame([("r", f"u{k:04d}", f"u{k + 1:04d}") for k in range(n - 1)], "region string, src string, dst string")
    assert {r["parent"] for r in gp.umi_groups(counts, edges).collect()} == {"u0000"}
