"""BAM and FASTQ files give the same rows in any number of splits; an index narrows what is read."""

import gzip
import random
import re
import struct
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, LessThan

from barkline.sources import alignments as al
from barkline.sources import bam

CONTIGS = [("chr1", 400_000), ("chr2", 90_000), ("chrEmpty", 10)]
EOF = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


def record(q, flag, ref, pos, cigar, seq, md, rng):
    ops = [(int(n), bam.OPS.index(o)) for n, o in re.findall(r"(\d+)([MIDNSHP=X])", cigar)]
    nib = ["=ACMGRSVTWYHKDBN".index(b) for b in seq] + [0] * (len(seq) % 2)
    body = struct.pack("<iiBBHHHiiii", ref, pos, len(q) + 1, 60, 0, len(ops), flag, len(seq), -1, -1, 0) + q.encode() + b"\0"
    body += b"".join(struct.pack("<I", n << 4 | o) for n, o in ops) + bytes(a << 4 | b for a, b in zip(nib[::2], nib[1::2], strict=True)) + bytes(rng.randrange(2, 40) for _ in seq)
    body += b"NMC\1" + b"XAZ" + b"text\0" + b"XBBs" + struct.pack("<ihh", 2, 1, 2) + (b"MDZ" + md.encode() + b"\0" if md else b"")
    return struct.pack("<i", len(body)) + body


def block(part):
    z = zlib.compressobj(6, zlib.DEFLATED, -15)
    data = z.compress(part) + z.flush()
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(data) + 25) + data + struct.pack("<II", zlib.crc32(part), len(part))


def write_bam(path, reads, sizes, contigs=CONTIGS):
    """A sorted BAM file in blocks of ``sizes`` bytes in turn, and its index."""
    rng = random.Random(1)
    out = b"BAM\1" + struct.pack("<i", 4) + b"@HD\n" + struct.pack("<i", len(contigs))
    for n, length in contigs:
        out += struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", length)
    places = []
    for q, flag, ref, pos, cigar, seq, md in reads:
        places.append(len(out))
        out += record(q, flag, ref, pos, cigar, seq, md, rng)
    places.append(len(out))
    data, starts, at, k = b"", [], 0, 0
    while at < len(out):
        starts.append((at, len(data)))
        n = sizes[k % len(sizes)]
        data += block(out[at : at + n])
        at, k = at + n, k + 1
    starts.append((len(out), len(data)))
    path.write_bytes(data + EOF)

    def virtual(p):
        start, offset = [s for s in starts if s[0] <= p][-1]
        return offset << 16 | p - start

    bins, linear = [{} for _ in contigs], [{} for _ in contigs]
    for k, (_, _, ref, pos, cigar, _, _) in enumerate(reads):
        if ref < 0:
            continue
        end = max(pos + 1, pos + sum(int(n) for n, o in re.findall(r"(\d+)([MDN=X])", cigar)))
        number = next(first + (pos >> bits) for first, bits in reversed(bam.BIN_LEVELS) if pos >> bits == end - 1 >> bits)
        a, b = virtual(places[k]), virtual(places[k + 1])
        chunks = bins[ref].setdefault(number, [])
        if chunks and chunks[-1][1] == a:
            chunks[-1] = chunks[-1][0], b
        else:
            chunks.append((a, b))
        for w in range(pos >> 14, (end - 1 >> 14) + 1):
            linear[ref][w] = min(linear[ref].get(w, a), a)
    index = b"BAI\1" + struct.pack("<i", len(contigs))
    for own, line in zip(bins, linear, strict=True):
        index += struct.pack("<i", len(own) + 1)
        for number, chunks in own.items():
            index += struct.pack("<Ii", number, len(chunks)) + b"".join(struct.pack("<QQ", *c) for c in chunks)
        index += struct.pack("<Ii", bam.STATISTICS_BIN, 2) + struct.pack("<4Q", 0, 1, 2, 3)
        n = max(line, default=-1) + 1
        filled = [next((line[v] for v in range(w, n) if v in line)) for w in range(n)]
        index += struct.pack("<i", n) + struct.pack(f"<{n}Q", *filled)
    return index


def reads(n, seed=2, longest=160):
    rng, out = random.Random(seed), []
    for k in range(n):
        ref = rng.choice([0, 0, 0, 1, -1])
        size = rng.randrange(20, longest)
        cut = rng.randrange(1, size - 1)
        cigar = rng.choice([f"{size}M", f"{cut}M{size - cut}M", f"{cut}M7D{size - cut}M", f"{cut}S{size - cut}M", f"{cut}M900N{size - cut}M"]) if ref >= 0 else "*"
        pos = rng.randrange(CONTIGS[ref][1] - 2000) if ref >= 0 else -1
        out.append((f"read:{k}:ACGT", 0 if ref >= 0 else 4, ref, pos, cigar, "".join(rng.choices("ACGTN", k=size)), rng.choice([f"{size}", None])))
    return sorted(out, key=lambda r: (r[2] < 0, r[2], r[3]))


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("bam")
    index = write_bam(d / "a.bam", reads(3000), [900, 40, 3000, 9_000])
    (d / "a.bam.bai").write_bytes(index)
    write_bam(d / "plain.bam", reads(800, 3), [500])
    return d


COLUMNS = ["read_id", "qname", "flag", "contig", "start", "end", "cigar", "md", "seq", "qual"]


def rows(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=lambda r: r[0])


def test_any_number_of_splits(spark, files):
    for name, n in (("a.bam", 3000), ("plain.bam", 800)):
        size = (files / name).stat().st_size
        one = rows(al.bam(spark, str(files / name), split_bytes=size + 1))
        assert [r[1:3] for r in one] == [(q, flag) for q, flag, *_ in reads(n, 2 if n == 3000 else 3)]
        for k in (3, 17):
            got = al.bam(spark, str(files / name), split_bytes=size // k)
            assert got.rdd.getNumPartitions() >= k and rows(got) == one
    assert rows(al.bam(spark, (files / "a.bam").as_uri(), split_bytes=40_000)) == rows(al.bam(spark, str(files / "a.bam")))
    both = rows(al.bam(spark, str(files), split_bytes=90_000))
    assert len(both) == 3800 and len({r[0] for r in both}) == 3800
    assert len(rows(al.bam(spark, f"{files}/pl*.bam"))) == 800


def test_records_longer_than_blocks_and_splits(spark, tmp_path):
    """Records of 100 kB and more, one read across several splits; names and tags that look like records."""
    some = reads(40, 5, 60_000)
    write_bam(tmp_path / "long.bam", some, [700, 30_000])
    size = (tmp_path / "long.bam").stat().st_size
    one = rows(al.bam(spark, str(tmp_path / "long.bam")))
    assert [r[1] for r in one] == [q for q, *_ in some]
    assert rows(al.bam(spark, str(tmp_path / "long.bam"), split_bytes=size // 12)) == one


def test_no_reads_and_broken_files(spark, tmp_path):
    write_bam(tmp_path / "none.bam", [], [50])
    assert al.bam(spark, str(tmp_path / "none.bam"), split_bytes=30).count() == 0
    assert al.bam_contigs(spark, str(tmp_path / "none.bam")).count() == 3
    data = write_bam(tmp_path / "cut.bam", reads(50), [400]) and (tmp_path / "cut.bam").read_bytes()
    (tmp_path / "cut.bam").write_bytes(data[: len(data) // 2])
    with pytest.raises(Exception, match="no whole block|file ends"):
        al.bam(spark, str(tmp_path / "cut.bam")).count()


def test_index_reads_few_blocks(files, monkeypatch):
    """A reader with filters inflates a part of the file; its rows that match are those of the whole file."""
    path, inflated = str(files / "a.bam"), []
    monkeypatch.setattr(bam, "inflate", lambda data, real=bam.inflate: inflated.append(1) or real(data))

    def read(reader):
        inflated.clear()
        found = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
        return found, len(inflated)

    every, all_blocks = read(bam.BamReader({"path": path}))
    for contig, begin, end in (("chr1", 50_000, 51_000), ("chr1", 0, 3), ("chr2", 80_000, 90_000), ("chr1", 16_000, 17_000), ("chrEmpty", 0, 9), ("chr9", 0, 9)):
        reader = bam.FilteringBamReader({"path": path})
        filters = [EqualTo(("contig",), contig), LessThan(("start",), end), GreaterThan(("end",), begin)]
        assert list(reader.pushFilters(filters)) == filters
        found, some = read(reader)
        inside = lambda r: r["contig"] == contig and r["start"] < end and r["end"] > begin  # noqa: E731,B023
        assert [r for r in found if inside(r)] == [r for r in every if inside(r)]
        assert some < all_blocks / 4 and len({r["read_id"] for r in found}) == len(found)


def test_pushed_filters_and_regions(spark, files):
    path = str(files / "a.bam")
    every = al.bam(spark, path)
    where = "contig = 'chr1' AND start < 130000 AND end > 120000"
    want = rows(every.where(where))
    key = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        narrow = lambda name="a.bam": al.bam(spark, str(files / name), split_bytes=9000, pushdown=True)
        assert narrow().where(where).rdd.getNumPartitions() < narrow().rdd.getNumPartitions() / 4
        assert rows(narrow().where(where)) == want and len(want) > 20
        assert rows(narrow().where("contig IN ('chr2') AND end >= 500")) == rows(every.where("contig = 'chr2' AND end >= 500"))
        assert rows(narrow("plain.bam").where(where)) == rows(al.bam(spark, str(files / "plain.bam")).where(where))
    finally:
        spark.conf.set(key, before)
    targets = spark.createDataFrame([("chr1", 120_000, 130_000), ("chr2", 5, 50), ("chr7", 1, 2)], "contig string, start bigint, end bigint")
    from barkline.operators import pileup as pl

    hit = lambda df: rows(pl.in_regions(df, targets))
    assert hit(al.bam(spark, path, targets)) == hit(every)
    assert al.bam(spark, path, targets).count() < 1500


def fastq_text(n, seed=1):
    rng = random.Random(seed)
    return "".join(f"@r{seed}.{k} 1:N\n{'ACGT' * rng.randrange(1, 30)}\n+\n{'@' * rng.randrange(1, 90)}\n" for k in range(n))


def test_fastq_splits(spark, tmp_path):
    """Ordinals run over files; splits of any size, gzip, mates of several files."""
    long = f"@long\n{'A' * 9000}\n+\n{'I' * 9000}\n"  # its lines lie across several splits
    parts = {"r1_a.fq": fastq_text(499) + long, "r1_b.fq": long + fastq_text(299, 2), "r1_c.fq.gz": fastq_text(20, 3)}
    for name, text in parts.items():
        (tmp_path / name).write_bytes(gzip.compress(text.encode()) if name.endswith(".gz") else text.encode())
    lines = [line for text in parts.values() for line in text.split("\n")[:-1]]
    want = [(k, *lines[4 * k : 4 * k + 4]) for k in range(820)]
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        for size in ("128m", "20000", "3000"):
            spark.conf.set(key, size)
            got = al.fastq(spark, f"{tmp_path}/r1_*")
            assert sorted(map(tuple, got.collect())) == want
        from barkline.operators import preprocess as pp

        mates = pp.zip_mates([al.fastq(spark, f"{tmp_path}/r1_*"), al.fastq(spark, f"{tmp_path}/r1_a.fq")])
        assert mates.count() == 500 and mates.where("r1.seq <> r2.seq").count() == 0
    finally:
        spark.conf.set(key, before)
    (tmp_path / "short.fq").write_text("@a\nAC\n+\nII\n@b\nGT\n")
    assert sorted(map(tuple, al.fastq(spark, f"{tmp_path}/short.fq").collect())) == [(0, "@a", "AC", "+", "II"), (1, "@b", "GT", None, None)]
    (tmp_path / "empty.fq").write_text("")
    assert al.fastq(spark, f"{tmp_path}/empty.fq").where(F.col("ord") >= 0).count() == 0
