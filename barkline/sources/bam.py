"""BAM files in splits of bounded bytes, through an index where there is one.

A BAM file is a row of BGZF blocks (gzip members that state their size) whose contents, put together, are a header
and records; a record may lie across blocks. A split is a range of the file's bytes: it owns the records that
begin in the blocks that begin in the range. Its reader finds the first block (a chain of headers whose
sizes lead to each other) and in it the first record (one that is consistent to its last tag, and so are those
behind it), and reads past the range's end to finish the last record. So any number of splits gives the same rows, each once.

With a ``.bai`` file beside a BAM file, filters on contig, start and end that Spark pushes down (or the option
``regions``) become chunks of the file, from the index's bins and linear offsets, and nothing else is read.

Paths are of any file system that pyarrow opens by URI (local, hdfs, s3, gs, abfs); folders and globs too.
Rows: a read's read_id is its virtual offset (with the file's number above it), the same in any split.
"""

from __future__ import annotations

import fnmatch
import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual,
)

ALIGNMENTS = "read_id bigint, qname string, flag int, contig string, start bigint, end bigint, cigar string, md string, seq string, qual array<int>"

SPLIT = 64 << 20
#: Bytes read at a time, inflated bytes looked at for a first record, and records of an Arrow batch.
WINDOW, LOOK, ROWS = 1 << 20, 1 << 18, 2000

#: Fixed values of the format: packed bases, CIGAR operations, those that cover the reference, sizes of tag values.
BASES = str.maketrans("0123456789abcdef", "=ACMGRSVTWYHKDBN")
OPS = "MIDNSHP=X"
ON_REFERENCE = frozenset((0, 2, 3, 7, 8))
TAG_SIZES = {b"A": 1, b"c": 1, b"C": 1, b"s": 2, b"S": 2, b"i": 4, b"I": 4, b"f": 4}
#: Fixed values of the index: first bin and position bits of each level, the bin of statistics, bits of a linear window.
BIN_LEVELS = ((0, 29), (1, 26), (9, 23), (73, 20), (585, 17), (4681, 14))
STATISTICS_BIN, LINEAR = 37450, 14

_CORE = struct.Struct("<iiiBBHHHiiii")
_MAGIC = b"\x1f\x8b\x08\x04"


# -- files -----------------------------------------------------------------------------------------


def _located(path: str) -> tuple[pa.fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pa.fs.LocalFileSystem(), path
    return pa.fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def listed(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the BAM files that a path, a folder or a glob of names names, in order."""
    fs, at = _located(path)
    prefix = path[: len(path) - len(at)] if path.endswith(at) else ""
    info = fs.get_file_info(at)
    if info.type == pa.fs.FileType.File:
        return [(path, info.size)]
    folder, glob = (at, "*.bam") if info.type == pa.fs.FileType.Directory else at.rsplit("/", 1)
    found = fs.get_file_info(pa.fs.FileSelector(folder, allow_not_found=True))
    out = sorted((prefix + f.path, f.size) for f in found if f.type == pa.fs.FileType.File and fnmatch.fnmatch(f.base_name, glob) and not f.base_name.endswith(".bai"))
    if not out:
        raise FileNotFoundError(path)
    return out


def opened(path: str) -> pa.NativeFile:
    fs, at = _located(path)
    return fs.open_input_file(at)


def index_of(path: str) -> bytes | None:
    """The index beside a BAM file."""
    for name in (f"{path}.bai", f"{path.removesuffix('.bam')}.bai"):
        fs, at = _located(name)
        if fs.get_file_info(at).type == pa.fs.FileType.File:
            with opened(name) as f:
                return f.read()
    return None


# -- blocks ----------------------------------------------------------------------------------------


def block_at(data: bytes, at: int) -> tuple[int, int] | None:
    """(bytes of the block, where its deflated data begins) if a block's header is at ``at``."""
    if data[at : at + 4] != _MAGIC or len(data) < at + 12:
        return None
    extra = struct.unpack_from("<H", data, at + 10)[0]
    p, end = at + 12, at + 12 + extra
    while p + 6 <= min(end, len(data)):
        size = struct.unpack_from("<H", data, p + 2)[0]
        if data[p : p + 2] == b"BC" and size == 2:
            return struct.unpack_from("<H", data, p + 4)[0] + 1, 12 + extra
        p += 4 + size
    return None


def inflate(data: bytes) -> bytes:
    return zlib.decompress(data, -15)


def blocks(f: pa.NativeFile, at: int) -> Iterator[tuple[int, bytes]]:
    """(offset, contents) of the blocks from ``at`` on."""
    f.seek(at)
    data, p = b"", 0
    while True:
        if len(data) - p < 1 << 16:
            data, p = data[p:] + f.read(WINDOW), 0
        if p == len(data):
            return
        found = block_at(data, p)
        if found is None or p + found[0] > len(data):
            raise ValueError(f"no whole block at byte {at}")
        size, skip = found
        yield at, inflate(data[p + skip : p + size - 8])
        p, at = p + size, at + size


def first_block(f: pa.NativeFile, begin: int, end: int) -> int | None:
    """The first block that begins in [begin, end): its size leads to another one, twice, or to the file's end."""
    total = f.size()
    while begin < end:
        f.seek(begin)
        # a block has 64 KiB at most, so this holds the two behind any that begins in its first part
        data = f.read(4 << 16)
        for p in range(min(1 << 16, len(data), end - begin)):
            if data[p : p + 4] != _MAGIC:
                continue
            at, ok = p, True
            for _ in range(3):
                found = block_at(data, at)
                ok = found is not None and begin + at + found[0] <= total
                if not ok or begin + at + found[0] == total:
                    break
                at += found[0]
            if ok:
                return begin + p
        begin += 1 << 16
    return None


# -- records ---------------------------------------------------------------------------------------


def header(f: pa.NativeFile) -> tuple[list[tuple[str, int]], int]:
    """((contig, length) of each contig, virtual offset of the first record)."""
    stream = blocks(f, 0)
    data, ends = b"", []  # ends: (bytes so far, offset of the block behind)

    def upto(n: int) -> None:
        nonlocal data
        while len(data) < n:
            at, more = next(stream, (None, b""))
            if at is None:
                raise ValueError("the file ends in its header")
            ends.append((len(data), at))
            data += more

    upto(8)
    if data[:4] != b"BAM\1":
        raise ValueError("no BAM file")
    p = 12 + struct.unpack_from("<i", data, 4)[0]
    upto(p)
    contigs = []
    for _ in range(struct.unpack_from("<i", data, p - 4)[0]):
        upto(p + 4)
        n = struct.unpack_from("<i", data, p)[0]
        upto(p + 8 + n)
        contigs.append((data[p + 4 : p + 3 + n].decode(), struct.unpack_from("<i", data, p + 4 + n)[0]))
        p += 8 + n
    if p == len(data):  # the next block's start
        at, _ = next(stream, (f.size(), b""))
        return contigs, at << 16
    start, at = [e for e in ends if e[0] <= p][-1]
    return contigs, at << 16 | p - start


def records(f: pa.NativeFile, begin: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(virtual offset, record) of those that begin in [begin, end)."""
    stream = blocks(f, begin >> 16)
    at, data = next(stream, (None, b""))
    p = begin & 0xFFFF
    while at is not None:
        if p >= len(data):
            p -= len(data)
            at, data = next(stream, (None, b""))
            continue
        v = at << 16 | p
        if v >= end:
            return
        parts, have, need = [data[p:]], len(data) - p, 4
        while have < need or need == 4:
            if have >= 4 and need == 4:
                need = 4 + struct.unpack_from("<i", parts[0] if len(parts[0]) >= 4 else b"".join(parts))[0]
                continue
            at, data = next(stream, (None, b""))
            if at is None:
                raise ValueError(f"the file ends in the record at {v}")
            parts.append(data)
            have += len(data)
        body = parts[0][4:need] if len(parts) == 1 else b"".join(parts)[4:need]
        yield v, body
        p = len(data) - (have - need)


def tag_bytes(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, bytes, int, int]]:
    """(tag, kind, from, to) of each tag's value; raises where the tags don't fill [at, end) exactly."""
    while at < end:
        tag, kind = data[at : at + 2], data[at + 2 : at + 3]
        at += 3
        if kind in TAG_SIZES:
            to = at + TAG_SIZES[kind]
        elif kind in (b"Z", b"H"):
            to = data.index(b"\0", at, end) + 1
        elif kind == b"B":
            to = at + 5 + struct.unpack_from("<I", data, at + 1)[0] * TAG_SIZES[data[at : at + 1]]
        else:
            raise ValueError("no kind of tag")
        if to > end:
            raise ValueError("a tag ends behind its record")
        yield tag, kind, at, to
        at = to


def next_record(data: bytes, at: int, contigs: list[tuple[str, int]]) -> tuple[int, bool] | None:
    """(where the record at ``at`` ends, whether ``data`` holds it whole) if it is consistent as far as it is there."""
    if at + 36 > len(data):
        return len(data) + 1, False
    size, ref, pos, l_name, _, _, n_cigar, _, l_seq, next_ref, next_pos, _ = _CORE.unpack_from(data, at)
    core = 32 + l_name + 4 * n_cigar + (l_seq + 1) // 2 + l_seq
    n = len(contigs)
    if size < core or l_name < 1 or l_seq < 0 or not (-1 <= ref < n and -1 <= next_ref < n and pos >= -1 and next_pos >= -1):
        return None
    if ref >= 0 and pos > contigs[ref][1] or next_ref >= 0 and next_pos > contigs[next_ref][1]:
        return None
    name = data[at + 36 : at + 36 + l_name]
    if len(name) == l_name and (name[-1] or any(not 33 <= c <= 126 for c in name[:-1])):
        return None
    end = at + 4 + size
    if end > len(data):
        return end, False
    ops = np.frombuffer(data, "<u4", n_cigar, at + 36 + l_name)
    if (ops & 15 > 8).any():
        return None
    try:
        for _ in tag_bytes(data, at + 4 + core, end):
            pass
    except (ValueError, KeyError, struct.error):
        return None
    return end, True


def first_record(f: pa.NativeFile, begin: int, end: int, contigs: list[tuple[str, int]]) -> int | None:
    """The virtual offset of the first record that begins in a block that begins in [begin, end).

    It is the first place from which consistent records follow each other: 50 of them, or to the end of
    the file, or through ``LOOK`` bytes.
    """
    block = first_block(f, begin, end)
    if block is None:
        return None
    stream, data, starts, ended = blocks(f, block), b"", [], False

    def chain(at: int) -> bool | None:
        """Whether records follow each other from ``at``; none if more data is needed to tell."""
        p = at
        for n in range(50):
            if p == len(data) and ended:
                return n > 0
            found = next_record(data, p, contigs)
            if found is None:
                return False
            if not found[1]:
                return False if ended else True if n >= 3 and len(data) - at >= LOOK else None
            p = found[0]
        return True

    u = 0
    while True:
        told = None
        if u < len(data):
            start, at = next(s for s in reversed(starts) if s[0] <= u)
            if at >= end:
                return None
            told = chain(u)
        elif ended:
            return None
        if told is None:
            at, more = next(stream, (None, b""))
            ended = at is None
            if more:
                starts.append((len(data), at))
                data += more
        elif told:
            return at << 16 | u - start
        else:
            u += 1


def batch(found: list[tuple[int, bytes]], contigs: list[tuple[str, int]], base: int) -> pa.RecordBatch:
    """Records as rows; ``base`` is added to their offsets."""
    ids, names, flags, on, begins, ends, cigars, mds, seqs, quals = ([] for _ in range(10))
    for v, b in found:
        ref, pos, l_name, _, _, n_cigar, flag, l_seq = struct.unpack_from("<iiBBHHHi", b)
        at = 32 + l_name
        ops = struct.unpack_from(f"<{n_cigar}I", b, at)
        at += 4 * n_cigar
        half = at + (l_seq + 1) // 2
        ids.append(base + v), names.append(b[32 : 31 + l_name].decode()), flags.append(flag)
        on.append(contigs[ref][0] if ref >= 0 else None), begins.append(pos)
        ends.append(pos + sum(o >> 4 for o in ops if o & 15 in ON_REFERENCE))
        cigars.append("".join(f"{o >> 4}{OPS[o & 15]}" for o in ops) or "*")
        seqs.append(b[at:half].hex().translate(BASES)[:l_seq])
        qual = b[half : half + l_seq]
        quals.append(b"" if qual[:1] == b"\xff" else qual)
        mds.append(next((b[p : to - 1].decode() for tag, kind, p, to in tag_bytes(b, half + l_seq, len(b)) if tag == b"MD" and kind == b"Z"), None))
    places = np.concatenate([[0], np.cumsum([len(q) for q in quals])]).astype(np.int32)
    qual = pa.ListArray.from_arrays(pa.array(places), pa.array(np.frombuffer(b"".join(quals), np.uint8).astype(np.int32)))
    text, whole = pa.string(), pa.int64()
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, whole), pa.array(names, text), pa.array(flags, pa.int32()), pa.array(on, text), pa.array(begins, whole), pa.array(ends, whole),
         pa.array(cigars, text), pa.array(mds, text), pa.array(seqs, text), qual],
        names=["read_id", "qname", "flag", "contig", "start", "end", "cigar", "md", "seq", "qual"],
    )


# -- the index -------------------------------------------------------------------------------------


class Index:
    """The chunks and linear offsets of each contig."""

    def __init__(self, data: bytes):
        if data[:4] != b"BAI\1":
            raise ValueError("no BAM index")
        self.bins: list[dict[int, list[tuple[int, int]]]] = []
        self.linear: list[tuple[int, ...]] = []
        at = 8
        for _ in range(struct.unpack_from("<i", data, 4)[0]):
            bins: dict[int, list[tuple[int, int]]] = {}
            n, at = struct.unpack_from("<i", data, at)[0], at + 4
            for _ in range(n):
                number, m = struct.unpack_from("<Ii", data, at)
                flat = struct.unpack_from(f"<{2 * m}Q", data, at + 8)
                at += 8 + 16 * m
                if number != STATISTICS_BIN:
                    bins[number] = list(zip(flat[::2], flat[1::2], strict=True))
            n, at = struct.unpack_from("<i", data, at)[0], at + 4
            self.bins.append(bins)
            self.linear.append(struct.unpack_from(f"<{n}Q", data, at))
            at += 8 * n

    def chunks(self, contig: int, begin: int, end: int) -> list[tuple[int, int]]:
        """Virtual offsets between which reads that overlap [begin, end) lie."""
        if contig >= len(self.bins) or begin >= end:
            return []
        begin, bins, linear = max(begin, 0), self.bins[contig], self.linear[contig]
        last = min(end, 1 << BIN_LEVELS[0][1]) - 1
        if begin > last:
            return []
        least = linear[min(begin >> LINEAR, len(linear) - 1)] if linear else 0
        numbers = (first + k for first, bits in BIN_LEVELS for k in range(begin >> bits, (last >> bits) + 1))
        return sorted((max(a, least), b) for n in numbers for a, b in bins.get(n, ()) if b > least)


def joined(chunks: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Chunks without overlaps; neighbours that meet in a block are one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(chunks):
        if out and a >> 16 <= out[-1][1] >> 16:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


# -- the source ------------------------------------------------------------------------------------


@dataclass
class Span(InputPartition):
    """The records of a file that begin in [begin, end), virtual offsets; an ``exact`` begin is a record's."""

    path: str
    base: int
    begin: int
    end: int
    exact: bool


class BamReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.header_only = options["path"], options.get("part") == "header"
        self.split = int(options.get("split_bytes", SPLIT))
        self.regions: list[tuple[str, int, int]] | None = [tuple(r) for r in json.loads(options["regions"])] if "regions" in options else None

    def partitions(self) -> list[InputPartition]:
        files = listed(self.path)
        bits = max(size for _, size in files).bit_length() + 16
        if len(files).bit_length() + bits > 63:
            raise ValueError(f"{len(files)} files of up to {max(s for _, s in files)} bytes are too many for one table")
        if self.header_only:
            return [Span(path, 0, 0, 0, True) for path, _ in files]
        out: list[InputPartition] = []
        for k, (path, size) in enumerate(files):
            index = index_of(path) if self.regions is not None else None
            wanted = [(0, size << 16)] if index is None else self._chunks(path, Index(index))
            for begin, end in wanted:
                cuts = list(range((begin >> 16) + self.split, (end >> 16) + 1, self.split))
                ends = [*(c << 16 for c in cuts if c << 16 < end), end]
                out += [Span(path, k << bits, a, b, a == begin and index is not None) for a, b in zip([begin, *ends], ends, strict=False)]
        return out

    def _chunks(self, path: str, index: Index) -> list[tuple[int, int]]:
        with opened(path) as f:
            number = {name: k for k, (name, _) in enumerate(header(f)[0])}
        return joined([c for contig, begin, end in self.regions or [] if contig in number for c in index.chunks(number[contig], begin, end)])

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        with opened(partition.path) as f:
            contigs, first = header(f)
            if self.header_only:
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in contigs], pa.string()), pa.array([n for _, n in contigs], pa.int64())], names=["contig", "length"])
                return
            begin, end = partition.begin, partition.end
            if begin <= first:
                begin = first
            elif not partition.exact:
                begin = first_record(f, begin >> 16, (end + 0xFFFF) >> 16, contigs)
            held = []
            for r in records(f, begin, end) if begin is not None and begin < end else ():
                held.append(r)
                if len(held) == ROWS:
                    yield batch(held, contigs, partition.base)
                    held = []
            if held:
                yield batch(held, contigs, partition.base)


class FilteringBamReader(BamReader):
    """Takes filters on contig, start and end to the index; Spark still applies them to the rows."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        contigs, begin, end = None, 0, 1 << 40
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name == "contig" and isinstance(f, EqualTo):
                contigs = [f.value]
            elif name == "contig" and isinstance(f, In):
                contigs = list(f.value)
            elif name == "start" and isinstance(f, LessThan | LessThanOrEqual):
                end = min(end, f.value + isinstance(f, LessThanOrEqual))
            elif name == "end" and isinstance(f, GreaterThan | GreaterThanOrEqual):
                # a read without reference bases ends where it starts and is indexed as one base
                begin = max(begin, f.value - isinstance(f, GreaterThanOrEqual))
            yield f
        if contigs is not None and self.regions is None:
            self.regions = [(c, begin, end) for c in contigs if c is not None]


class BamSource(DataSource):
    """``spark.read.format("bam").load(path)``.

    Options: part=header gives (contig, length); split_bytes; regions, a JSON list of [contig, start, end] that an
    index may narrow the read to; pushdown=true (see ``alignments.bam``).
    """

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return "contig string, length bigint" if self.options.get("part") == "header" else ALIGNMENTS

    def reader(self, schema) -> DataSourceReader:
        pushed = self.options.get("pushdown") == "true" and self.options.get("part") != "header"
        return FilteringBamReader(self.options) if pushed else BamReader(self.options)
