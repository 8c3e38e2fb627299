"""Aligned reads against regions, and reads expanded to a base a position."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barkline.functions.sequences import (
    FLAG_DUPLICATE, FLAG_PROPER, FLAG_QCFAIL, FLAG_SECONDARY, FLAG_UNMAPPED, has_flag, overlaps, umi_from_name,
)

#: Positions of a bin of the interval join.
BIN = 10_000

_CIGAR = re.compile(r"(\d+)([MIDNSHP=X])")
_MD = re.compile(r"(\d+)|\^([A-Za-z]+)|([A-Za-z])")


def in_regions(alignments: DataFrame, regions: DataFrame, size: int = BIN) -> DataFrame:
    """Reads of each region (contig, start, end): an equality join on bins, then the overlap.

    A read goes to the bins that it touches and a region to those that it touches; a pair counts in
    the first bin that both touch, so nothing is counted twice and nothing needs a distinct.
    """
    bins = lambda a, b: F.sequence(F.floor(a / size), F.floor((b - 1) / size))
    end = F.greatest(F.col("end"), F.col("start") + 1)
    a = alignments.withColumn("bin", F.explode(bins(F.col("start"), end)))
    r = regions.select(F.col("contig"), F.col("start").alias("region_start"), F.col("end").alias("region_end"))
    r = r.withColumn("bin", F.explode(bins(F.col("region_start"), F.col("region_end"))))
    hit = a.join(r, ["contig", "bin"]).where(overlaps(F.col("start"), end, F.col("region_start"), F.col("region_end")))
    hit = hit.where(F.col("bin") == F.floor(F.greatest("start", "region_start") / size)).drop("bin")
    name = F.concat(F.col("contig"), F.lit(":"), (F.col("region_start") + 1).cast("string"), F.lit("-"), F.col("region_end").cast("string"))
    return hit.withColumn("region", name)


def region_read_counts(alignments: DataFrame, regions: DataFrame) -> DataFrame:
    return in_regions(alignments, regions).groupBy("region").agg(F.count(F.lit(1)).alias("n_reads"))


def stepped(alignments: DataFrame, stepper: str = "nofilter", ignore_orphans: bool = False) -> DataFrame:
    """Reads that a pileup sees: ``all`` drops unmapped, secondary, failed and duplicate reads."""
    flag = F.col("flag")
    if stepper == "all":
        alignments = alignments.where(flag.bitwiseAND(F.lit(FLAG_UNMAPPED | FLAG_SECONDARY | FLAG_QCFAIL | FLAG_DUPLICATE)) == 0)
    elif stepper != "nofilter":
        raise ValueError("stepper is all or nofilter")
    return alignments.where(~has_flag(flag, 0x1) | has_flag(flag, FLAG_PROPER)) if ignore_orphans else alignments


def reference_bases(cigar: list[tuple[int, str]], md: str | None, seq: str) -> list[str]:
    """Reference bases under the M, =, X and D operations, in order; without MD the read's own."""
    out: list[str] = []
    at = 0
    for n, op in cigar:
        if op in "M=X":
            out += seq[at : at + n]
        elif op == "D":
            out += "N" * n
        at += n if op in "M=XIS" else 0
    if md is None:
        return out
    k = 0
    for number, deleted, other in _MD.findall(md):
        if number:
            k += int(number)
        else:
            for c in deleted or other:
                if k < len(out):
                    out[k] = c.upper()
                k += 1
    return out


def expand(start: int, cigar: str, md: str | None, seq: str, qual: list[int]) -> list[tuple[int, str, str, int]]:
    """(pos, ref, alt, q) of each aligned base; an indel is reported at the base before it.

    An insertion has a longer alt, a deletion a longer ref. Positions inside deletions and skips have
    no base of the read and are left out; clipped bases aren't aligned.
    """
    ops = [(int(n), op) for n, op in _CIGAR.findall(cigar)]
    ref = reference_bases(ops, md, seq)
    out: list[tuple[int, str, str, int]] = []
    pos, at, k = start, 0, 0
    for n, op in ops:
        if op in "M=X":
            for i in range(n):
                out.append((pos + i, ref[k + i].upper(), seq[at + i].upper(), qual[at + i] if qual else 0))
            pos, at, k = pos + n, at + n, k + n
        elif op == "I":
            if out and out[-1][0] == pos - 1:
                p, r, a, q = out[-1]
                out[-1] = (p, r, a + seq[at : at + n].upper(), q)
            at += n
        elif op == "D":
            if out and out[-1][0] == pos - 1:
                p, r, a, q = out[-1]
                out[-1] = (p, r + "".join(ref[k : k + n]).upper(), a, q)
            pos, k = pos + n, k + n
        elif op == "N":
            pos += n
        elif op == "S":
            at += n
    return out


@dataclass
class Layout:
    """What one CIGAR does to each read that has it, by run lengths."""

    #: Of each aligned base: place after the read's start, in the read, among the reference's bases.
    off: np.ndarray
    at: np.ndarray
    ref: np.ndarray
    #: Places among the aligned bases with what follows them: (base, place in the read, letters), (base, place in the reference, letters).
    inserted: list[tuple[int, int, int]]
    deleted: list[tuple[int, int, int]]
    #: Letters of a read and of the reference in all; reference letters that a deletion holds.
    length: int
    span: int
    gone: np.ndarray


def layout(cigar: str) -> Layout:
    off, at, ref, gone = [], [], [], []
    inserted, deleted = [], []
    pos = place = k = bases = 0
    last = -2  # position of the last aligned base
    for number, op in _CIGAR.findall(cigar):
        n = int(number)
        run = np.arange(n)
        if op in "M=X":
            off.append(pos + run), at.append(place + run), ref.append(k + run)
            pos, place, k, bases = pos + n, place + n, k + n, bases + n
            last = pos - 1 if n else last
        elif op == "I":
            if last == pos - 1:
                inserted.append((bases - 1, place, n))
            place += n
        elif op == "D":
            if last == pos - 1:
                deleted.append((bases - 1, k, n))
            gone.append(k + run)
            pos, k = pos + n, k + n
        elif op == "N":
            pos += n
        elif op == "S":
            place += n
    joined = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return Layout(joined(off), joined(at), joined(ref), inserted, deleted, place, k, joined(gone))


def mismatches(md: str, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Places among ``span`` reference bases that an MD tag names, and their letters."""
    places, letters, k = [], [], 0
    for number, gone, other in _MD.findall(md):
        if number:
            k += int(number)
        else:
            named = (gone or other).upper()
            places.append(np.arange(k, k + len(named)))
            letters.append(np.frombuffer(named.encode(), np.uint8))
            k += len(named)
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    places, letters = np.concatenate(places), np.concatenate(letters)
    return places[places < span], letters[places < span]


def _letters(codes: np.ndarray) -> pa.Array:
    """Strings of one letter each."""
    return pa.Array.from_buffers(pa.string(), codes.size, [None, pa.py_buffer(np.arange(codes.size + 1, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(codes))])


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a string or list column, and the offsets of its rows."""
    if pa.types.is_string(column.type):
        raw = column.buffers()
        offsets = np.frombuffer(raw[1], np.int32, len(column) + 1, column.offset * 4)
        return np.frombuffer(raw[2], np.uint8) if raw[2] else np.zeros(0, np.uint8), offsets.astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy().astype(np.int64)


def expand_reads(start: pa.Array, cigar: pa.Array, md: pa.Array, seq: pa.Array, qual: pa.Array, low: np.ndarray | None = None, high: np.ndarray | None = None) -> tuple[np.ndarray, pa.RecordBatch]:
    """What ``expand`` gives for each of many reads: (the read's row of each base, a batch of pos, ref, alt, q).

    Reads that share CIGAR and MD are one matrix: positions, letters and qualities are gathered by the CIGAR's
    run lengths, and MD sets columns of it; only bases before an indel are put together one by one. Reads whose
    sequence has not the CIGAR's length (such as ``*``) have no bases. ``low`` and ``high`` keep positions in between.
    """
    starts = start.to_numpy(zero_copy_only=False).astype(np.int64)
    letters, first = _flat(seq.fill_null(""))
    upper = np.where((letters >= 97) & (letters <= 122), letters - 32, letters).astype(np.uint8)
    quality, q_first = _flat(qual)
    size, q_size = np.diff(first), np.where(np.asarray(qual.is_null()), 0, np.diff(q_first))
    pair = pa.array(pc.binary_join_element_wise(cigar.fill_null(""), md.fill_null("-"), "\t")).dictionary_encode()
    codes, names = pair.indices.to_numpy(zero_copy_only=False), pair.dictionary.to_pylist()
    order = np.argsort(codes, kind="stable")
    cuts = np.flatnonzero(np.diff(codes[order])) + 1
    rows, pos, ref, alt, q = [], [], [], [], []
    for group in np.split(order, cuts) if len(order) else []:
        text, tag = names[codes[group[0]]].split("\t")
        what = layout(text)
        group = group[size[group] == what.length]
        if not len(what.off) or not len(group):
            continue
        where = starts[group][:, None] + what.off
        keep = np.ones(where.shape, bool) if low is None else (where >= low[group][:, None]) & (where < high[group][:, None])
        read = upper[first[group][:, None] + what.at]
        under = read.copy()
        bases = np.full(what.span, ord("N"), np.uint8)
        if tag != "-":
            places, named = mismatches(tag, what.span)
            bases[places] = named
            at = np.full(what.span, -1)
            at[what.ref] = np.arange(len(what.ref))
            met = at[places] >= 0
            under[:, at[places][met]] = named[met]
        full = q_size[group] == what.length
        score = np.zeros(where.shape, np.int32)
        score[full] = quality[q_first[group[full]][:, None] + what.at]
        rows.append(np.broadcast_to(group[:, None], where.shape)[keep])
        pos.append(where[keep]), q.append(score[keep])
        if not what.inserted and not what.deleted:
            ref.append(_letters(under[keep])), alt.append(_letters(read[keep]))
            continue
        # a base before an indel has more than one letter
        below, above = under.view("S1").astype(object), read.view("S1").astype(object)
        for base, k, n in what.deleted:
            below[:, base] += bases[k : k + n].tobytes()
        for base, place, n in what.inserted:
            more = upper[first[group][:, None] + place + np.arange(n)]
            above[:, base] += np.array([m.tobytes() for m in more], object)
        ref.append(pa.array(below[keep], pa.binary()).cast(pa.string())), alt.append(pa.array(above[keep], pa.binary()).cast(pa.string()))
    joined = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
    strings = lambda x: pa.concat_arrays(x) if x else pa.array([], pa.string())
    out = [pa.array(joined(pos, np.int64), pa.int64()), strings(ref), strings(alt), pa.array(joined(q, np.int32), pa.int32())]
    return joined(rows, np.int64), pa.RecordBatch.from_arrays(out, names=["pos", "ref", "alt", "q"])


#: Reads, and letters of reads, that are expanded at a time.
READS_AT_ONCE, LETTERS_AT_ONCE = 1000, 1 << 20


def pileup(reads: DataFrame, separator: str = ":", truncate: bool = True) -> DataFrame:
    """(region, pos, read_id, umi, start, ref, alt, q) of reads in regions, by Arrow batches.

    ``truncate`` keeps positions inside the region only. Columns that expansion needs are selected
    before the Python worker, so nothing else is sent to it.
    """
    sent = reads.select("region", "region_start", "region_end", "read_id", umi_from_name(F.col("qname"), separator).alias("umi"), "start", "cigar", "md", "seq", "qual")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            longest = pc.max(pc.binary_length(batch.column("seq"))).as_py() or 1
            step = max(1, min(READS_AT_ONCE, LETTERS_AT_ONCE // max(1, longest)))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                bounds = [part.column(c).to_numpy(zero_copy_only=False) if truncate else None for c in ("region_start", "region_end")]
                rows, bases = expand_reads(*[part.column(c) for c in ("start", "cigar", "md", "seq", "qual")], *bounds)
                kept = part.select(["region", "read_id", "umi", "start"]).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [kept.column("region"), bases.column("pos"), kept.column("read_id"), kept.column("umi"), kept.column("start"),
                     bases.column("ref"), bases.column("alt"), bases.column("q")],
                    names=["region", "pos", "read_id", "umi", "start", "ref", "alt", "q"],
                )

    return sent.mapInArrow(run, "region string, pos bigint, read_id bigint, umi string, start bigint, ref string, alt string, q int")


def register_read_bases(spark: SparkSession) -> None:
    """Register the table function ``read_bases(start, cigar, md, seq, qual)`` for SQL: LATERAL read_bases(...) gives
    (pos, ref, alt, q) of each aligned base of a read. ``pileup`` is the way for whole tables."""

    @F.udtf(returnType="pos bigint, ref string, alt string, q int")
    class ReadBases:
        def eval(self, start: int, cigar: str, md: str, seq: str, qual: list):
            if start is None or not seq:
                return
            one = [pa.array([start], pa.int64()), *[pa.array([x], pa.string()) for x in (cigar, md, seq)], pa.array([qual or []], pa.list_(pa.int32()))]
            yield from zip(*[c.to_pylist() for c in expand_reads(*one)[1].columns])

    spark.udtf.register("read_bases", ReadBases)


#: Slices of a deep column's read numbers that are counted before any of its rows are ordered.
SLICES = 4096


def capped(piled: DataFrame, most: int) -> DataFrame:
    """The bases of the first ``most`` reads, by read number, of each column (region, pos).

    Columns are counted first; those within the cap are left alone. A deeper column's read numbers are cut into
    slices whose counts, summed in order, tell which slices lie within the cap and which one the cap cuts; only
    the rows of that one are numbered. So the work on a column of any depth is dealt out.
    """
    deep = piled.groupBy("region", "pos").agg(F.count(F.lit(1)).alias("n"), F.min("read_id").alias("lo"), F.max("read_id").alias("hi")).where(F.col("n") > most)
    if deep.isEmpty():
        return piled
    width = F.floor((F.col("hi") - F.col("lo")) / F.lit(SLICES)) + 1
    sliced = piled.join(deep.drop("n"), ["region", "pos"]).withColumn("slice", F.floor((F.col("read_id") - F.col("lo")) / width)).drop("lo", "hi")
    counts = sliced.groupBy("region", "pos", "slice").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("region", "pos").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("upto", F.sum("n").over(upto)).withColumn("left", F.lit(most) - (F.col("upto") - F.col("n")))
    kept = sliced.join(counts.where("left > 0"), ["region", "pos", "slice"])
    whole = kept.where("left >= n")
    nth = F.row_number().over(Window.partitionBy("region", "pos", "slice").orderBy("read_id"))
    cut = kept.where("left < n").withColumn("nth", nth).where("nth <= left")
    shallow = piled.join(deep, ["region", "pos"], "left_anti")
    return shallow.unionByName(whole.select(*piled.columns)).unionByName(cut.select(*piled.columns))
