"""Column expressions over read names, sequences, flags, regions and contigs."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: SAM flag bits.
FLAG_PROPER, FLAG_UNMAPPED, FLAG_SECONDARY, FLAG_QCFAIL, FLAG_DUPLICATE, FLAG_SUPPLEMENTARY = 0x2, 0x4, 0x100, 0x200, 0x400, 0x800
#: IUPAC nucleotide codes.
IUPAC = "ACGTURYSWKMBDHVN"
#: Allele columns in output order.
BASES = ("A", "C", "G", "T", "N")


def hamming(a: Column, b: Column) -> Column:
    """Mismatches over the common length of two strings."""
    at = F.sequence(F.lit(1), F.least(F.length(a), F.length(b)))
    differ = F.filter(at, lambda i: F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1)))
    return F.when(F.least(F.length(a), F.length(b)) > 0, F.size(differ)).otherwise(F.lit(0))


def within(a: Column, b: Column, slices: list[tuple[int, int]], distance: int) -> Column:
    """Hamming distance at most ``distance``, slice by slice so that equal slices cost one comparison."""
    parts = [
        F.when(F.substring(a, s + 1, n) == F.substring(b, s + 1, n), F.lit(0)).otherwise(hamming(F.substring(a, s + 1, n), F.substring(b, s + 1, n)))
        for s, n in slices
    ]
    return sum(parts[1:], parts[0]) <= distance


def slice_bounds(length: int, parts: int) -> list[tuple[int, int]]:
    """(start, size) of nearly equal slices; the first ones take what is left over."""
    size, more = divmod(length, parts)
    out, at = [], 0
    for k in range(parts):
        n = size + (k < more)
        out.append((at, n))
        at += n
    return out


def umi_slices(seq: Column, positions: list[int], lengths: list[int]) -> Column:
    """array<string> of the barcodes at 1-based positions of a read."""
    return F.array(*[F.substring(seq, p, n) for p, n in zip(positions, lengths, strict=True)])


def spacer_ok(seq: Column, positions: list[int], lengths: list[int], spacer: str | None) -> Column:
    """Whether every barcode is directly followed by the spacer, in either case."""
    if not spacer:
        return F.lit(True)
    checks = [F.startswith(F.substring(F.upper(seq), p + n, len(spacer)), F.lit(spacer.upper())) & (F.length(seq) >= p + n - 1) for p, n in zip(positions, lengths, strict=True)]
    out = checks[0]
    for c in checks[1:]:
        out = out & c
    return F.coalesce(out, F.lit(False))


def renamed_read(name: Column, umi: Column) -> Column:
    """``id desc`` with the barcode appended to the id; null if the name isn't two parts."""
    parts = F.split(name, " ")
    return F.when(F.size(parts) == 2, F.concat(parts[0], F.lit(":"), umi, F.lit(" "), parts[1]))


def umi_from_name(name: Column, separator: str = ":") -> Column:
    """The last separated part of the name's first token, upper case."""
    token = F.split(F.ltrim(name), r"\s+")[0]
    return F.upper(F.element_at(F.split(token, re.escape(separator)), -1))


def is_primary(flag: Column) -> Column:
    """Mapped, not secondary, not supplementary."""
    return flag.bitwiseAND(F.lit(FLAG_UNMAPPED | FLAG_SECONDARY | FLAG_SUPPLEMENTARY)) == 0


def has_flag(flag: Column, bit: int) -> Column:
    return flag.bitwiseAND(F.lit(bit)) != 0


def contained(start: Column, end: Column, region_start: Column, region_end: Column) -> Column:
    """A read that lies inside the region (half-open coordinates); unknown counts as not inside."""
    return F.coalesce((region_start <= start) & (start < region_end) & (end <= region_end), F.lit(False))


def overlaps(start: Column, end: Column, region_start: Column, region_end: Column) -> Column:
    return (start < region_end) & (end > region_start)


REGION = r"^(chr[^:]+):(\d+)-(\d+)$"


def region_struct(region: Column) -> Column:
    """struct(contig, start, end) of ``chrN:a-b``: 0-based half-open from 1-based inclusive; else null."""
    return F.when(
        region.rlike(REGION),
        F.struct(
            F.regexp_extract(region, REGION, 1).alias("contig"),
            (F.regexp_extract(region, REGION, 2).try_cast("bigint") - 1).alias("start"),
            F.regexp_extract(region, REGION, 3).try_cast("bigint").alias("end"),
        ),
    )


def region_text(contig: Column, start: Column, end: Column) -> Column:
    """``chrN:a-b``, 1-based inclusive; NA where the contig is missing."""
    return F.coalesce(F.concat(contig, F.lit(":"), (start + 1).cast("string"), F.lit("-"), end.cast("string")), F.lit("NA"))


_PAIR = r"\(\s*['\"]([^'\"]*)['\"]\s*,\s*['\"]([^'\"]*)['\"]\s*\)"


def pair_text(pairs: Column) -> Column:
    """``('A', 'ATT');('AT', 'A')`` of an array of structs with ref and alt."""
    return F.concat_ws(";", F.transform(pairs, lambda x: F.concat(F.lit("('"), x["ref"], F.lit("', '"), x["alt"], F.lit("')"))))


def text_pairs(text: Column) -> Column:
    """array<struct<ref, alt>> of such a text, blanks and kind of quotes aside; ``A>ATT;AT>A`` is read as well."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"([A-Za-z]+)>([A-Za-z]+)", "('$1','$2')")
    side = lambda k: F.regexp_extract_all(plain, F.lit(_PAIR), k)
    return F.zip_with(side(1), side(2), lambda r, a: F.struct(r.alias("ref"), a.alias("alt")))


def file_prefix(path: Column) -> Column:
    """The name of a compressed FASTQ file up to its extension; the whole name of any other."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.regexp_replace(name, r"\.(fastq|fq)\.gz.*$", "")


def contig_order(contig: Column) -> list[Column]:
    """Sort keys: numbered contigs by number, then the others by name."""
    number = F.regexp_replace(contig, "^chr", "").try_cast("int")
    return [number.isNull().asc(), number.asc(), contig.asc()]


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100; 0 where the whole is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")) * 100, F.lit(0.0))


def known_base(base: Column) -> Column:
    """Letters outside ACGTN count as N."""
    return F.when(F.upper(base).isin(*BASES), F.upper(base)).otherwise(F.lit("N"))


#: Axis maximum up to which a tick step holds.
TICK_STEPS = ((10, 1), (50, 5), (100, 10), (200, 20), (500, 50), (1000, 100), (2000, 200), (5000, 500), (10_000, 1000),
              (20_000, 2000), (50_000, 5000), (100_000, 10_000), (500_000, 50_000), (1_000_000, 100_000))


def tick_step(top: Column) -> Column:
    """Step between axis ticks for a largest value."""
    step = F.when(top <= TICK_STEPS[0][0], F.lit(TICK_STEPS[0][1]))
    for most, size in TICK_STEPS[1:]:
        step = step.when(top <= most, F.lit(size))
    return step.otherwise(F.lit(1_000_000))
