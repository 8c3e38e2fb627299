"""Barcode extraction, spacer check, trimming and renaming of FASTQ reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barkline.functions.sequences import IUPAC, renamed_read, spacer_ok, umi_slices


@dataclass(frozen=True)
class Prep:
    """A library preparation. umi_locs are read numbers, umi_pos 1-based positions on their reads."""

    name: str
    input_reads: int
    output_reads: int
    umi_locs: tuple[int, ...]
    umi_lens: tuple[int, ...]
    umi_pos: tuple[int, ...]
    spacer: str | None = None
    inline: bool = False

    def __post_init__(self) -> None:
        if not 1 <= self.input_reads <= 3 or not 1 <= self.output_reads <= 2 or self.output_reads > self.input_reads:
            raise ValueError(f"{self.name}: {self.input_reads} input and {self.output_reads} output reads")
        if not self.umi_locs or len({len(self.umi_locs), len(self.umi_lens), len(self.umi_pos)}) != 1:
            raise ValueError(f"{self.name}: locations, lengths and positions differ in number")
        if any(x < 1 for x in (*self.umi_locs, *self.umi_lens, *self.umi_pos)) or max(self.umi_locs) > self.input_reads:
            raise ValueError(f"{self.name}: a location, length or position is out of range")
        if self.spacer is not None and not set(self.spacer.upper()) <= set(IUPAC):
            raise ValueError(f"{self.name}: spacer {self.spacer!r} has letters that are no nucleotide codes")


def zip_mates(reads: list[DataFrame]) -> DataFrame:
    """(ord, r1, r2, ...): mates of the same ordinal, as structs; the shortest file ends all."""
    out = None
    for k, r in enumerate(reads, 1):
        one = r.select("ord", F.struct("name", "seq", "plus", "qual").alias(f"r{k}"))
        out = one if out is None else out.join(one, "ord")
    return out


def extract(mates: DataFrame, prep: Prep) -> DataFrame:
    """Adds umis (array), umi (joined) and correct (every barcode is followed by the spacer)."""
    umis, correct = F.array().cast("array<string>"), F.lit(True)
    for loc in sorted(set(prep.umi_locs)):
        at = [(p, n) for k, p, n in zip(prep.umi_locs, prep.umi_pos, prep.umi_lens, strict=True) if k == loc]
        seq = F.col(f"r{loc}.seq")
        umis = F.concat(umis, umi_slices(seq, [p for p, _ in at], [n for _, n in at]))
        correct = correct & spacer_ok(seq, [p for p, _ in at], [n for _, n in at], prep.spacer)
    out = mates.withColumn("umis", umis)
    return out.withColumns({"umi": F.concat_ws("", "umis"), "correct": correct})


def reheadered(extracted: DataFrame, prep: Prep) -> DataFrame:
    """(ord, r1 [, r2]): correct reads with the barcode in the name, inline barcodes and spacers cut."""
    read = 1
    kept = [1] if prep.output_reads == 1 else ([1, 2] if prep.input_reads == 2 else [1, 3])
    if prep.input_reads == 3 and 3 in prep.umi_locs:
        kept = [1, 2]
    columns = []
    for number in kept[: prep.output_reads]:
        cut = 0
        if prep.inline:
            ends = [p - 1 + n + len(prep.spacer or "") for k, p, n in zip(prep.umi_locs, prep.umi_pos, prep.umi_lens, strict=True) if k == number]
            cut = max(ends, default=0)
        r = F.col(f"r{number}")
        columns.append(
            F.struct(
                renamed_read(r["name"], F.col("umi")).alias("name"), F.substring(r["seq"], F.lit(cut + 1), F.length(r["seq"])).alias("seq"),
                r["plus"].alias("plus"), F.substring(r["qual"], F.lit(cut + 1), F.length(r["qual"])).alias("qual"),
            ).alias(f"out{read}")
        )
        read += 1
    return extracted.where("correct").select("ord", *columns)


def umi_histogram(extracted: DataFrame) -> DataFrame:
    """(umi, count) of correct reads; barcodes of several locations count apart."""
    return extracted.where("correct").select(F.explode("umis").alias("umi")).groupBy("umi").agg(F.count(F.lit(1)).alias("count"))


def totals(extracted: DataFrame, prep: Prep) -> DataFrame:
    """One row: total, correct, incorrect and the shortest read length of each mate."""
    lengths = [F.min(F.length(f"r{k}.seq")).alias(f"length_read{k}") for k in range(1, min(prep.input_reads, 2) + 1)]
    return extracted.agg(F.count(F.lit(1)).alias("total"), F.count_if("correct").alias("correct"), F.count_if(~F.col("correct")).alias("incorrect"), *lengths)
