"""Token ids as Parquet files that training jobs read in parts.

``write`` encodes whole texts with the tokenizers library, ends each document with one id, and writes rows in
ascending doc_id order: a list column of ids (dictionary encoding: a vocabulary's ids take 16 bits or less),
and numbers that rise (doc_id, place in the shard) with delta encoding. Row groups and pages have set sizes,
and pages are indexed, so a read of some documents or of the numbers alone skips the rest.

A row says which shard it is in and how many ids of the shard come before it, so where a document starts
follows from one sum a shard: the manifest, made by reading two columns. ``documents`` gives whole rows with
their start, ``span`` the ids from one place of the corpus to another, both with filters that reach the pages.

Encoding: a text is split at the borders of the byte-level pattern by array operations over its characters, equal
words of about ``PIECE`` characters are found by sorting (``distinct``), and the library's model encodes each word
once a worker process and remembers it, within ``KEPT`` words (two generations, so that frequent words stay). Words are encoded alone, which gives the same ids, as the library encodes each match
of the pattern on its own. Texts with a character that has been assigned or reclassified since Unicode 3.2 are
left to the library as a whole, since tables of later versions differ. Strings of special tokens are text.

Plan: one shuffle, of the texts by ranges of doc_id; encoding, sorting and writing happen behind it. What is
broadcast is the tokenizer's file and the manifest (a row a file). A writer's task that is run again
writes the same file.

Edge cases: a null text is empty and holds the end id alone; rows that repeat an id stand side by side in the
order of a hash of their text (equal rows may lie in several shards); a null id comes first; a very long text is
split in pieces where a space follows a word, and is one row; an empty table gives files without rows; columns
of ``keep`` are stored beside the ids, under a leading underscore if they carry a name of this format.
"""

from __future__ import annotations

import os
import re
import unicodedata
import uuid
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyarrow.parquet
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import col, shared_dir, text_batches

#: The pattern whose borders ``borders`` finds: that of byte-level BPE files of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END_ID = 0
#: Bytes of a row group and of a page, and rows of a page at most.
ROW_GROUP = 32 << 20
PAGE = 256 << 10
PAGE_ROWS = 2000
#: Characters split at a time, and words that a worker process remembers in one generation.
PIECE = 1 << 20
KEPT = 300_000

COLUMNS = ["doc_id", "shard", "place", "n_tokens", "ids"]

_OTHER, _LETTER, _NUMBER, _SPACE, _CHANGED = range(5)


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class of each code point; _CHANGED where Unicode 3.2 and this Python's tables differ."""
    old, new = unicodedata.ucd_3_2_0.category, unicodedata.category
    table = np.full(0x110000, _CHANGED, np.uint8)
    for c in range(0x30000):
        k = new(chr(c))
        if k == old(chr(c)) and k not in ("Cn", "Cs"):
            table[c] = {"L": _LETTER, "N": _NUMBER, "Z": _SPACE}.get(k[0], _OTHER)
    table[[*range(9, 14), 0x85]] = _SPACE
    table[[0x180E, 0x200B]] = _CHANGED
    return table


def borders(c: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the pattern's matches begin in texts laid end to end; ``first`` has the place of each text that isn't
    empty. ``c`` are code points of stable classes."""
    k = _classes()[c]
    n = len(c)
    at_first = np.zeros(n + 1, bool)
    at_first[first] = at_first[n] = True
    starts = np.empty(n + 1, bool)
    starts[1:n] = k[1:] != k[:-1]
    starts |= at_first
    space = k == _SPACE
    # the last character of white space before a word stands alone, or goes to the word if it is U+0020
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~at_first[1:n])
    starts[last] = True
    starts[last[c[last] == 32] + 1] = False
    # contractions begin at an apostrophe that begins a match
    quote = np.flatnonzero((c == 39) & starts[:n])
    if len(quote):
        end = np.append(first, n)[np.searchsorted(first, quote, "right")]
        one = np.where(quote + 1 < end, c[np.minimum(quote + 1, n - 1)], 0)
        two = np.where(quote + 2 < end, c[np.minimum(quote + 2, n - 1)], 0)
        pair = one.astype(np.int64) << 32 | two
        short = np.isin(one, [ord(x) for x in "stmd"])
        long = np.isin(pair, [ord(x) << 32 | ord(y) for x, y in ("re", "ve", "ll")])
        size = np.where(short, 1, np.where(long, 2, 0))
        quote, size = quote[size > 0], size[size > 0]
        starts[quote + 1] = False
        starts[quote + 1 + size] = True
    return np.flatnonzero(starts[:n])


def changed(text: str) -> bool:
    """Whether a text holds a character of a changed class."""
    return bool((_classes()[np.frombuffer(text.encode("utf-32-le"), np.uint32)] == _CHANGED).any())


def cut(text: str) -> Iterator[str]:
    """Parts of a long text of about ``PIECE`` characters; a match never reaches over a word's end into white space."""
    at = 0
    while at < len(text):
        found = re.compile(r"(?<=\S)(?= )").search(text, min(at + PIECE, len(text)))
        to = found.start() if found else len(text)
        yield text[at:to]
        at = to


def by_piece(batch: pa.RecordBatch, column: int, size: int = PIECE) -> Iterator[pa.RecordBatch]:
    """A batch by as many rows as hold about ``size`` bytes of text."""
    at, upto = 0, np.cumsum(pa.compute.binary_length(batch.column(column)).to_numpy(zero_copy_only=False), dtype=np.int64)
    while at < batch.num_rows:
        to = 1 + int(np.searchsorted(upto, size + (upto[at - 1] if at else 0)))
        part = batch.slice(at, to - at)
        yield part
        at += part.num_rows


def split(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray] | None:
    """(UTF-8 of the texts end to end, where its words begin and the last ends, number of the first word of each text
    and of all); None if there is a character of a changed class."""
    joined = "".join(texts)
    c = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    if (_classes()[c] == _CHANGED).any():
        return None
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    at = borders(c, begins[sizes > 0]) if len(c) else np.array([], np.int64)
    firsts = np.searchsorted(at, np.append(begins, len(c)))
    raw = joined.encode()
    if len(raw) == len(c):
        return raw, np.append(at, len(c)), firsts
    width = 1 + (c >= 0x80).astype(np.int8) + (c >= 0x800) + (c >= 0x10000)
    return raw, np.concatenate([[0], np.cumsum(width, dtype=np.int64)])[np.append(at, len(c))], firsts


def distinct(raw: bytes, places: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Words of ``raw`` (``places``: where they begin and the last ends) and for each word the number of its equal among them.

    Words of up to 15 bytes are compared as two integers that hold their bytes and length, in the order of a hash of
    both; longer ones, and now and then equal ones whose hash others share, are listed more than once.
    """
    start, size = places[:-1], np.diff(places)
    eight = np.ndarray(len(raw) + 9, "<u8", raw + bytes(16), strides=(1,))
    mask = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    short = size <= 15
    low = eight[start] & mask[np.minimum(size, 8)]
    high = eight[np.minimum(start + 8, len(raw))] & mask[np.clip(size - 8, 0, 8)] | np.minimum(size, 255).astype(np.uint64) << np.uint64(56)
    order = np.argsort((low ^ high * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93))
    low, high = low[order], high[order]
    new = np.ones(len(order), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1]) | ~short[order[1:]]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    a = start[order[new]]
    return [raw[x:y] for x, y in zip(a.tolist(), (a + size[order[new]]).tolist(), strict=True)], number


def _byte_characters() -> str:
    """The character that stands for each byte in the vocabulary of byte-level files."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(b if b in plain else next(others)) for b in range(256))


class Words(dict):
    """Word (UTF-8) -> its ids as little-endian unsigned 32-bit integers, by the library; two generations."""

    def __init__(self, tokenizer):
        super().__init__()
        self.before, self.model, self.whole = {}, tokenizer.model, tokenizer.encode
        self.characters = dict(enumerate(_byte_characters()))
        # where a word's bytes are all that the model sees of it, the model is asked at once
        pre = tokenizer.pre_tokenizer
        plain = type(pre).__name__ == "ByteLevel" and not pre.add_prefix_space and tokenizer.normalizer is None and tokenizer.post_processor is None
        if not plain or not all(t.special for t in tokenizer.get_added_tokens_decoder().values()):
            self.ids = lambda word: self.whole(word.decode(), add_special_tokens=False).ids

    def ids(self, word: bytes) -> list[int]:
        return [t.id for t in self.model.tokenize(word.decode("latin-1").translate(self.characters))]

    def __missing__(self, word: bytes) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = array("I", self.ids(word)).tobytes()
        if len(self) >= KEPT:
            self.before = dict(self)
            self.clear()
        if len(word) <= 64:
            self[word] = ids
        return ids


class Encoder:
    """Whole texts -> ids as bytes; one for a worker process."""

    def __init__(self, file: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # cores are Spark's to share out
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(file)
        self.tokenizer.encode_special_tokens = True
        self.words = Words(self.tokenizer)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text; about ``PIECE`` characters are in hand at a time."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= PIECE:
                yield from self._group(held)
                held, size = [], 0
        yield from self._group(held)

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        if len(texts) == 1 and len(texts[0]) > 2 * PIECE:
            yield b"".join(ids for part in cut(texts[0]) for ids in self._matches([part]))
        else:
            yield from self._matches(texts)

    def _matches(self, texts: list[str]) -> Iterator[bytes]:
        found = split(texts)
        if found is None:
            touched = [changed(t) for t in texts]
            plain = self._matches([t for t, x in zip(texts, touched, strict=True) if not x])
            yield from (self.whole(t) if x else next(plain) for t, x in zip(texts, touched, strict=True))
            return
        raw, places, firsts = found
        listed, number = distinct(raw, places)
        ids = [self.words[w] for w in listed]
        sizes = np.array([len(x) // 4 for x in ids], np.int64)
        starts = np.cumsum(sizes) - sizes
        n = sizes[number]
        upto = np.concatenate([[0], np.cumsum(n)])
        flat = np.frombuffer(b"".join(ids), "<u4")[np.repeat(starts[number] - upto[:-1], n) + np.arange(upto[-1])]
        for a, b in pairwise(upto[firsts].tolist()):
            yield flat[a:b].tobytes()


_encoders: dict[int, Encoder] = {}


def encoder(file: bytes) -> Encoder:
    """The worker process's encoder for a tokenizer file."""
    key = crc32(file)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(file)
    return _encoders[key]


def _options() -> dict[str, str]:
    """Layout of the files: delta encoding where dictionaries are off, page indexes by default."""
    return {
        "compression": "zstd", "parquet.writer.version": "v2", "parquet.block.size": str(ROW_GROUP), "parquet.page.size": str(PAGE),
        "parquet.page.row.count.limit": str(PAGE_ROWS), "parquet.enable.dictionary": "true",
        "parquet.enable.dictionary#doc_id": "false", "parquet.enable.dictionary#place": "false", "parquet.enable.dictionary#n_tokens": "false",
    }


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = END_ID, keep: list[str] | None = None) -> None:
    """Write the ids of ``docs`` (doc_id, text and the columns of ``keep``) to ``folder``."""
    spark = docs.sparkSession
    text_batches(spark)
    with open(tokenizer, "rb") as f:
        file = spark.sparkContext.broadcast(f.read())
    extra = [c for c in (keep or []) if c != "doc_id"]
    named = {c: f"_{c}" if c in COLUMNS else c for c in extra}
    text = F.coalesce(col("text").cast("string"), F.lit(""))
    # rows that repeat id and text may go to several shards
    rows = docs.select(col("doc_id"), *[col(c).alias(f"in_{k}") for k, c in enumerate(extra)], text.alias("in_text"))
    rows = rows.withColumn("tie", F.xxhash64("in_text")).withColumn("row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange("doc_id", "tie", "row").sortWithinPartitions("doc_id", "tie").drop("tie", "row")
    ids = pa.list_(pa.int32())
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
    schema = T.StructType(
        [rows.schema["doc_id"], *[T.StructField(named[c], rows.schema[f"in_{k}"].dataType) for k, c in enumerate(extra)]]
        + [T.StructField("shard", T.IntegerType()), T.StructField("place", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType(), False))]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, place, encode = TaskContext.get().partitionId(), 0, encoder(file.value)
        for batch in batches:
            for part in by_piece(batch, batch.num_columns - 1):
                coded = [x + end for x in encode(part.column(part.num_columns - 1).to_pylist())]
                n = np.array([len(x) // 4 for x in coded], np.int64)
                upto = np.concatenate([[0], np.cumsum(n)])
                lists = pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(np.frombuffer(b"".join(coded), np.int32)))
                yield pa.RecordBatch.from_arrays(
                    part.columns[:-1] + [pa.array(np.full(len(n), shard, np.int32)), pa.array(place + upto[:-1]), pa.array(n), lists.cast(arrow.field("ids").type)], schema=arrow
                )
                place += int(upto[-1])

    rows.mapInArrow(run, schema).write.options(**_options()).parquet(folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, base, total): ids before each shard and in it. Reads two columns; the window has a row a shard."""
    totals = spark.read.parquet(folder).groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    return totals.select("shard", (F.sum("total").over(before) - F.col("total")).alias("base"), "total")


def documents(spark: SparkSession, folder: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """The rows of ``folder`` with their start, ids from ``low`` to ``high`` of doc_id if given."""
    rows = spark.read.parquet(folder)
    if low is not None:
        rows = rows.where(F.col("doc_id") >= low)
    if high is not None:
        rows = rows.where(F.col("doc_id") <= high)
    bases = manifest(spark, folder).select("shard", "base")
    return rows.join(F.broadcast(bases), "shard").withColumn("start", F.col("base") + F.col("place")).drop("base")


def span(spark: SparkSession, folder: str, begin: int, end: int) -> DataFrame:
    """(doc_id, start, ids) of what lies between two places of the whole sequence, cut at both.

    The manifest names the shards; a shard's own borders reach the scan as filters on shard and place.
    """
    rows = spark.read.parquet(folder)
    within = (F.col("base") < end) & (F.col("base") + F.col("total") > begin)
    wanted = F.lit(False)
    for r in manifest(spark, folder).where(within).toLocalIterator():
        wanted = wanted | ((F.col("shard") == r["shard"]) & (F.col("place") < end - r["base"]) & (F.col("place") + F.col("n_tokens") > begin - r["base"]))
    bases = manifest(spark, folder).where(within).select("shard", "base")
    start = F.col("base") + F.col("place")
    cut = F.greatest(F.lit(begin), start)
    size = F.least(F.lit(end), start + F.col("n_tokens")) - cut
    found = rows.where(wanted).join(F.broadcast(bases), "shard")
    return found.select("doc_id", cut.alias("start"), F.slice("ids", (cut - start + 1).cast("int"), size.cast("int")).alias("ids"))


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    text_batches(rows.sparkSession)
    source = rows.select("doc_id", "start", "n_tokens", "ids")
    schema = T.StructType([*source.schema.fields[:3], T.StructField("ids_crc32", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            flat, at = memoryview(ids.values.to_numpy(zero_copy_only=False).astype("<u4")).cast("B"), ids.offsets.to_numpy() * 4
            crcs = pa.array([crc32(flat[a:b]) for a, b in pairwise(at.tolist())], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], crcs], schema=arrow)

    return source.mapInArrow(run, schema)


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Files of ``docs`` written to the shared folder, and the digests of what is read from them."""
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/tokens/{uuid.uuid4().hex}"
    write(docs, folder, tokenizer, end_id)
    return digests(documents(spark, folder))


def layout(path: str) -> list[dict]:
    """What a local file's footer says of each column of each row group (for reports and tests)."""
    meta = pa.parquet.read_metadata(path)
    groups = [meta.row_group(g) for g in range(meta.num_row_groups)]
    return [
        {"group": g, "rows": group.num_rows, "column": c.path_in_schema, "encodings": c.encodings, "indexed": c.has_offset_index and c.has_column_index}
        for g, group in enumerate(groups) for c in map(group.column, range(group.num_columns))
    ]
