"""Importance resampling towards a target distribution, over hashed word n-grams.

A document is normalised once: A-Z in lower case, everything that is no word one space. One scan keeps the
running CRC-32 at the end of each word. The CRC of any run of words is that of the prefix up to its end with
the prefix before it cancelled: crc(run) = crc(before + run) ^ shift(crc(before), bytes of run), where a shift
by n bytes is a linear map over GF(2), multiplication by x^8n modulo the polynomial. ``Shift`` keeps that map as
tables by the digits of n, so a batch's n-grams are a few array look-ups, and no n-gram's bytes are read again.

Buckets are counted over all documents and over the target; a bucket's gain is a logarithm of smoothed shares;
a document's weight is the mean gain of its features, and Gumbel noise made from a hash of its id turns the
highest scores into a weighted sample without replacement.

Plan: two scans of the texts in Arrow batches. The first ends in at most ``buckets`` rows a task, summed in
Spark; the sums (``buckets`` numbers) are the one thing that goes through the driver. The second gives a row of
numbers a document, staged as Parquet. The lowest drawn score comes from a count a score. Scores are whole
thousandths of a logarithm and so at most about 200,000 different ones, at any size of the input. Only rows that
can be drawn are dealt out by score and numbered, so nothing is sorted in one task.

Edge cases: a null text has no features, weight 0, and isn't drawn, as texts below ``least_words`` aren't; a
null id is hashed as an empty one and comes last among equal scores; rows that repeat an id stand side by side,
the one of more features first; a very long text is scanned in pieces, each begun with the last words of the one
before; an empty table gives an empty result; an empty target counts as t = T = 0; extra columns are
dropped unless named in ``keep``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import col, slices, staged, text_batches

#: The reflected polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
BUCKETS = 10_000
LONGEST = 2
SALT = 7
LEAST_WORDS = 20
PERCENT = 25
#: Bytes that are scanned at a time.
PIECE = 1 << 20

OUTPUTS = ["n_words", "n_features", "weight", "score", "rank"]

#: Word characters are digits, letters and all beyond ASCII; A-Z become a-z, other bytes spaces.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


class Shift:
    """The CRC of bytes as it counts n bytes later: multiplication by x^8n modulo the polynomial, for arrays of n.

    n is written in digits of base 64. Level l has, for each digit d, the map of a shift by d * 64^l bytes as
    four tables of 256 entries, one a byte of the CRC; levels are made as they are needed.
    """

    DIGIT = 6

    def __init__(self):
        c = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            c = np.where(c & 1, c >> 1 ^ POLYNOMIAL, c >> 1).astype(np.uint32)
        self.byte = c
        identity = np.array([np.arange(256, dtype=np.uint32) << np.uint32(8 * p) for p in range(4)])
        self.levels = [self._level(self.byte[identity & 255] ^ identity >> np.uint32(8))]

    @staticmethod
    def _map(tables: np.ndarray, c: np.ndarray) -> np.ndarray:
        return tables[0][c & 255] ^ tables[1][c >> 8 & 255] ^ tables[2][c >> 16 & 255] ^ tables[3][c >> 24]

    def _level(self, one: np.ndarray) -> np.ndarray:
        """Tables of all digits from those of digit 1."""
        digits = [np.array([np.arange(256, dtype=np.uint32) << np.uint32(8 * p) for p in range(4)])]
        for _ in range(1, 1 << self.DIGIT):
            digits.append(self._map(one, digits[-1]))
        return np.array(digits)

    def __call__(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        level = 0
        while len(n) and n.max() > 0:
            if level == len(self.levels):
                last = self.levels[-1]
                self.levels.append(self._level(self._map(last[1], last[-1])))
            flat, at = self.levels[level].reshape(-1), (n & ((1 << self.DIGIT) - 1)) << 10
            crc = flat[at + (crc & 255)] ^ flat[at + 256 + (crc >> 8 & 255)] ^ flat[at + 512 + (crc >> 16 & 255)] ^ flat[at + 768 + (crc >> 24)]
            n, level = n >> self.DIGIT, level + 1
        return crc

    def after_space(self, crc: np.ndarray) -> np.ndarray:
        """CRCs after one more byte, a space."""
        c = crc ^ np.uint32(0xFFFFFFFF)
        return (self.byte[(c ^ 32) & 255] ^ c >> np.uint32(8)) ^ np.uint32(0xFFFFFFFF)


@lru_cache(1)
def _shift() -> Shift:
    return Shift()


def _scanned(crc: int, word: bytes) -> int:
    return crc32(word, crc32(b" ", crc))


def pieces(text: str | None, overlap: int) -> Iterator[tuple[list[bytes], int]]:
    """(words, number of words seen before) of a text, about ``PIECE`` bytes at a time; each piece but the
    first begins with the last ``overlap`` words of the one before."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_NORMAL)
    last: list[bytes] = []
    at = 0
    while at < len(raw):
        to = raw.find(b" ", at + PIECE) if len(raw) - at > PIECE else -1
        to = len(raw) if to < 0 else to
        words = last + raw[at:to].split()
        if len(words) > len(last):
            yield words, len(last)
        last, at = words[len(words) - overlap :] if overlap and len(words) > overlap else words if overlap else [], to


def ngram_crcs(documents: list[list[bytes]], seen: list[int], longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(crc, place of the document) of every run of 1 to ``longest`` words that ends in a new word.

    ``seen`` is the number of words of each document that were there before. Each document's words are
    scanned once; ``ends`` are the running CRCs behind each word of " word word word".
    """
    shift, sizes = _shift(), np.array([len(d) for d in documents])
    ends = np.array([c for d in documents for c in list(accumulate(d, _scanned, initial=0))[1:]], np.uint32)
    size = np.array([len(w) for d in documents for w in d], np.int64)
    owner = np.repeat(np.arange(len(documents)), sizes)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    new = place >= np.array(seen)[owner]
    begins = shift.after_space(np.where(place > 0, np.roll(ends, 1), 0).astype(np.uint32))
    upto = np.cumsum(size + 1)  # bytes with the space before each word
    crcs, of = [], []
    for n in range(1, longest + 1):
        first = np.flatnonzero(new[n - 1 :] & (place[n - 1 :] >= n - 1))  # first word of each run
        last = first + n - 1
        crcs.append(ends[last] ^ shift(begins[first], upto[last] - upto[first] + size[first]))
        of.append(owner[first])
    return np.concatenate(crcs), np.concatenate(of)


def _batches(texts: list[str | None], longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[int], np.ndarray]]:
    """(crcs, place of each among ``index``, index of texts, new words of each) in groups of about PIECE bytes."""
    words, seen, index, held = [], [], [], 0

    def out():
        crcs, of = ngram_crcs(words, seen, longest)
        return crcs, of, index, np.array([len(w) for w in words]) - np.array(seen)

    for k, text in enumerate(texts):
        for found, before in pieces(text, longest - 1):
            words.append(found), seen.append(before), index.append(k)
            held += sum(map(len, found)) + len(found)
            if held >= PIECE:
                yield out()
                words, seen, index, held = [], [], [], 0
    if words:
        yield out()


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, text: str = "text") -> DataFrame:
    """(bucket, n): features of all texts by bucket; buckets without a feature are left out."""
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch):
                for crcs, *_ in _batches(part.column(0).to_pylist(), longest):
                    total += np.bincount(crcs % np.uint32(buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["bucket", "n"])

    return docs.select(col(text).cast("string").alias("text")).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, text: str = "text") -> np.ndarray:
    """The gain of each bucket; ``buckets`` whole numbers, whatever the size of the tables."""
    spark = docs.sparkSession
    counted = bucket_counts(docs, buckets, longest, text).withColumnRenamed("n", "s").join(
        bucket_counts(target, buckets, longest, text).withColumnRenamed("n", "t"), "bucket", "full"
    )
    every = spark.range(buckets).withColumnRenamed("id", "bucket").join(staged(counted, "counts"), "bucket", "left").fillna(0, ["s", "t"])
    whole = Window.partitionBy()
    real = lambda c: c.cast("double")
    over = real(F.col("t") + 1) * real(F.sum("s").over(whole) + buckets)
    under = real(F.col("s") + 1) * real(F.sum("t").over(whole) + buckets)
    rows = every.select("bucket", F.floor(1000 * F.log(over / under)).cast("bigint").alias("gain")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["gain"]
    return out


def noise(doc_id: Column, salt: int = SALT) -> Column:
    """Gumbel noise in thousandths, made from the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def scored(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, salt: int = SALT, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """doc_id and the columns of ``keep`` with n_words, n_features, weight and score."""
    text_batches(docs.sparkSession)
    kept = [c for c in (keep or []) if c not in ["doc_id", *OUTPUTS]]
    source = docs.select(col("doc_id"), *[col(c).alias(f"in_{i}") for i, c in enumerate(kept)], col(text).cast("string").alias("__text"))
    fields = [T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]
    schema = T.StructType([source.schema[c] for c in source.columns[:-1]] + fields)
    arrow = to_arrow_schema(schema)
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        for batch in batches:
            for part in slices(batch):
                words, features, total = (np.zeros(part.num_rows, np.int64) for _ in range(3))
                for crcs, of, index, fresh in _batches(part.column(part.num_columns - 1).to_pylist(), longest):
                    index = np.array(index)
                    np.add.at(words, index, fresh)
                    np.add.at(features, index, np.bincount(of, minlength=len(index)))
                    # sums of whole numbers below 2^53 are exact
                    got = np.bincount(of, weights=gain[crcs % np.uint32(len(gain))], minlength=len(index))
                    np.add.at(total, index, got.astype(np.int64))
                weight = np.where(features > 0, total // np.maximum(features, 1), 0)
                yield pa.RecordBatch.from_arrays(part.columns[:-1] + [pa.array(x) for x in (words, features, weight)], schema=arrow)

    done = source.mapInArrow(run, schema).withColumn("score", F.col("weight") + noise(F.col("doc_id"), salt))
    return done.withColumnsRenamed({f"in_{i}": c for i, c in enumerate(kept)})


def drawn(rows: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``rows`` (of ``scored``, staged) with their rank among the drawn; null for the others.

    ``above`` has a row a score; scores are so few (see above) that it is sent to all tasks.
    """
    able = F.col("n_words") >= least_words
    counts = rows.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    falling = Window.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.select("score", (F.sum("n").over(falling) - F.col("n")).alias("above"), F.floor(F.sum("n").over(Window.partitionBy()) * percent / 100).alias("quota"))
    above = F.broadcast(counts.where("above < quota"))
    within = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), F.col("n_features").desc(), "weight")
    first = rows.where(able).join(above, "score").withColumn("rank", F.col("above") + F.row_number().over(within))
    first = first.withColumn("rank", F.when(F.col("rank") <= F.col("quota"), F.col("rank")).cast("bigint")).select(*rows.columns, "rank")
    lowest = F.coalesce(above.agg(F.min("score")).scalar(), F.lit((1 << 63) - 1))
    rest = rows.where(~able | (F.col("score") < lowest))
    return first.unionByName(rest.withColumn("rank", F.lit(None).cast("bigint")))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, longest: int = LONGEST,
    salt: int = SALT, keep: list[str] | None = None,
) -> DataFrame:
    """Every document's n_words, n_features, weight, score and rank; rows with a rank are the sample."""
    gain = gains(docs, target, buckets, longest)
    return drawn(staged(scored(docs, gain, longest, salt, keep), "scored"), percent, least_words)


def _alphabet(a: str, z: str) -> str:
    return "".join(map(chr, range(ord(a), ord(z) + 1)))


#: The query in DuckDB's SQL; CRC-32 is a fold over the bytes of each distinct feature.
SQL = rf"""
WITH RECURSIVE step(k, c) AS (
  SELECT range, range::UBIGINT FROM range(256)),
rounds(k, c, r) AS (
  SELECT k, c, 0 FROM step
  UNION ALL SELECT k, CASE WHEN c % 2 = 1 THEN xor(c >> 1, {POLYNOMIAL}::UBIGINT) ELSE c >> 1 END, r + 1 FROM rounds WHERE r < 8),
crc AS (SELECT list(c ORDER BY k) AS t FROM rounds WHERE r = 8),
texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents
  UNION ALL SELECT 'b', item_id, text FROM benchmark),
w AS (
  SELECT side, id, row_number() OVER () AS row, coalesce(list_filter(regexp_split_to_array(
    translate(text, '{_alphabet("A", "Z")}', '{_alphabet("a", "z")}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> ''), []) AS w FROM texts),
f AS (
  SELECT row, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature FROM w),
b AS (
  SELECT feature, (xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, 2 * octet_length(encode(feature)), 2),
      lambda i: ('0x' || substr(hex(encode(feature)), i, 2))::UBIGINT)),
    lambda c, x: xor(c >> 8, t[(xor(c, x) % 256)::BIGINT + 1])), 4294967295::UBIGINT) % {BUCKETS})::BIGINT AS bucket
  FROM (SELECT DISTINCT feature FROM f), crc),
n AS (
  SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM f JOIN w USING (row) JOIN b USING (feature) GROUP BY bucket),
g AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * ((sum(s) OVER ()) + {BUCKETS})::DOUBLE)
    / ((s + 1)::DOUBLE * ((sum(t) OVER ()) + {BUCKETS})::DOUBLE)))::BIGINT AS gain FROM n),
p AS (SELECT row, count(*) AS n, sum(gain)::DOUBLE AS total FROM f JOIN b USING (feature) JOIN g USING (bucket) GROUP BY row),
o AS (
  SELECT id AS doc_id, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_features, coalesce(floor(total / n), 0)::BIGINT AS weight,
    ('0x' || substr(sha256('{SALT}:' || coalesce(CAST(id AS VARCHAR), '')), 1, 8))::BIGINT::DOUBLE AS h
  FROM w LEFT JOIN p USING (row) WHERE side = 'd'),
x AS (SELECT *, weight + floor(-1000::DOUBLE * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM o),
r AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= {LEAST_WORDS} ORDER BY score DESC, doc_id NULLS LAST, n_features DESC, weight) AS r,
    floor(count(*) FILTER (n_words >= {LEAST_WORDS}) OVER () * {PERCENT} / 100) AS quota FROM x)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= {LEAST_WORDS} AND r <= quota THEN r END AS rank FROM r
"""
