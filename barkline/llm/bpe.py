"""Byte-level BPE encoding and decoding with a public rank file.

Texts are split by the pattern, and each distinct word is encoded by Spark's higher-order functions:
a fold over the word's bytes merges the pair of least rank (the leftmost at a tie) until none has a
rank. Ranks are a map of pairs of ids: a perfect hash table in two arrays, so that a look-up costs the
same for any pair. The arrays are columns of a table of one row, which is broadcast to the rows that hold words:
as literals they would be in each plan, and in each description of it that the driver keeps. No step shuffles texts:

1. A task numbers the words of its texts and emits a row for about ``CHUNK`` characters or ``FRESH``
   bytes of new words: the carried columns, each text's word numbers and the bytes of the words that the
   task has not met before. Rows are small, as an executor holds several copies of one. Texts are split at the borders of the byte-level pattern by array
   operations, and a task looks each distinct word of about ``PIECE`` characters up once. Texts with characters
   of changed classes are cut where a space follows a word, and what lies between two cuts is split by the pattern
   once a task, within ``CUTS`` pieces.
2. The fold encodes the row's new words.
3. A task remembers the ids of the words that its rows brought, puts the ids of each text together and
   concatenates the ids' binary pieces. Both sides forget all words once ``KEPT`` are known, before the same
   row, so memory is bounded whatever the number of distinct words.

So that frequent words are not folded anew in each task, the fold first encodes a dictionary of at
most ``HEAD_WORDS`` words from a sample of about ``HEAD_CHARS`` characters; it is broadcast within
that bound. It saves work only: other words take the same fold in their task. A word that is a
token as a whole is that token. Words of more than ``LONG`` bytes (none in prose) are merged with a
heap, with the same result, as the fold's cost grows with the square of the length.

A text that is longer than a chunk is a chunk of its own. Edge cases: a null text is empty: no ids, empty
decoded bytes; repeated rows are encoded each; extra columns are carried, except ones named like an
output; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import re
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import SEED, col, drop, give_back, staged, staging, text_batches
from .tokenfiles import PIECE, by_piece, changed, cut, distinct, split

CHUNK = 400_000
FRESH = 60_000
KEPT = 300_000
#: Pieces of texts whose words a task remembers, and characters of such a piece at most.
CUTS, CUT = 300_000, 64
HEAD_CHARS = 80_000_000
HEAD_WORDS = 300_000
#: Files of the dictionary's words; their number is bounded, so this is too.
HEAD_PARTS = 64
LONG = 192

#: The pattern of byte-level BPE, whose matches hold a space of U+0020 in front or among white space only.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Bits of an id in a packed pair, and sizes of the hash table (powers of two).
ID_BITS = 20
SLOTS = 1 << 18
GROUPS = 1 << 15
_NONE = 1 << ID_BITS

OUTPUTS = ["n_tokens", "ids", "ids_sha256", "decoded", "decoded_sha256"]


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a rank file (base64 and rank a line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class RankMap:
    """The ranks of pairs of ids as columns (``TABLE``) that stand beside the words of a row.

    A pair is the number a * 2^ID_BITS + b. A slot holds (a + 1, b + 1, rank) packed; exclusive or with
    the pair asked for leaves the rank if it is that pair, and more than ID_BITS bits otherwise.
    """

    #: Multipliers of the two hashes of a pair; of a size that products stay below 2^63.
    A, C = 0x3779B9, 0x2BCA6B

    def __init__(self, ranks: dict[bytes, int]):
        if sorted(ranks.values()) != list(range(len(ranks))) or any(bytes([b]) not in ranks for b in range(256)) or len(ranks) >= _NONE - 1:
            raise ValueError("ranks must be 0, 1, ... and hold every single byte")
        pairs = {}
        for token, r in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[a, b] = r
        slots, shifts = self.table(pairs)
        single = [ranks[bytes([b])] for b in range(256)]
        first = [pairs.get((single[a], single[b])) for a in range(256) for b in range(256)]
        del pairs
        first = np.array([_NONE if r is None else r for r in first], np.int64)
        arrays = [slots, shifts.astype(np.int32), np.array(single, np.int64), first]
        #: One cell of each column of ``RANK_COLUMNS``.
        self.cells = [pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), pa.array(a)) for a in arrays]
        self.stored: DataFrame | None = None
        self.slots, self.shifts, self.single, self.first = (F.col(f"rank_{c}") for c in ("slots", "shifts", "single", "first"))

    def table(self, pairs: dict[tuple[int, int], int]) -> tuple[np.ndarray, np.ndarray]:
        """(packed slots, displacement of each group); the first multiplier is stepped until groups have no clash."""
        a, b = (np.fromiter((p[i] for p in pairs), np.int64, len(pairs)) for i in (0, 1))
        rank = np.fromiter(pairs.values(), np.int64, len(pairs))
        pair = (a << ID_BITS) + b
        group = (pair * self.C >> 19) & (GROUPS - 1)
        while True:
            base = (pair * self.A >> 22) & (SLOTS - 1)
            if len(np.unique(group * SLOTS + base)) == len(pair):
                break
            self.A += 2
        packed = (a + 1) << 2 * ID_BITS | (b + 1) << ID_BITS | rank
        slots, shifts = np.zeros(SLOTS, np.int64), np.zeros(GROUPS, np.int64)
        sizes = np.bincount(group, minlength=GROUPS)
        by_group, start = np.argsort(group, kind="stable"), np.cumsum(sizes) - sizes
        # large groups first, while there is most room
        for g in np.argsort(-sizes, kind="stable")[: np.count_nonzero(sizes)].tolist():
            own = by_group[start[g] : start[g] + sizes[g]]
            d = 0
            while slots[at := base[own] + d & (SLOTS - 1)].any():
                d += 1
            shifts[g] = d
            slots[at] = packed[own]
        return slots, shifts

    def store(self, spark: SparkSession) -> None:
        """Write the table's one row to the shared folder, once."""
        if self.stored is None:
            self.stored = staged(spark.createDataFrame(pa.Table.from_arrays(self.cells, names=RANK_COLUMNS)), "ranks")
            self.cells = None

    def beside(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the table's columns in front."""
        return F.broadcast(self.stored).crossJoin(rows)

    def rank(self, pair: Column) -> Column:
        """The rank of a pair of ids; _NONE if it has none."""
        group = F.shiftright(pair * _long(self.C), 19).bitwiseAND(_long(GROUPS - 1)).cast("int")
        at = (F.shiftright(pair * _long(self.A), 22) + F.get(self.shifts, group)).bitwiseAND(_long(SLOTS - 1)).cast("int")
        return F.least(F.get(self.slots, at).bitwiseXOR((pair + _long(_NONE + 1)) * _long(_NONE)), _long(_NONE))

    def encode(self, word: Column) -> Column:
        """Ids of a word given as an array of byte values: a fold that merges one pair a step.

        The fold carries one number a part: the rank of the part with the next one, its place in the
        word and its id, so the least number is the leftmost pair of least rank.
        """
        part = lambda rank, place, i: rank * _long(1 << 2 * ID_BITS) + place + i
        id_of, place_of = (lambda x: x.bitwiseAND(_long(_NONE - 1))), (lambda x: x.bitwiseAND(_long((1 << 2 * ID_BITS) - _NONE)))
        pair = lambda a, b: F.coalesce(self.rank(a * _long(_NONE) + b), _long(_NONE))
        start = F.transform(
            word, lambda b, i: part(F.coalesce(F.get(self.first, b * 256 + F.get(word, i + 1)), _long(_NONE)), i * _long(_NONE), F.get(self.single, b))
        )

        def merged(parts: Column, least: Column) -> Column:
            # the least part takes in the next one, which goes; the rank of the part before is renewed too
            m = F.shiftright(least, 2 * ID_BITS)

            def renew(x: Column, i: Column) -> Column:
                mine = x == least
                a, b = F.when(mine, m).otherwise(id_of(x)), F.when(mine, id_of(F.get(parts, i + 2))).otherwise(m)
                beside = mine | (F.get(parts, i + 1) == least)
                return F.when(F.get(parts, i - 1) == least, _long(-1)).when(beside, part(pair(a, b), place_of(x), a)).otherwise(x)

            renewed = F.transform(parts, renew)
            return F.filter(renewed, lambda x: x >= 0)

        def step(parts: Column, _: Column) -> Column:
            least = F.array(F.array_min(parts))  # a lambda over one element names it
            done = lambda x: F.when(x < _long(_NONE << 2 * ID_BITS), merged(parts, x)).otherwise(parts)
            return F.get(F.transform(least, done), F.lit(0))

        fold = F.aggregate(F.sequence(F.lit(2), F.greatest(F.size(word), F.lit(2))), start, step)
        return F.transform(fold, id_of)


#: The columns that hold the rank table.
RANK_COLUMNS = ["rank_slots", "rank_shifts", "rank_single", "rank_first"]


def _long(x: int) -> Column:
    return F.lit(x).cast("bigint")


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a long word: pairs in a heap by (rank, place), parts in a linked list."""
    n = len(word)
    end, nxt, prv = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    live, heap = [True] * n, []

    def offer(i: int) -> None:
        j = nxt[i]
        if j < n and (r := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(heap, (r, i, end[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not live[i] or nxt[i] >= n or end[nxt[i]] != stop:
            continue
        j = nxt[i]
        end[i], nxt[i], live[j] = end[j], nxt[j], False
        if nxt[i] < n:
            prv[nxt[i]] = i
        offer(i)
        if prv[i] >= 0:
            offer(prv[i])
    return [ranks[word[i : end[i]]] for i in range(n) if live[i]]


class Numbered(dict):
    """Word (UTF-8) -> number of a task: tokens, the dictionary, then words as they are met.

    Words met since the last row are listed in ``new``; ``forget`` drops all that the task has met.
    """

    def __init__(self, ranks: dict[bytes, int], head: list[bytes]):
        super().__init__(ranks)
        self.update(zip(head, range(len(ranks), len(ranks) + len(head)), strict=True))
        self.first = self.next = len(ranks) + len(head)
        self.new: list[bytes] = []
        self.fresh = 0

    def __missing__(self, word: bytes | str) -> int:
        if isinstance(word, str):
            return self[word.encode()]
        self.new.append(word)
        self.fresh += len(word)
        self[word] = got = self.next
        self.next += 1
        return got

    def forget(self) -> None:
        while self.next > self.first:
            self.popitem()  # the words met are the last ones
            self.next -= 1


#: White space before a space; where there is none, a text can be cut before each space.
_WIDE = re.compile(r"\s ")
_CUTS = re.compile(r"(?<=\S)(?= )")


class Pieces(dict):
    """What follows a space up to the next cut -> the numbers of its words, as the bytes of 32-bit integers.

    No match of the pattern reaches over a space that follows a word (``cuttable``), so the pieces of a text are
    split alone.
    """

    def __init__(self, split: Callable[[str], list[str]], words: Numbered):
        super().__init__()
        self.split, self.words = split, words

    def plain(self, text: str) -> bytes:
        return array("i", map(self.words.__getitem__, self.split(text))).tobytes()

    def __missing__(self, rest: str) -> bytes:
        got = self.plain(" " + rest)
        if len(rest) <= CUT:
            if len(self) >= CUTS:
                self.clear()
            self[rest] = got
        return got

    def of(self, text: str) -> bytes:
        parts = text.split(" ") if not _WIDE.search(text) else [p[k > 0 :] for k, p in enumerate(_CUTS.split(text))]
        return self.plain(parts[0]) + b"".join(map(self.__getitem__, parts[1:]))


def cuttable(pattern: str) -> bool:
    """Whether texts may be cut before spaces: known of the byte-level pattern alone; others see whole texts."""
    return pattern == BYTE_LEVEL


def numbered(texts: list[str], words: Numbered, pieces: Pieces) -> Iterator[bytes]:
    """The numbers of each text's words, as the bytes of 32-bit integers; for the byte-level pattern."""
    if len(texts) == 1 and len(texts[0]) > 2 * PIECE:
        yield b"".join(code for part in cut(texts[0]) for code in numbered([part], words, pieces))
        return
    found = split(texts)
    if found is None and len(texts) == 1:
        yield pieces.of(texts[0])
    elif found is None:
        odd = [changed(t) for t in texts]
        plain = numbered([t for t, x in zip(texts, odd, strict=True) if not x], words, pieces)
        yield from (pieces.of(t) if x else next(plain) for t, x in zip(texts, odd, strict=True))
    else:
        raw, places, firsts = found
        listed, number = distinct(raw, places)
        code = np.array([words[w] for w in listed], np.int32)[number]
        for a, b in pairwise(firsts.tolist()):
            yield code[a:b].tobytes()


def _put(into: np.ndarray, at: int, new: np.ndarray) -> np.ndarray:
    """``into`` with ``new`` from ``at`` on; another array, with room for more, where it is too short."""
    if at + len(new) > len(into):
        into = np.concatenate([into[:at], np.zeros(len(new) + at // 4, into.dtype)])
    into[at : at + len(new)] = new
    return into


class Ids:
    """Number of a word -> its ids, in flat arrays; ``extend`` adds words in the order of their numbers."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.flat, self.sizes, self.starts = flat, sizes, np.cumsum(sizes) - sizes
        #: Ids and words that are known; what is behind them in the arrays is room.
        self.base = self.used = len(flat), len(sizes)

    def extend(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        ids, words = self.used
        self.flat, self.sizes = _put(self.flat, ids, flat), _put(self.sizes, words, sizes)
        self.starts = _put(self.starts, words, ids + np.cumsum(sizes) - sizes)
        self.used = ids + len(flat), words + len(sizes)

    def forget(self) -> None:
        self.used = self.base

    def of(self, code: np.ndarray) -> np.ndarray:
        n = self.sizes[code]
        return self.flat[np.repeat(self.starts[code] - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def decoded(ids: np.ndarray, tokens: list[bytes]) -> bytes:
    """The binary pieces of ids, concatenated."""
    return b"".join(map(tokens.__getitem__, ids.tolist()))


def _lists(words: list[bytes]) -> pa.Array:
    """array<array<int>> cells: byte values of words."""
    at = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int32)
    values = np.frombuffer(b"".join(words), np.uint8).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, pa.int32()))


def head_words(docs: DataFrame, ranks: dict[bytes, int], table: RankMap, pattern: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The dictionary: the most frequent words of a bounded sample, their ids one after another, and
    the number of ids of each; by the fold."""
    total = docs.agg(F.sum(F.length("in_text"))).first()[0] or 0
    share = min(1.0, HEAD_CHARS / max(total, 1))
    sample = docs.where(F.pmod(F.xxhash64("in_text", F.lit(SEED)), F.lit(1_000_000)) < int(1_000_000 * share)).select("in_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        findall, counts = regex.compile(pattern).findall, Counter()

        def out() -> pa.RecordBatch:
            # a word that a task meets once may be in each of many tasks
            used = [(w, n) for w, n in counts.items() if 1 < len(w) <= LONG and w not in ranks]
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in used], pa.binary()).cast(pa.string()), pa.array([n for _, n in used], pa.int64())], names=["word", "n"])

        for batch in batches:
            for part in by_piece(batch, 0):
                texts = part.column(0).to_pylist()
                found = split(texts) if cuttable(pattern) and (len(texts) > 1 or len(texts[0]) <= 2 * PIECE) else None
                if found is None:
                    for text in texts:
                        counts.update(w.encode() for w in findall(text))
                else:
                    listed, number = distinct(*found[:2])
                    for w, n in zip(listed, np.bincount(number, minlength=len(listed)).tolist(), strict=True):
                        counts[w] += n
                if len(counts) > 500_000:
                    yield out()
                    counts.clear()
        yield out()

    counted = sample.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where("n > 1")
    top = counted.orderBy(F.col("n").desc(), "word").limit(HEAD_WORDS).select("word")
    table.store(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            whole = [pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), x) for x in (pa.array(words, pa.string()), _lists([w.encode() for w in words]))]
            yield pa.RecordBatch.from_arrays(whole, names=["texts", "words"])

    # written first, so that each fold is a task of the words' shuffle and not of the sample
    with staging("head") as folder:
        words = staged(top.repartition(HEAD_PARTS, "word"), "words")
        listed = table.beside(words.mapInArrow(rows, "texts array<string>, words array<array<int>>"))
        coded = listed.select("texts", F.transform("words", lambda w: table.encode(w).cast("array<int>")).alias("ids")).toArrow()
    drop(docs.sparkSession, folder)
    texts, ids = (coded.column(c).combine_chunks().flatten() for c in ("texts", "ids"))
    return texts, ids.flatten().to_numpy(zero_copy_only=False), np.diff(ids.offsets.to_numpy()).astype(np.int64)


def round_trip(docs: DataFrame, rank_path: str, pattern: str, whole: bool = False, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 and decoded_sha256; with ``whole`` also ids and decoded.

    ids are little-endian unsigned 32-bit integers in one binary, as hashed by ids_sha256.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in OUTPUTS]
    ranks = load_ranks(rank_path)
    table = RankMap(ranks)
    named = docs.select(*[col(c).alias(f"in_{i}") for i, c in enumerate(kept)], F.coalesce(F.col("text").cast("string"), F.lit("")).alias("in_text"))
    text_batches(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    head, flat, sizes = head_words(named, ranks, table, pattern)
    # Arrow arrays are pickled as buffers, without an object a word
    tokens = pa.array(sorted(ranks, key=ranks.get), pa.binary())
    coding, decoding = sc.broadcast((tokens, head)), sc.broadcast((tokens, flat, sizes))
    del ranks, head
    give_back()
    carried = [named.schema[f"in_{i}"] for i in range(len(kept))]
    arrow_in = to_arrow_schema(T.StructType(carried))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, head = {t: r for r, t in enumerate(coding.value[0].to_pylist())}, coding.value[1].cast(pa.binary()).to_pylist()
        words = Numbered(ranks, head)
        pieces = Pieces(regex.compile(pattern).findall, words)
        plain = cuttable(pattern)
        sizes, codes, chars, forget = [], [], 0, False
        blob = pa.BufferOutputStream()
        sink = pa.ipc.new_stream(blob, arrow_in)

        def out(rows: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal sizes, codes, chars, blob, sink, forget
            carry(rows)
            new = words.new
            long = {k: merge_long(w, ranks) for k, w in enumerate(new) if len(w) > LONG}
            plain = [b"" if k in long else w for k, w in enumerate(new)]
            sink.close()
            row = [
                pa.array([blob.getvalue().to_pybytes()], pa.binary()), pa.array([np.array(sizes, np.int64).tobytes()], pa.binary()),
                pa.array([b"".join(codes)], pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(plain)], pa.int32()), _lists(plain)), pa.array([json.dumps(list(long.items()))]),
                pa.array([forget]),
            ]
            words.new, words.fresh, forget = [], 0, False
            sizes, codes, chars, blob = [], [], 0, pa.BufferOutputStream()
            sink = pa.ipc.new_stream(blob, arrow_in)
            return pa.RecordBatch.from_arrays(row, names=["carried", "sizes", "codes", "words", "long", "forget"])

        def carry(rows: pa.RecordBatch) -> None:
            sink.write_batch(pa.RecordBatch.from_arrays(rows.columns[: len(kept)], schema=arrow_in))

        for batch in batches:
            for part in by_piece(batch, len(kept)):
                texts, at = part.column(len(kept)).to_pylist(), 0
                for k, code in enumerate(numbered(texts, words, pieces) if plain else map(pieces.plain, texts)):
                    codes.append(code)
                    sizes.append(len(code) // 4)
                    chars += len(texts[k])
                    if chars > CHUNK or words.fresh > FRESH:
                        yield out(part.slice(at, k + 1 - at))
                        at = k + 1
                # between pieces, as the words of all texts of a piece are numbered together
                if words.next - words.first > KEPT:
                    if sizes:
                        yield out(part.slice(at))
                    words.forget()
                    pieces.clear()
                    forget = True
                else:
                    # written at once: a kept column would hold the whole batch's memory
                    carry(part.slice(at))
            pa.default_memory_pool().release_unused()
        if sizes:
            yield out(part.slice(part.num_rows))
        del ranks, head, words, pieces
        give_back()

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if whole:
        fields += [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in carried] + fields)
    arrow_out = to_arrow_schema(schema)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, head_flat, head_sizes = decoding.value
        tokens = tokens.to_pylist()
        known = Ids(np.concatenate([np.arange(len(tokens), dtype=np.int32), head_flat]), np.concatenate([np.ones(len(tokens), np.int64), head_sizes]))
        for batch in batches:
            for k in range(batch.num_rows):
                if batch.column(5)[k].as_py():
                    known.forget()
                coded = batch.column(3)[k].values
                flat, sizes = coded.flatten().to_numpy().astype(np.int32), np.diff(coded.offsets.to_numpy()).astype(np.int64)
                if long := json.loads(batch.column(4)[k].as_py()):
                    parts = np.split(flat, np.cumsum(sizes)[:-1])
                    for i, ids in long:
                        parts[i] = np.array(ids, np.int32)
                    flat, sizes = np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
                known.extend(flat, sizes)
                codes = np.frombuffer(batch.column(2)[k].as_py(), np.int32)
                ends = np.cumsum(np.frombuffer(batch.column(1)[k].as_py(), np.int64))
                out: dict[str, list] = {f.name: [] for f in fields}
                for a, b in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True):
                    ids = known.of(codes[a:b])
                    packed, back = ids.astype("<u4").tobytes(), decoded(ids, tokens)
                    out["n_tokens"].append(len(ids))
                    out["ids_sha256"].append(hashlib.sha256(packed).hexdigest())
                    out["decoded_sha256"].append(hashlib.sha256(back).hexdigest())
                    if whole:
                        out["ids"].append(packed), out["decoded"].append(back)
                left = pa.ipc.open_stream(batch.column(0)[k].as_py()).read_all()
                columns = [left.column(i).combine_chunks() for i in range(len(kept))]
                columns += [pa.array(out[f.name], arrow_out.field(f.name).type) for f in fields]
                yield from pa.Table.from_arrays(columns, schema=arrow_out).to_batches()

    chunks = named.mapInArrow(number, "carried binary, sizes binary, codes binary, words array<array<int>>, long string, forget boolean")
    folded = table.beside(chunks).select("carried", "sizes", "codes", F.transform("words", lambda w: table.encode(w).cast("array<int>")).alias("words"), "long", "forget")
    done = folded.mapInArrow(together, schema)
    return done.select(*[F.col(f"in_{i}").alias(c) for i, c in enumerate(kept)], *[f.name for f in fields])
