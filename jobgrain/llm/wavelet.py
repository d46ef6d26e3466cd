"""Token ids in wavelet matrix shards.

Documents are encoded, dealt to ranges of ascending id and written as shards of about ``SHARD`` ids, one compressed file
each. A shard keeps its ids as bit planes, most significant first: plane ``k`` holds bit ``k`` of every id in the order
left by a stable split on the bits above, together with its number of zeros and a count of ones before every 512 bits.
Access, counting and occurrence lookup walk the planes with rank and select, without unpacking the shard: ``count_ids``
and ``locate_ids`` ask all shards for given ids. The ranges number one for each ``RANGE`` bytes of text, ``RANGES`` at most;
a task sorts its range on disk and holds one shard at a time.

Defined cases: a null or empty text holds the end id alone; a null id comes first; rows with one id are ordered by their
ids; a document longer than a shard makes a longer shard; an empty table writes no shard and reads back as no rows; further
columns of the input are not read. Ids are integers and the vocabulary is below 65,536.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from jobgrain.llm import pretokens

#: Ids of a shard, bits of an id, bits between two stored ranks, words in a worker's cache.
SHARD, BITS, STEP, CACHE = 1 << 20, 16, 512, 1_000_000
#: Bytes of text of a range of document ids, and most ranges (a broadcast of so many bounds).
RANGE, RANGES = 16 << 20, 8192
#: Occurrences looked up at once.
MANY = 4096
_SHARDS = (
    "part int, shard int, start long, n_tokens long, doc_ids array<long>, lengths array<long>, "
    "zeros array<long>, planes array<binary>, ranks array<binary>"
)


class WaveletMatrix:
    """Bit planes over a sequence of ids."""

    def __init__(self, size: int, zeros: list[int], planes: list[bytes], ranks: list[bytes]):
        self.size, self.zeros, self.planes, self.ranks = size, zeros, planes, ranks

    @classmethod
    def build(cls, ids: np.ndarray, bits: int = BITS) -> WaveletMatrix:
        zeros, planes, ranks, order = [], [], [], ids
        for shift in range(bits - 1, -1, -1):
            bit = (order & order.dtype.type(1 << shift)) != 0
            packed = np.packbits(bit, bitorder="little")
            padded = np.zeros(-(-len(packed) // (STEP // 8)) * (STEP // 8), np.uint8)
            padded[: len(packed)] = packed
            ones = np.bitwise_count(padded.reshape(-1, STEP // 8)).sum(axis=1, dtype=np.uint32)
            planes.append(packed.tobytes())
            ranks.append((np.cumsum(ones, dtype=np.uint32) - ones).astype("<u4").tobytes())
            zeros.append(int(len(bit) - np.count_nonzero(bit)))
            order = np.concatenate((np.compress(~bit, order), np.compress(bit, order)))
        return cls(len(ids), zeros, planes, ranks)

    def _bit(self, level: int, i: int) -> int:
        return self.planes[level][i >> 3] >> (i & 7) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones before position ``i`` of a plane."""
        block = i // STEP
        if block * 4 >= len(self.ranks[level]):
            return self.size - self.zeros[level]
        base = int.from_bytes(self.ranks[level][4 * block : 4 * block + 4], "little")
        part = int.from_bytes(self.planes[level][block * STEP // 8 : (i + 7) // 8], "little")
        return base + (part & ((1 << (i - block * STEP)) - 1)).bit_count()

    def access(self, i: int) -> int:
        """The id at a position."""
        value = 0
        for level in range(len(self.planes)):
            ones, bit = self._ones(level, i), self._bit(level, i)
            value = value << 1 | bit
            i = self.zeros[level] + ones if bit else i - ones
        return value

    def _range(self, symbol: int, end: int) -> tuple[int, int]:
        """Where the occurrences of an id before ``end`` lie below the last plane."""
        start, bits = 0, len(self.planes)
        for level in range(bits):
            a, b = self._ones(level, start), self._ones(level, end)
            if symbol >> (bits - 1 - level) & 1:
                start, end = self.zeros[level] + a, self.zeros[level] + b
            else:
                start, end = start - a, end - b
        return start, end

    def rank(self, symbol: int, end: int) -> int:
        """Occurrences of an id before a position."""
        start, stop = self._range(symbol, end)
        return stop - start

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.size)

    def _find(self, level: int, bit: int, k: int) -> int:
        """Position of the ``k``-th (from 0) zero or one of a plane, by bisection over ranks."""
        low, high = 0, self.size
        while low < high:
            middle = (low + high) // 2
            ones = self._ones(level, middle + 1)
            if (ones if bit else middle + 1 - ones) > k:
                high = middle
            else:
                low = middle + 1
        return low

    def select(self, symbol: int, k: int) -> int:
        """Position of the ``k``-th occurrence (from 0) of an id; -1 when there are fewer."""
        if k < 0 or k >= self.count(symbol):
            return -1
        i, bits = self._range(symbol, self.size)[0] + k, len(self.planes)
        for level in range(bits - 1, -1, -1):
            bit = symbol >> (bits - 1 - level) & 1
            i = self._find(level, bit, i - self.zeros[level] if bit else i)
        return i

    def _find_many(self, level: int, bit: int, k: np.ndarray) -> np.ndarray:
        """Positions of many zeros or ones of a plane: the block by its rank, the place from the bits of the block."""
        before = np.frombuffer(self.ranks[level], "<u4").astype(np.int64)
        if not bit:
            before = np.arange(len(before)) * STEP - before
        block = np.searchsorted(before, k, side="right") - 1
        plane = np.frombuffer(self.planes[level], np.uint8)
        at = block[:, None] * (STEP // 8) + np.arange(STEP // 8)
        held = np.where(at < len(plane), plane[np.minimum(at, len(plane) - 1)], 0).astype(np.uint8)
        bits = np.unpackbits(held, axis=1, bitorder="little")
        seen = np.cumsum(bits == bit, axis=1, dtype=np.int32)
        return block * STEP + (seen <= (k - before[block])[:, None]).sum(axis=1)

    def locate(self, symbol: int) -> Iterator[np.ndarray]:
        """Ascending positions of an id, ``MANY`` at a time."""
        start, stop = self._range(symbol, self.size)
        bits = len(self.planes)
        for first in range(start, stop, MANY):
            i = np.arange(first, min(first + MANY, stop))
            for level in range(bits - 1, -1, -1):
                bit = symbol >> (bits - 1 - level) & 1
                i = self._find_many(level, bit, i - self.zeros[level] if bit else i)
            yield i

    def decode(self) -> np.ndarray:
        """All ids in order: the splits undone from the last plane up."""
        values = np.zeros(self.size, np.uint16)
        for level in range(len(self.planes) - 1, -1, -1):
            bit = np.unpackbits(np.frombuffer(self.planes[level], np.uint8), count=self.size, bitorder="little").view(bool)
            up = np.empty_like(values)
            up[~bit], up[bit] = values[: self.zeros[level]], values[self.zeros[level] :]
            values = up | (bit.astype(np.uint16) << (len(self.planes) - 1 - level))
        return values


class LibraryCodec:
    """Ids by the library's own model, each lower-case word once and then from a bounded cache.

    Parts of a text with other than plain characters or with special strings go to the library whole.
    """

    def __init__(self, path: str):
        self._tokenizer = Tokenizer.from_file(path)
        if self._tokenizer.get_vocab_size() >= 1 << BITS:
            raise ValueError(f"ids need more than {BITS} bits")
        special = sorted(pretokens.special_tokens(path), key=len, reverse=True)
        self._special = re.compile("|".join(map(re.escape, special)) or "(?!)")
        self._words = pretokens.BoundedCache(self._word, CACHE)

    def _word(self, word: str) -> bytes:
        return array("H", [t.id for t in self._tokenizer.model.tokenize(pretokens.as_symbols(word))]).tobytes()

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self._words.__getitem__, pretokens.WORDS_PLAIN.findall(text.lower())))

    def encode(self, text: str) -> bytes:
        """Little-endian ids of two bytes."""
        special = self._special.search(text)
        if not special and not pretokens.UNPLAIN.search(text):
            return self._plain(text)
        if special:
            return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()
        parts = []
        for chunk in pretokens.white_split(text):
            if pretokens.UNPLAIN.search(chunk):
                parts.append(np.array(self._tokenizer.encode(chunk, add_special_tokens=False).ids, "<u2").tobytes())
            else:
                parts.append(self._plain(chunk))
        return b"".join(parts)


@lru_cache(maxsize=2)
def codec(path: str) -> LibraryCodec:
    """One for each worker process."""
    return LibraryCodec(path)


def write_shards(docs: DataFrame, folder: str, path: str, end_id: int, key: str = "doc_id", text: str = "text") -> None:
    """Encode, append ``end_id`` to each document and write shards in ascending order of ``key`` below ``folder``."""
    shares = [i / RANGES for i in range(1, RANGES)]
    size, cuts = docs.agg(F.sum(F.octet_length(text) + 1), F.percentile_approx(key, shares, 10 * RANGES)).first()
    parts = min(RANGES, -(-(size or 1) // RANGE))
    bounds = np.unique(np.array([cuts[i * RANGES // parts - 1] for i in range(1, parts)] if cuts else [], np.int64))
    end = np.array([end_id], "<u2").tobytes()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codec(path).encode
        for batch in batches:
            keys = batch.column(0).cast(pa.int64())
            ids = [encode(value.as_py() or "") + end for value in batch.column(1)]
            part = np.where(keys.is_null(), 0, np.searchsorted(bounds, keys.fill_null(0).to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), keys, pa.array(ids, pa.binary())], ["part", "doc_id", "ids"])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, start, total, held, names, lengths, part = 0, 0, 0, [], [], [], None

        def shard() -> pa.RecordBatch:
            matrix = WaveletMatrix.build(np.frombuffer(b"".join(held), "<u2"))
            row = {
                "part": part, "shard": number, "start": start, "n_tokens": matrix.size, "doc_ids": names, "lengths": lengths,
                "zeros": matrix.zeros, "planes": matrix.planes, "ranks": matrix.ranks,
            }
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for p, name, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
                part = p
                held.append(ids)
                names.append(name)
                lengths.append(len(ids) // 2)
                total += lengths[-1]
                if total >= SHARD:
                    yield shard()
                    number, start, total, held, names, lengths = number + 1, start + total, 0, [], [], []
        if held:
            yield shard()

    schema = pa.schema([
        ("part", pa.int32()), ("shard", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("zeros", pa.list_(pa.int64())),
        ("planes", pa.list_(pa.binary())), ("ranks", pa.list_(pa.binary())),
    ])
    (
        docs.select(F.col(key), F.col(text)).mapInArrow(encoded, "part int, doc_id long, ids binary")
        .repartitionById(parts, F.col("part")).sortWithinPartitions("doc_id", "ids")
        .mapInArrow(shards, _SHARDS)
        .write.option("maxRecordsPerFile", 1).option("compression", "zstd").parquet(folder)
    )


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """The written shards; ``WaveletMatrix(n_tokens, zeros, planes, ranks)`` opens a row."""
    return spark.read.schema(_SHARDS).parquet(folder)


def document_spans(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the ids read back out of the planes."""

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = WaveletMatrix(row["n_tokens"], row["zeros"], row["planes"], row["ranks"]).decode().astype("<u4")
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * len(sums), pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts + row["start"], pa.int64()), pa.array(row["lengths"], pa.int64()), pa.array(sums, pa.int64()),
                    ],
                    ["part", "doc_id", "local", "n_tokens", "ids_crc32"],
                )

    shards = read_shards(spark, folder)
    # One row per range of ids, so at most as many as the partitions written.
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("part", F.coalesce(before, F.lit(0)).alias("offset"))
    rows = shards.mapInArrow(spans, "part int, doc_id long, local long, n_tokens long, ids_crc32 long")
    return rows.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("offset") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def _open(row: dict) -> WaveletMatrix:
    return WaveletMatrix(row["n_tokens"], row["zeros"], row["planes"], row["ranks"])


def count_ids(spark: SparkSession, folder: str, ids: list[int]) -> DataFrame:
    """``id, n``: occurrences of each of the given ids in all shards, by two ranks a shard and plane."""
    wanted = sorted({int(i) for i in ids})

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = dict.fromkeys(wanted, 0)
        for batch in batches:
            for row in batch.to_pylist():
                matrix = _open(row)
                for symbol in wanted:
                    total[symbol] += matrix.count(symbol) if 0 <= symbol < 1 << BITS else 0
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["id", "n"])

    asked = spark.createDataFrame([(i,) for i in wanted], "id long")
    found = read_shards(spark, folder).mapInArrow(counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return asked.join(found, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("n"))


def locate_ids(spark: SparkSession, folder: str, ids: list[int]) -> DataFrame:
    """``id, doc_id, position``: every occurrence of the given ids, counted from 0 in its document, by selects."""
    wanted = sorted({int(i) for i in ids if 0 <= i < 1 << BITS})

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                matrix, names = _open(row), pa.array(row["doc_ids"], pa.int64())
                ends = np.cumsum(row["lengths"])
                for symbol in wanted:
                    for at in matrix.locate(symbol):
                        doc = np.searchsorted(ends, at, side="right")
                        inside = at - (ends[doc] - np.array(row["lengths"])[doc])
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), symbol)), names.take(pa.array(doc)), pa.array(inside)], ["id", "doc_id", "position"])

    return read_shards(spark, folder).mapInArrow(located, "id long, doc_id long, position long")
