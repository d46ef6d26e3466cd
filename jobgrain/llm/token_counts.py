"""Token counts by a two-tier lookup: a broadcast table of frequent pre-tokens, then a cache in each worker.

First pass: every task counts its pre-tokens in a bounded Misra-Gries summary and hands on its most frequent ones; their
sums name the frequent pre-tokens, at most ``TABLE`` of them, whose lengths in tokens are broadcast as one packed table.
Second pass: a text is cut into pre-tokens, each is looked up in the table, then in a bounded cache of the worker, and
only then encoded. No pre-token is shuffled but the bounded summaries, and the table changes speed only, never a count.

Defined cases: a null text counts as empty and has no tokens; special strings in a text are one token each, as the
library has it; texts of any length are counted whole; repeated rows and null ids keep their rows; further columns of the
input are not read.
"""

from __future__ import annotations

import struct
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from jobgrain.llm import pretokens

#: Bounds: rows of the broadcast table, rows that a task hands on, counters in a task, entries of a worker's cache.
TABLE, HANDED_ON, COUNTERS, CACHE = 32_768, 4_096, 131_072, 400_000


def pre_tokens(text: str) -> list[str]:
    """The byte-level pre-tokens of a text without special strings."""
    return (pretokens.BYTE_EXACT if pretokens.UNPLAIN.search(text) else pretokens.BYTE_PLAIN).findall(text)


class Lengths(dict):
    """Tokens of each pre-token: the broadcast table itself, its misses through a bounded cache."""

    _of: dict[str, Lengths] = {}

    def __init__(self, path: str, table: bytes = b""):
        super().__init__(unpack(table))
        model = Tokenizer.from_file(path).model
        self.special = pretokens.special_tokens(path)
        self._misses = pretokens.BoundedCache(lambda x: len(model.tokenize(pretokens.as_symbols(x))), CACHE)

    @classmethod
    def shared(cls, path: str, table: bytes) -> Lengths:
        """One for each worker process and table."""
        key = (path, hash(table))
        if key not in cls._of:
            cls._of.clear()
            cls._of[key] = cls(path, table)
        return cls._of[key]

    def __missing__(self, piece: str) -> int:
        return self._misses[piece]

    def count(self, text: str) -> int:
        return sum(
            1 if part in self.special else sum(map(self.__getitem__, pre_tokens(part)))
            for part in pretokens.split_special(text, self.special)
        )


def pack(lengths: dict[str, int]) -> bytes:
    """Number of entries, sizes in bytes, lengths in tokens, then all keys in one piece."""
    keys = [k.encode() for k in lengths]
    head = struct.pack(f"<I{len(keys)}H{len(keys)}H", len(keys), *map(len, keys), *lengths.values())
    return head + b"".join(keys)


def unpack(table: bytes) -> Iterator[tuple[str, int]]:
    if not table:
        return
    (n,) = struct.unpack_from("<I", table)
    numbers, at = struct.unpack_from(f"<{2 * n}H", table, 4), 4 + 4 * n
    for size, length in zip(numbers[:n], numbers[n:]):
        yield table[at : at + size].decode(), length
        at += size


def shrink(counts: Counter, size: int) -> Counter:
    """Misra-Gries: the next largest count is taken from all, so at most ``size`` stay."""
    least = sorted(counts.values(), reverse=True)[size]
    return Counter({k: v - least for k, v in counts.items() if v > least})


def frequent_pieces(docs: DataFrame, text: str) -> DataFrame:
    """Sums of the tasks' summaries."""

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                counts.update(pre_tokens(value.as_py() or ""))
                if len(counts) > 2 * COUNTERS:
                    counts = shrink(counts, COUNTERS)
        top = [(k, v) for k, v in counts.most_common(HANDED_ON) if len(k) <= 64]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in top], pa.string()), pa.array([v for _, v in top], pa.int64())], ["piece", "n"])

    return docs.select(text).mapInArrow(summaries, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def frequent_lengths(docs: DataFrame, path: str, text: str = "text", size: int = TABLE) -> bytes:
    """The packed table of the most frequent pre-tokens and their lengths: at most ``size`` entries of 64 characters."""
    top = frequent_pieces(docs, text).orderBy(F.desc("n"), "piece").limit(size).collect()
    lengths = Lengths(path)
    return pack({row["piece"]: lengths[row["piece"]] for row in top})


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row."""
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, text))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths.shared(path, table.value)
        for batch in batches:
            tokens = [lengths.count(value.as_py() or "") for value in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.select(F.col(key)).schema[0].dataType.simpleString()
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
    rows = docs.select(F.col(key).alias("doc_id"), size.alias("n_bytes"), F.col(text).alias("text"))
    return rows.mapInArrow(counted, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
