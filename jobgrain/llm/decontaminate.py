"""Benchmark passages in documents, by a prefix-filtered set join.

A window is every run of ``WINDOW`` words of an item; an item with fewer words is one window. A window lies in a document
only if all its shingles do, so its rarest shingle over all documents is a necessary prefix: a first pass counts the
shingles of the windows in every document, windows with a shingle that never occurs are out, and a second pass joins
documents with the others on that shingle alone. The place of the shingle fixes where the window would have to start; the
bounds of the document and then all words are checked.

Windows, counts, prefixes and candidates are tables, whatever the size of the benchmark. Tasks learn which shingles matter
from an array of bits of at most ``1 << MOST_BITS`` bits, the only thing that passes the driver: it loses no shingle, and
strangers that pass it find no partner in the join. Places are joined, not documents: a place carries the words that a window
around it can reach. Equal texts have equal results, so these go by the digest of the text.

Defined cases: a null or empty text has no words and is never contaminated; items without words have no window; items
under one id count as one item; a null item id stands as the empty string; repeated rows and null ids keep their rows; an
empty benchmark contaminates nothing; further columns are not read by ``find_passages`` and kept by ``drop_contaminated``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from jobgrain.session import materialise

#: Words of a window and of a shingle, windows handed on at once, bytes read at once.
WINDOW, SHINGLE, BLOCK, SLAB = 13, 3, 20_000, 1 << 18
#: Bits for each key of the array of bits, and the most bits as a power of two: 32 MB.
BITS_PER_KEY, MOST_BITS = 32, 28
#: Shingles a task holds before it counts them, places it holds before it hands them on.
FOLD, PLACES = 1 << 20, 10_000
#: Fixed value: what a word is, once A-Z are in lower case: digits, letters and whatever lies above ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_LETTER = np.zeros(256, np.int8)
for _range in (range(ord("0"), ord("9") + 1), range(ord("a"), ord("z") + 1), range(0x80, 0x100)):
    _LETTER[_range] = 1
_POWERS: list[np.ndarray] = []


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    if not _POWERS or len(_POWERS[0]) < size:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _POWERS[:] = [np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, x)))) for x in (_BASE, inverse)]
    return _POWERS[0], _POWERS[1]


def _slab_codes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each word of some bytes in lower case, equal for equal words, and where the words start and end."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _LETTER[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    power, inverse = _powers(max(len(data), SLAB) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * power[: len(data)], out=sums[1:])
    codes = (sums[ends] - sums[starts]) * inverse[starts]
    codes ^= codes >> np.uint64(31)
    codes *= _MIX
    return codes, starts, ends


def word_codes(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Numbers, starts and ends of all words and the bytes they lie in; long texts are read in slabs that cut no word."""
    data = (text or "").encode().lower()
    array, at, parts = np.frombuffer(data, np.uint8), 0, []
    while at < len(array):
        end = min(at + SLAB, len(array))
        if end < len(array):
            gaps = np.flatnonzero(_LETTER[array[at:end]] == 0)
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:  # one word beyond the slab
                following = WORD.match(data, at)
                end = following.end()
        codes, starts, ends = _slab_codes(array[at:end])
        parts.append((codes, starts + at, ends + at))
        at = end
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), data
    return *(np.concatenate(x) for x in zip(*parts)), data


def _mixed(code: np.ndarray, word: np.ndarray) -> np.ndarray:
    code = (code + word) * _MIX
    return code ^ code >> np.uint64(29)


def shingles(codes: np.ndarray, size: int) -> np.ndarray:
    """Numbers of all runs of ``size`` words, by where they start. Equal runs have equal numbers."""
    n = max(len(codes) - size + 1, 0)
    code = np.full(n, size, np.uint64)
    for k in range(size):
        code = _mixed(code, codes[k : k + n])
    return code


class Bits:
    """A set of shingles in an array of bits: "no" is sure."""

    _FACTORS = [np.uint64(x) for x in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)]

    def __init__(self, power: int):
        self._shift = np.uint64(64 - power)
        self.words = np.zeros(1 << power - 6, np.uint64)

    def _places(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for factor in self._FACTORS:
            place = codes * factor >> self._shift
            yield place >> np.uint64(6), place & np.uint64(63)

    def add(self, codes: np.ndarray) -> None:
        for word, bit in self._places(codes):
            np.bitwise_or.at(self.words, word, np.uint64(1) << bit)

    def held(self, codes: np.ndarray) -> np.ndarray:
        """Indices of the shingles that may be in the set."""
        at = np.arange(len(codes))
        for factor in self._FACTORS:
            place = codes[at] * factor >> self._shift
            at = at[self.words[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1) == 1]
        return at


def bits_of(codes: DataFrame, count: int) -> Bits:
    """The set of the numbers in column ``code``. Tasks fill arrays, which are or-ed word by word."""
    power = int(np.clip(int(count * BITS_PER_KEY).bit_length(), 16, MOST_BITS))

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Bits(power)
        for batch in batches:
            own.add(batch.column(0).to_numpy().view(np.uint64))
        some = np.flatnonzero(own.words)
        for at in range(0, len(some), FOLD):
            word = some[at : at + FOLD]
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.int64()), pa.array(own.words[word].view(np.int64))], ["word", "bits"])

    words = codes.select("code").mapInArrow(filled, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = Bits(power)
    bits.words[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return bits


def windows_of(benchmark: DataFrame, key: str = "item_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """``item, win, n, codes`` of every window: its words joined by spaces, their number, its shingles in order."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                codes, starts, ends, data = word_codes(value.as_py())
                length = min(WINDOW, len(codes))
                if not length:
                    continue
                size = min(SHINGLE, length)
                runs, many = shingles(codes, size).view(np.int64), length - size + 1
                for at in range(0, len(codes) - length + 1, block):
                    last = min(at + block, len(codes) - length + 1)
                    words = [data[a:b].decode() for a, b in zip(starts[at : last + length - 1], ends[at : last + length - 1])]
                    held = np.lib.stride_tricks.sliding_window_view(runs[at : last + many - 1], many)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([item] * (last - at), pa.string()),
                            pa.array([" ".join(words[k : k + length]) for k in range(last - at)], pa.string()),
                            pa.array(np.full(last - at, length, np.int32)),
                            pa.ListArray.from_arrays(np.arange(0, held.size + 1, many, dtype=np.int32), pa.array(held.ravel())),
                        ],
                        ["item", "win", "n", "codes"],
                    )

    items = benchmark.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    return items.mapInArrow(cut, "item string, win string, n int, codes array<long>")


def shingle_counts(texts: DataFrame, wanted: Bits, sizes: list[int]) -> DataFrame:
    """``code, often``: occurrences in all texts of the shingles that may be wanted."""
    shared = texts.sparkSession.sparkContext.broadcast(wanted)

    def folded(held: list[np.ndarray]) -> pa.RecordBatch:
        codes, often = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(often.astype(np.int64))], ["code", "often"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, held, size = shared.value, [], 0
        for batch in batches:
            for value in batch.column(0):
                codes = word_codes(value.as_py())[0]
                for run in sizes:
                    code = shingles(codes, run)
                    held.append(code[wanted.held(code)])
                    size += len(held[-1])
                if size >= FOLD or len(held) >= FOLD:
                    yield folded(held)
                    held, size = [], 0
        yield folded(held)

    return texts.select("text").mapInArrow(counted, "code long, often long").groupBy("code").agg(F.sum("often").alias("often"))


def prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """``wid, win, n, code, at``: each window whose shingles all occur, with its rarest one and where in the window that is."""
    places = windows.select("win", "n", F.posexplode("codes").alias("at", "code")).join(counts, "code", "left")
    rank = F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "at", "code")).alias("r")
    rarest = places.groupBy("win").agg(F.first("n").alias("n"), rank).filter("r.often > 0")
    return rarest.select(F.monotonically_increasing_id().alias("wid"), "win", "n", "r.code", "r.at")


def read_places(texts: DataFrame, wanted: Bits, sizes: list[int]) -> DataFrame:
    """A row with ``n_words`` for each text and one with ``code, place, first, words`` for each place of a shingle that may be wanted.

    ``words`` are those a window around the place can reach, from the word ``first`` on.
    """
    shared = texts.sparkSession.sparkContext.broadcast(wanted)
    names = [c for c in texts.columns if c != "text"]

    def batch_of(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
        own, *rest = zip(*rows)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()))
        arrays = [pa.array(values, t) for values, t in zip(rest, types)]
        kept = batch.select(names).take(pa.array(own, pa.int64()))
        return pa.RecordBatch.from_arrays([*kept.columns, *arrays], [*names, "n_words", "code", "place", "first", "words"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            rows = []
            for own, value in enumerate(batch.column("text")):
                codes, starts, ends, data = word_codes(value.as_py())
                n = len(codes)
                rows.append((own, n, None, None, None, None))
                for size in sizes:
                    reach = WINDOW - SHINGLE if size == SHINGLE else 0  # a shorter run is a window of its own
                    runs = shingles(codes, size)
                    places = wanted.held(runs)
                    for place, code in zip(places.tolist(), runs[places].view(np.int64).tolist()):
                        first, last = max(place - reach, 0), min(place + size + reach, n)
                        words = [data[a:b].decode() for a, b in zip(starts[first:last], ends[first:last])]
                        rows.append((own, n, code, place, first, words))
                        if len(rows) >= PLACES:
                            yield batch_of(batch, rows)
                            rows = []
            if rows:
                yield batch_of(batch, rows)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.select(*names).schema)
    return texts.mapInArrow(read, f"{fields}, n_words long, code long, place long, first long, words array<string>")


def _digest(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def _covered(spans: str) -> Column:
    """Words inside at least one of the spans ``(a, b)``."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end"))

    def step(state: Column, span: Column) -> Column:
        new = F.greatest(span["b"] - F.greatest(span["a"], state["end"]), F.lit(0).cast("bigint"))
        return F.struct((state["n"] + new).alias("n"), F.greatest(state["end"], span["b"]).alias("end"))

    return F.aggregate(F.array_sort(spans), zero, step, lambda state: state["n"])


def _search(texts: DataFrame, benchmark: DataFrame, item_key: str, item_text: str, block: int) -> tuple[DataFrame, DataFrame]:
    """The texts without ``text`` and with ``n_words``; ``digest, n_words, n_hit, items`` of the texts that hold a window."""
    pieces = materialise(windows_of(benchmark, item_key, item_text, block), "windows")
    windows = pieces.groupBy("win").agg(F.first("n").alias("n"), F.first("codes").alias("codes"))
    held = pieces.agg(F.collect_set(F.least("n", F.lit(SHINGLE))).alias("sizes"), F.sum(F.size("codes")).alias("codes")).first()
    sizes = sorted(held["sizes"])

    wanted = bits_of(pieces.select(F.explode("codes").alias("code")), held["codes"] or 0)
    index = materialise(prefixes(windows, shingle_counts(texts, wanted, sizes)), "prefixes")
    chosen = bits_of(index, index.count())
    read = materialise(read_places(texts, chosen, sizes), "places")

    start = F.col("place") - F.col("at")
    own = F.slice("words", (start - F.col("first") + 1).cast("int"), F.col("n"))
    fits = (start >= 0) & (start + F.col("n") <= F.col("n_words"))
    true = F.when(fits, F.array_join(own, " ") == F.col("win"))
    hits = read.filter("code is not null").select("digest", "n_words", "code", "place", "first", "words").join(index, "code").filter(true)
    spans = F.collect_set(F.struct(start.alias("a"), (start + F.col("n")).alias("b")))
    of_text = hits.groupBy("digest").agg(F.first("n_words").alias("n_words"), spans.alias("spans"), F.collect_set("wid").alias("wids"))
    of_text = of_text.select("digest", "n_words", _covered("spans").alias("n_hit"), F.explode("wids").alias("wid"))
    owners = pieces.select("item", "win").distinct().join(index.select("win", "wid"), "win").select("wid", "item")
    found = of_text.join(owners, "wid").groupBy("digest").agg(
        F.first("n_words").alias("n_words"), F.first("n_hit").alias("n_hit"), F.sort_array(F.collect_set("item")).alias("items")
    )
    return read.filter("code is null").drop("code", "place", "first", "words"), found


def _contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def find_passages(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", block: int = BLOCK,
) -> DataFrame:
    """``doc_id, n_words, n_hit, items, contaminated`` of every row; ``items`` is sorted."""
    texts = docs.select(F.col(key).alias("doc_id"), _digest(text).alias("digest"), F.col(text).alias("text"))
    rows, found = _search(texts, benchmark, item_key, item_text, block)
    n_hit, items = F.coalesce("n_hit", F.lit(0).cast("bigint")), F.coalesce("items", F.array().cast("array<string>"))
    judged = rows.join(found.drop("n_words"), "digest", "left").select("doc_id", "n_words", n_hit.alias("n_hit"), items.alias("items"))
    return judged.withColumn("contaminated", _contaminated())


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", block: int = BLOCK
) -> DataFrame:
    """The rows that are not contaminated, with all their columns."""
    _, found = _search(docs.select(_digest(text).alias("digest"), F.col(text).alias("text")), benchmark, item_key, item_text, block)
    bad = materialise(found.filter(_contaminated()).select("digest"), "contaminated")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), _digest(text).alias("digest"))
    return rows.join(bad, "digest", "left_anti").select("doc.*")
