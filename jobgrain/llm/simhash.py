"""SimHash near-duplicates by the generalised pigeonhole principle.

Bits that vary together go into one group. Fingerprints that differ in at most ``T`` bits agree, in at least one group,
within that group's own threshold whenever the thresholds of ``m`` groups sum to ``T - m + 1``; a dynamic program over
estimated candidate counts chooses ``m`` and the unequal thresholds. A group with threshold ``t`` is probed from both
sides: one side flips up to ``t // 2`` bits, the other up to ``t - t // 2``, and equal keys meet in an ordinary join that
verifies the distance at once. The estimates choose the cost only; links are complete for any choice.

Copies of a fingerprint are folded before anything is joined. Fingerprints in a group value shared by more than ``HOT``
others (``HOT`` squared is what one task should compare at most for one value) are linked among themselves through all
values up to half the distance away (two such fingerprints are linked exactly if they share one), which is linear in their
number and keeps their connection. They never meet each other in the join: one side of it holds sparse fingerprints only. Connected components take large-star and small-star rounds over written tables.

Defined cases: a null text counts as empty; texts without words have fingerprint zero and are linked like any other; texts
with fewer words than a shingle are one shingle; repeated rows share a fingerprint; a null id never names a component with
another id in it; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from jobgrain.session import materialise

#: Words of a shingle, seed of the hash, differing bits that still link, members above which a group value is hot.
WORDS, SEED, DISTANCE, HOT = 4, 42, 4, 512
_BLOCK = 1 << 16


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64 bits, each set in over half of the shingles' hashes."""
    parts = (text or "").encode().lower().split()  # on bytes: A-Z alone, and exactly the blanks 20 and 09 to 0D
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(words, len(parts))
    first, last = starts[: len(parts) - width + 1].tolist(), ends[width - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(first), _BLOCK):
        pieces = [joined[a:b] for a, b in zip(first[at : at + _BLOCK], last[at : at + _BLOCK])]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), np.uint64, len(pieces))
        counts += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(first), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", *keep: Column | str, words: int = WORDS) -> DataFrame:
    """The kept columns and ``fp``, the fingerprint as a signed 64-bit number."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(value.as_py(), words) for value in batch.column(batch.num_columns - 1)]
            columns = [*batch.columns[:-1], pa.array(values, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "fp"])

    kept = docs.select(*keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return docs.select(*keep, F.col(text)).mapInArrow(hashed, f"{fields}, fp long")


class Group(NamedTuple):
    """Bits of one group as a mask, and how many of them may differ; -1 leaves the group out."""

    mask: int
    bits: tuple[int, ...]
    threshold: int


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Rows, and how often each pair of bits is set together: at most 2,080 sums."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, both = 0, np.zeros((64, 64), np.int64)
        for batch in batches:
            values = batch.column(0).to_numpy()
            bits = np.unpackbits(values.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total, both = total + len(values), both + (bits.T @ bits).astype(np.int64)
        i, j = np.triu_indices(64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*i.tolist(), -1], pa.int32()), pa.array([*j.tolist(), -1], pa.int32()), pa.array([*both[i, j].tolist(), total])],
            ["i", "j", "n"],
        )

    rows = fps.select("fp").mapInArrow(sums, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    total, both = 0, np.zeros((64, 64))
    for row in rows:
        if row["i"] < 0:
            total = row["n"]
        else:
            both[row["i"], row["j"]] = both[row["j"], row["i"]] = row["n"]
    return total, both


def correlated_groups(total: int, both: np.ndarray, count: int) -> list[tuple[int, ...]]:
    """Bits in ``count`` groups of nearly equal size, each grown from a seed by the highest mean correlation."""
    share = np.diag(both) / max(total, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    relation = np.abs(both / max(total, 1) - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(relation, 0)
    left, groups = list(range(64)), []
    for k in range(count):
        size = len(left) // (count - k)
        group = [max(left, key=lambda b: (relation[b, left].sum(), -b))]
        while len(group) < size:
            group.append(max((b for b in left if b not in group), key=lambda b: (relation[b, group].sum(), -b)))
        groups.append(tuple(sorted(group)))
        left = [b for b in left if b not in group]
    return groups


def within(differ: np.ndarray) -> np.ndarray:
    """Chance that at most 0, 1, 2... of independent bits differ."""
    chance = np.ones(1)
    for p in differ:
        chance = np.convolve(chance, [1 - p, p])
    return np.cumsum(chance)


def _keys(bits: int, flips: int) -> int:
    return sum(comb(bits, k) for k in range(flips + 1))


def plan(total: int, both: np.ndarray, distance: int = DISTANCE) -> list[Group]:
    """Groups and thresholds of least estimated cost: rows sent plus candidate pairs."""
    share = np.diag(both) / max(total, 1)
    differ = 2 * share * (1 - share)
    best: tuple[float, list[Group]] | None = None
    for count in range(1, distance + 2):
        groups = correlated_groups(total, both, count)
        spent: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}  # by sum of thresholds + 1
        for bits in groups:
            near, after = within(differ[list(bits)]), {}
            for used, (cost, chosen) in spent.items():
                for t in range(-1, distance - used + 1):
                    rows = 0 if t < 0 else (_keys(len(bits), t // 2) + _keys(len(bits), t - t // 2)) * total
                    price = cost + 4.0 * rows + (0 if t < 0 else near[min(t, len(near) - 1)] * total * total / 2)
                    if used + t + 1 not in after or price < after[used + t + 1][0]:
                        after[used + t + 1] = (price, [*chosen, t])
            spent = after
        cost, chosen = spent[distance + 1]
        if best is None or cost < best[0]:
            best = (cost, [Group(sum(1 << b for b in bits), bits, t) for bits, t in zip(groups, chosen)])
    return best[1]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _flips(bits: tuple[int, ...], most: int) -> list[int]:
    return [_signed(sum(1 << b for b in chosen)) for k in range(most + 1) for chosen in combinations(bits, k)]


def _probes(fps: DataFrame, groups: list[Group], upper: bool) -> DataFrame:
    """``g, key, fp`` and the other columns of every fingerprint on one side of the join."""
    sides = []
    for g, group in enumerate(groups):
        if group.threshold >= 0:
            flips = group.threshold - group.threshold // 2 if upper else group.threshold // 2
            masked = F.col("fp").bitwiseAND(F.lit(_signed(group.mask)))
            values = F.array(*[F.lit(x).cast("bigint") for x in _flips(group.bits, flips)])
            sides.append(fps.select(F.lit(g).alias("g"), masked.alias("part"), F.explode(values).alias("flip"), "*"))
    frame = sides[0]
    for side in sides[1:]:
        frame = frame.unionByName(side)
    return frame.withColumn("key", F.col("part").bitwiseXOR(F.col("flip"))).drop("part", "flip")


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def mark_hot(fps: DataFrame, groups: list[Group], hot: int) -> DataFrame:
    """``fp, dense``: whether a fingerprint lies in a group value with more than ``hot`` members."""
    values = _probes(fps, [g._replace(threshold=0) for g in groups if g.threshold >= 0], False)
    crowded = values.groupBy("g", "key").agg(F.count("*").alias("n")).filter(F.col("n") > hot).select("g", "key")
    dense = values.join(crowded, ["g", "key"]).select("fp").distinct().withColumn("dense", F.lit(True))
    return fps.join(dense, "fp", "left").select("fp", F.coalesce("dense", F.lit(False)).alias("dense"))


def links(fps: DataFrame, groups: list[Group], distance: int = DISTANCE, hot: int = HOT) -> DataFrame:
    """``a, b``: pairs within the distance, so many that they connect whatever all such pairs connect."""
    marked = materialise(mark_hot(fps, groups, hot), "marked")
    sparse, dense = marked.filter(~F.col("dense")).select("fp"), marked.filter("dense").select("fp")
    lower = _probes(sparse, groups, False).select("g", "key", F.col("fp").alias("a"))
    upper = _probes(marked, groups, True).select("g", "key", F.col("fp").alias("b"), "dense")
    # A pair meets whichever of the two is on the lower side.
    near = (_distance(F.col("a"), F.col("b")) <= distance) & (F.col("dense") | (F.col("a") < F.col("b")))
    plain = lower.join(upper, ["g", "key"]).filter(near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    whole = Group((1 << 64) - 1, tuple(range(64)), distance)
    stars = _probes(dense, [whole], False).groupBy("key").agg(F.collect_set("fp").alias("met"))
    hub = F.array_min("met")
    crowd = stars.filter(F.size("met") > 1).select(hub.alias("a"), F.explode("met").alias("b")).filter("a < b")
    return plain.unionByName(crowd).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, root``: the smallest node reachable from every node of ``edges`` (``a, b``)."""
    edges, before = materialise(edges.select("a", "b"), "edges"), None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).filter("a != b").distinct()
        )
        edges = materialise(small, "edges")
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())
        if now == before:
            return edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
        before = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def classes(rows: DataFrame, distance: int = DISTANCE, hot: int = HOT) -> DataFrame:
    """``fp, root`` of every fingerprint of a written table with a column ``fp``."""
    fps = materialise(rows.select("fp").distinct(), "fps")
    groups = plan(*bit_counts(fps), distance)
    roots = components(links(fps, groups, distance, hot))
    return fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    rows = materialise(fingerprints(docs, text, F.col(key).alias("doc_id")), "fingerprints")
    roots = classes(rows, hot=hot)
    first = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    named = first.join(roots, "fp")
    names = materialise(named.groupBy("root").agg(F.min("least").alias("component_id")), "names")  # so that a hot root can be split
    table = named.join(names, "root").select("fp", "component_id")
    return rows.join(table, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """One row of each component, that of the smallest id, with all its columns."""
    numbered = materialise(
        docs.select(
            F.struct(*[docs[c] for c in docs.columns]).alias("doc"), F.monotonically_increasing_id().alias("row"),
            F.col(key).alias("doc_id"), F.col(text).alias("whole"),
        ),
        "numbered",
    )
    rows = materialise(fingerprints(numbered, "whole", "row", "doc_id"), "fingerprints")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row"))
    roots = classes(rows, hot=hot)
    winners = (
        rows.groupBy("fp").agg(best.alias("best")).join(roots, "fp")
        .groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.row").alias("row"))
    )
    dropped = rows.select("row").join(winners, "row", "left_anti")
    return numbered.join(dropped, "row", "left_anti").select("doc.*")
