"""Ranked lexical search by MaxScore with pair bounds.

Every item of a query table ranks all documents by whole-number impacts of the terms they share with it. Passes:

1. The documents become a written forward table: number of terms, and the query terms with their occurrences.
2. Its sums give the number of documents, all terms, and the documents of each query term, and with them the weights.
3. Each task cuts its rows into shards of about ``POSTINGS`` postings and writes one row per shard: inverted lists of
   impacts in document order, the greatest impact of each list, and for every pair of terms that stand together among the
   ``PAIRED`` most frequent terms of some item the greatest sum of impacts that one document reaches by these two lists.
4. Each task searches its shards one after the other and carries an item's best documents on, so later shards start with
   a high bar. Lists are added from the greatest impact down. What the remaining lists can still add is bounded by
   disjoint pairs, those that save most against the sum of their two maxima first, and single maxima for the rest. Once
   that bound is below the bar, unseen documents are skipped, and only documents that can still reach the bar are looked
   up in the remaining lists. Bounds only skip: ties with the bar are kept, so results are those of a full evaluation.
5. Two windows with group limits keep the best of all tasks.

Items are dealt with in blocks whose terms take at most ``VOCABULARY`` bytes; nothing else is broadcast.

Defined cases: a null text has no terms; items without terms, or whose terms no document holds, give no rows; equal items
and repeated ids are searched each for themselves; of equal scores the smaller document id comes first, a null id last;
repeated documents are ranked each for itself; empty tables give an empty result; other columns are ignored. Document ids are whole numbers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window, functions as F

from jobgrain.session import materialise

#: Results per item, postings of a shard, terms of an item whose pairs have lists, bytes of the terms of a block of items.
TOP, POSTINGS, PAIRED, VOCABULARY = 50, 1 << 20, 8, 32 << 20

#: Bytes of terms stay, A-Z as a-z; all others part terms. Bytes of characters above 7F belong to terms.
_TERMS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)
_INDEX = pa.schema([
    ("ids", pa.list_(pa.int64())), ("terms", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())),
    ("docs", pa.list_(pa.int32())), ("impacts", pa.list_(pa.int64())), ("greatest", pa.list_(pa.int64())),
    ("left", pa.list_(pa.int32())), ("right", pa.list_(pa.int32())), ("joint", pa.list_(pa.int64())),
])
_INDEX_SPARK = "ids array<long>, terms array<int>, ends array<int>, docs array<int>, impacts array<long>, greatest array<long>, `left` array<int>, `right` array<int>, joint array<long>"


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TERMS).split()


def _item_terms(items: DataFrame) -> DataFrame:
    """``q, term`` of every distinct term of every item."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(q, term) for q, text in zip(batch.column(0).to_pylist(), batch.column(1)) for term in sorted(set(terms_of(text.as_py())))]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.binary())], ["q", "term"])

    return items.select("q", "text").mapInArrow(split, "q long, term binary")


def forward_table(docs: DataFrame, key: str, text: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs``: all terms counted, those of the vocabulary kept with their occurrences."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = known.value
        for batch in batches:
            n, terms, tfs, ends = [], [], [], [0]
            for value in batch.column(1):
                found = terms_of(value.as_py())
                n.append(len(found))
                for term, tf in Counter(found).items():
                    if term in numbers:
                        terms.append(numbers[term])
                        tfs.append(tf)
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, tfs)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(counted, "doc_id long, n long, terms array<int>, tfs array<int>")


class Lists(NamedTuple):
    """A shard: documents in ascending order of id, nulls last; list ``k`` lies between ``ends[k]`` and ``ends[k + 1]``."""

    ids: pa.Array
    terms: np.ndarray
    ends: np.ndarray
    docs: np.ndarray
    impacts: np.ndarray
    greatest: np.ndarray
    joint: dict[tuple[int, int], int]


def invert(ids: pa.Array, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, weights: np.ndarray, total: tuple[int, int], pairs: np.ndarray) -> Lists:
    """The lists of a shard from its forward rows. ``pairs`` are sorted by their first term."""
    order = pa.compute.sort_indices(ids, null_placement="at_end").to_numpy().astype(np.int64)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    doc = np.repeat(np.arange(len(order)), sizes)
    documents, length = total
    if int(n.max(initial=0)) * 50 * documents < 1 << 62:
        m = 50 + n * 50 * documents // length
    else:
        m = np.array([50 + 50 * int(x) * documents // length for x in n], np.int64)
    tf = tfs.astype(np.int64)
    impact = weights[terms] * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc]))
    by = np.lexsort((place[doc], terms))
    docs, impacts = place[doc][by].astype(np.int32), impact[by]
    held, starts = np.unique(terms[by], return_index=True)
    ends = np.append(starts, len(by))
    greatest = np.maximum.reduceat(impacts, starts) if len(by) else np.empty(0, np.int64)
    where = np.full(len(weights), -1)
    where[held] = np.arange(len(held))
    joint, reach, last = {}, np.zeros(len(order), np.int64), -1
    for a, b in pairs.tolist():
        i, j = where[a], where[b]
        if i < 0 or j < 0:
            continue
        if a != last:
            reach[:] = 0
            reach[docs[ends[i] : ends[i + 1]]] = impacts[ends[i] : ends[i + 1]]
            last = a
        there = slice(ends[j], ends[j + 1])
        joint[a, b] = max(int(greatest[i]), int((reach[docs[there]] + impacts[there]).max()))
    return Lists(ids.take(pa.array(order)), held, ends, docs, impacts, greatest, joint)


def remaining(terms: list[int], greatest: list[int], joint: dict[tuple[int, int], int]) -> list[int]:
    """What the terms from each place on can add to one document at most; ``joint`` holds the pairs to use.

    Pairs are disjoint, the most saving first. Where only the later term of a pair remains, it counts alone.
    """
    at = {t: k for k, t in enumerate(terms)}
    saving = []
    for a, b in combinations(sorted(terms), 2) if joint else []:
        if (a, b) in joint:
            i, j = sorted((at[a], at[b]))
            saved = greatest[i] + greatest[j] - joint[a, b]
            if saved > 0:
                saving.append((-saved, i, j, joint[a, b]))
    adds = list(greatest)
    used: set[int] = set()
    for _, i, j, both in sorted(saving):
        if i not in used and j not in used:
            used |= {i, j}
            adds[i] = both - greatest[j]
    bound, out = 0, [0]
    for add in reversed(adds):
        bound += add
        out.append(bound)
    return out[::-1]


def best_of(lists: Lists, terms: list[int], top: int = TOP, bar: int = 1, paired: bool = True) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents of the shard that may be among the best and reach the bar, their scores, and postings read or looked up."""
    places = np.searchsorted(lists.terms, terms)
    there = [(int(lists.greatest[p]), t, p) for t, p in zip(terms, places.tolist()) if p < len(lists.terms) and lists.terms[p] == t]
    there.sort(key=lambda x: (-x[0], x[1]))
    greatest = [g for g, _, _ in there]
    bounds = remaining([t for _, t, _ in there], greatest, lists.joint if paired else {})
    score, read, k = np.zeros(len(lists.ids), np.int64), 0, 0
    most = 0
    while k < len(there) and bounds[k] >= bar:
        part = slice(lists.ends[there[k][2]], lists.ends[there[k][2] + 1])
        docs = lists.docs[part]
        score[docs] += lists.impacts[part]
        read, k = read + len(docs), k + 1
        most = max(most, int(score[docs].max()))
        if top <= len(score) and bounds[k] <= most:
            bar = max(bar, int(np.partition(score, -top)[-top]))
    docs = np.flatnonzero(score >= max(bar - bounds[k], 1))
    found = score[docs]
    for k in range(k, len(there)):
        part = slice(lists.ends[there[k][2]], lists.ends[there[k][2] + 1])
        at = np.minimum(np.searchsorted(lists.docs[part], docs), part.stop - part.start - 1)
        found = found + np.where(lists.docs[part][at] == docs, lists.impacts[part][at], 0)
        read += len(docs)
        if len(found) > top:
            bar = max(bar, int(np.partition(found, -top)[-top]))
        kept = found + bounds[k + 1] >= bar
        docs, found = docs[kept], found[kept]
    kept = found >= max(bar, 1)
    docs, found = docs[kept], found[kept]
    order = np.lexsort((docs, -found))[:top]
    return docs[order], found[order], read


def index_shards(forward: DataFrame, weights: np.ndarray, total: tuple[int, int], pairs: np.ndarray, postings: int = POSTINGS) -> DataFrame:
    """One row per shard."""
    held = forward.sparkSession.sparkContext.broadcast((weights, total, pairs))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def shard(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(rows).combine_chunks()
            terms, tfs = (table.column(c).combine_chunks() for c in ("terms", "tfs"))
            sizes = pa.compute.list_value_length(terms).to_numpy()
            lists = invert(table.column("doc_id").combine_chunks(), table.column("n").to_numpy(), sizes, terms.flatten().to_numpy(), tfs.flatten().to_numpy(), *held.value)
            left, right = [a for a, _ in lists.joint], [b for _, b in lists.joint]
            row = [lists.ids, lists.terms, lists.ends, lists.docs, lists.impacts, lists.greatest, left, right, list(lists.joint.values())]
            arrays = [v if isinstance(v, pa.Array) else pa.array(v, f.type.value_type) for v, f in zip(row, _INDEX)]
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in arrays], schema=_INDEX)

        rows, n = [], 0
        for batch in batches:
            start = 0
            ends = np.cumsum(pa.compute.list_value_length(batch.column("terms")).to_numpy())
            while start < batch.num_rows:
                before = int(ends[start - 1]) if start else 0
                stop = min(int(np.searchsorted(ends, before + postings - n)) + 1, batch.num_rows)
                rows.append(batch.slice(start, stop - start))
                n += int(ends[stop - 1]) - before
                start = stop
                if n >= postings:
                    yield shard(rows)
                    rows, n = [], 0
        if rows:
            yield shard(rows)

    return forward.filter("size(terms) > 0").mapInArrow(build, _INDEX_SPARK)


def _read_lists(batch: pa.RecordBatch, row: int) -> Lists:
    values = [batch.column(c)[row].values for c in _INDEX.names]
    ids, terms, ends, docs, impacts, greatest, left, right, joint = [values[0], *(v.to_numpy(zero_copy_only=False) for v in values[1:])]
    return Lists(ids, terms, ends, docs, impacts, greatest, dict(zip(zip(left.tolist(), right.tolist()), joint.tolist())))


def search_shards(index: DataFrame, queries: list[tuple[int, list[int]]], top: int = TOP, paired: bool = True) -> DataFrame:
    """``q, doc_id, score``: of every task, the best documents of each query over all its shards."""
    asked = index.sparkSession.sparkContext.broadcast(queries)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                lists = _read_lists(batch, row)
                ids = pa.compute.fill_null(lists.ids, 0).to_numpy()
                unnamed = lists.ids.is_null().to_numpy(zero_copy_only=False)
                for q, terms in asked.value:
                    held = best.get(q)
                    bar = int(held[0][-1]) if held is not None and len(held[0]) == top else 1
                    docs, scores, _ = best_of(lists, terms, top, bar, paired)
                    if not len(docs):
                        continue
                    new = scores, unnamed[docs], ids[docs]
                    if held is not None:
                        new = tuple(np.concatenate(x) for x in zip(held, new))
                    order = np.lexsort((new[2], new[1], -new[0]))[:top]
                    best[q] = tuple(x[order] for x in new)
        for q, (scores, unnamed, ids) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), q)), pa.array(ids, mask=unnamed), pa.array(scores)], ["q", "doc_id", "score"])

    few = index.coalesce(4 * index.sparkSession.sparkContext.defaultParallelism)
    return few.mapInArrow(search, "q long, doc_id long, score long")


def _ranked(found: DataFrame, by: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _block(docs: DataFrame, key: str, text: str, terms: DataFrame, top: int, postings: int, paired: bool) -> DataFrame:
    """The best documents of the items of one block."""
    rows = terms.collect()  # bounded by VOCABULARY
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(r["term"]) for r in rows}))}
    queries: dict[int, list[int]] = {}
    for r in rows:
        queries.setdefault(r["q"], []).append(vocabulary[bytes(r["term"])])
    forward = materialise(forward_table(docs, key, text, vocabulary), "forward")
    documents, length = forward.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in forward.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[r["term"]] = r["count"]
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    frequent = (sorted(q, key=lambda t: (-df[t], t))[:PAIRED] for q in queries.values())
    pairs = sorted({pair for q in frequent for pair in combinations(sorted(t for t in q if df[t]), 2)})
    shards = index_shards(forward, weights, (documents, length), np.array(pairs, np.int64).reshape(-1, 2), postings)
    index = materialise(shards, "lexical-index")
    return search_shards(index, [(q, sorted(t)) for q, t in sorted(queries.items())], top, paired)


def rank(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", top: int = TOP,
    postings: int = POSTINGS, vocabulary: int = VOCABULARY, paired: bool = True,
) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the best documents of every item. ``paired`` is off for plain maxima."""
    asked = materialise(items.select(F.col(item).alias("item_id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("q")), "items")
    terms = materialise(_item_terms(asked), "item-terms")
    size = terms.agg(F.coalesce(F.sum(F.octet_length("term") + 8), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / vocabulary))
    found = None
    for block in range(blocks):
        part = terms.filter(F.pmod(F.xxhash64("q"), F.lit(blocks)) == block)
        best = _block(docs, key, text, part, top, postings, paired)
        found = best if found is None else found.unionByName(best)
    spread = found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64)))
    first = _ranked(spread, ["q", "part"], top).drop("rank", "part")
    return _ranked(first, ["q"], top).join(asked.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")
