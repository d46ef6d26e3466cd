"""Document quality by a byte-level convolutional network in numpy.

Filters of ``WIDTH`` bytes run over the whole text. It is read as chunks of ``2 * HALF`` bytes that overlap by half; each
filter is max-pooled within a chunk, and the mean and the largest over all chunks of the document give one probability.

The network is fitted on at most ``SAMPLE`` labelled rows, taken in the order of a hash of their id, so that the driver's
work has a bound; scoring reads every row and all of its bytes. Only the text is an input of a score.

Defined cases: a null text counts as empty and gets a score as any other; texts shorter than a filter are padded with
zeros; ids with contradicting labels and labels without a document teach nothing; without labels of both kinds all scores
are the share of label 1, or one half; repeated rows and null ids keep their rows; further columns are carried by
``keep_good`` and not read by ``score``.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Bytes of a filter, filters, bytes of half a chunk, labelled rows at most, passes over them, bytes scored at once.
WIDTH, FILTERS, HALF, SAMPLE, EPOCHS, SLAB = 4, 8, 128, 1500, 12, 1 << 18
#: Least steps of fitting; few labelled rows get more passes.
STEPS = 600
#: Share of the labelled texts shown as a random passage in a pass of fitting; scoring always reads the whole text.
PASSAGES = 0.3
#: Score from which a document counts as good.
GOOD = 0.7


class Network(NamedTuple):
    """Filter weights for each byte at each place, their bias, weights of mean and largest activation, and the offset."""

    filters: np.ndarray
    bias: np.ndarray
    mean: np.ndarray
    largest: np.ndarray
    offset: float


def layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts end to end, each padded to whole halves; the first half of each, and the valid places of each half."""
    halves = np.array([max(1, -(-len(t) // HALF)) for t in texts])
    first = np.cumsum(halves) - halves
    data = np.zeros(int(halves.sum()) * HALF + WIDTH, np.uint8)
    valid = np.full(int(halves.sum()), HALF)
    for text, at, n in zip(texts, first, halves):
        data[at * HALF : at * HALF + len(text)] = np.frombuffer(text, np.uint8)
        places = max(len(text) - WIDTH + 1, 1)
        valid[at : at + n] = np.clip(places - HALF * np.arange(n), 0, HALF)
    return data, first, valid


def _pairs(data: np.ndarray) -> np.ndarray:
    return data[:-1].astype(np.uint16) << 8 | data[1:]


def _half_maxima(net: Network, data: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Largest response of each filter in each half, a slab of bytes at a time, two bytes to a lookup."""
    table = [(net.filters[w][:, None, :] + net.filters[w + 1][None, :, :]).reshape(1 << 16, -1) for w in range(0, WIDTH, 2)]
    maxima, step = np.empty((len(valid), net.filters.shape[2]), np.float32), SLAB // HALF
    for at in range(0, len(valid), step):
        n = min(step, len(valid) - at)
        pairs = _pairs(data[at * HALF : (at + n) * HALF + WIDTH])
        response = table[0][pairs[: n * HALF]]
        for k in range(1, len(table)):
            response += table[k][pairs[2 * k : 2 * k + n * HALF]]
        response = response.reshape(n, HALF, -1)
        for short in np.flatnonzero(valid[at : at + n] < HALF):
            response[short, valid[at + short] :] = -np.inf
        maxima[at : at + n] = response.max(axis=1)
    return maxima


def _chunks(maxima: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each half together with the next of its document; the last half of a longer document starts no chunk."""
    ends = np.append(first[1:], len(maxima))
    chunk = maxima.copy()
    chunk[:-1] = np.maximum(chunk[:-1], maxima[1:])
    alone = ends - 1
    chunk[alone] = maxima[alone]
    starts = np.ones(len(maxima), bool)
    starts[alone[ends - first > 1]] = False
    return chunk, starts


def probabilities(net: Network, texts: list[bytes]) -> np.ndarray:
    if not texts:
        return np.zeros(0)
    data, first, valid = layout(texts)
    chunk, starts = _chunks(_half_maxima(net, data, valid), first)
    active = np.maximum(chunk + net.bias, 0)[starts]
    count = np.add.reduceat(starts.astype(np.int64), first)
    begin = np.cumsum(count) - count
    mean = np.add.reduceat(active, begin, axis=0, dtype=np.float64) / count[:, None]
    largest = np.maximum.reduceat(active, begin, axis=0)
    return 1 / (1 + np.exp(-np.clip(mean @ net.mean + largest @ net.largest + net.offset, -30, 30)))


def fit(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, batch: int = 16, seed: int = 7) -> Network:
    """Adam on the cross entropy; a pooled response passes its gradient to the place it came from."""
    rng = np.random.default_rng(seed)
    share = float(labels.mean()) if len(labels) else 0.5
    zero = np.zeros(FILTERS, np.float32)
    if not len(labels) or not 0 < share < 1:
        return Network(np.zeros((WIDTH, 256, FILTERS), np.float32), zero, zero, zero, float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    state = [
        rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32), zero.copy(), rng.normal(0, 0.3, FILTERS).astype(np.float32),
        rng.normal(0, 0.3, FILTERS).astype(np.float32), np.full(1, np.log(share / (1 - share)), np.float32),
    ]
    first_moment, second_moment, step = [np.zeros_like(p) for p in state], [np.zeros_like(p) for p in state], 0
    epochs = max(epochs, -(-STEPS * batch // len(texts)))
    for epoch in range(epochs):
        order, rate = rng.permutation(len(texts)), 0.02 * (1 - epoch / epochs) + 0.001
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            shown = [_passage(texts[i], rng) if rng.random() < PASSAGES else texts[i] for i in chosen]
            gradients = _gradients(Network(*state[:4], float(state[4][0])), shown, labels[chosen])
            step += 1
            for p, g, m, v in zip(state, gradients, first_moment, second_moment):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Network(*state[:4], float(state[4][0]))


def _passage(text: bytes, rng: np.random.Generator) -> bytes:
    """A random passage, so that short documents are not rare in fitting."""
    if len(text) < 64:
        return text
    size = int(rng.integers(32, min(len(text), 1024)))
    at = int(rng.integers(0, len(text) - size + 1))
    return text[at : at + size]


def _gradients(net: Network, texts: list[bytes], labels: np.ndarray) -> list[np.ndarray]:
    data, first, valid = layout(texts)
    n = len(valid)
    response = net.filters[0][data[: n * HALF]]
    for w in range(1, WIDTH):
        response += net.filters[w][data[w : w + n * HALF]]
    response = response.reshape(n, HALF, -1)
    for short in np.flatnonzero(valid < HALF):
        response[short, valid[short] :] = -np.inf
    place = response.argmax(axis=1)
    maxima = np.take_along_axis(response, place[:, None, :], 1)[:, 0]
    place = place + HALF * np.arange(n)[:, None]
    chunk, starts = _chunks(maxima, first)
    later = np.zeros_like(chunk, bool)
    later[:-1] = chunk[:-1] > maxima[:-1]
    place = np.where(later, np.roll(place, -1, axis=0), place)[starts]
    active = np.maximum(chunk + net.bias, 0)[starts]
    count = np.add.reduceat(starts.astype(np.int64), first)
    begin = np.cumsum(count) - count
    owner = np.repeat(np.arange(len(texts)), count)
    mean = np.add.reduceat(active, begin, axis=0) / count[:, None]
    largest = np.maximum.reduceat(active, begin, axis=0)
    score = 1 / (1 + np.exp(-np.clip(mean @ net.mean + largest @ net.largest + net.offset, -30, 30)))
    error = ((score - labels) / len(texts)).astype(np.float32)
    top = active == largest[owner]
    ties = np.add.reduceat(top, begin, axis=0, dtype=np.float32)[owner]
    back = (error[owner, None] * (net.mean / count[owner, None] + net.largest * top / ties)) * (active > 0)
    filters = np.zeros_like(net.filters)
    column = np.broadcast_to(np.arange(back.shape[1]), back.shape)
    for w in range(WIDTH):
        np.add.at(filters[w], (data[place + w], column), back)
    return [filters, back.sum(axis=0), error @ mean, error @ largest, error.sum(keepdims=True)]


def held_out(key: str) -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE
) -> Network:
    """A network from the labelled rows outside the held-out part; at most ``sample`` texts reach the driver."""
    known = labels.filter(~held_out(key) & F.col(label).isNotNull()).groupBy(key).agg(F.min(label).alias("low"), F.max(label).alias("label"))
    chosen = known.filter("low = label").orderBy(F.xxhash64(key), key).limit(sample).select(F.col(key).alias("chosen"), "label")
    rows = (
        docs.select(key, text).join(F.broadcast(chosen), F.col(key) == F.col("chosen"))
        .groupBy(key).agg(F.min(F.struct(F.xxhash64(text).alias("mark"), F.col(text).alias("text"), F.col("label").alias("label"))).alias("one"))
        .select(key, "one.text", "one.label").collect()  # of repeated ids the same one in every run
    )
    rows.sort(key=lambda r: r[0])
    return fit([(r[1] or "").encode() for r in rows], np.array([r[2] for r in rows], np.float32))


def with_scores(rows: DataFrame, net: Network) -> DataFrame:
    """The columns before the last and ``score``; the last column is the text."""
    shared = rows.sparkSession.sparkContext.broadcast(net)
    names = rows.columns[:-1]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(names)).cast(pa.binary())
            scores, size = [], 0
            group: list[bytes] = []
            for value in texts:
                group.append(value.as_py() or b"")
                size += len(group[-1])
                if size > 4 * SLAB:
                    scores.append(probabilities(shared.value, group))
                    group, size = [], 0
            scores.append(probabilities(shared.value, group))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.concatenate(scores))], [*names, "score"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema[:-1])
    return rows.mapInArrow(scored, f"{fields}score double")


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", good: float = GOOD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    net = train(docs, labels, key, text)
    rows = docs.select(F.col(key).alias("doc_id"), held_out(key).alias("held_out"), F.col(text).alias("text"))
    return with_scores(rows, net).withColumn("predicted", (F.col("score") >= good).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", good: float = GOOD) -> DataFrame:
    """The rows that count as good, with all their columns."""
    net = train(docs, labels, key, text)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), F.col(text).alias("text"))
    return with_scores(rows, net).filter(F.col("score") >= good).select("doc.*")
