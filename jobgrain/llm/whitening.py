"""Embedding whitening by FEAST contour integration.

Entries become whole numbers, ``x = floor(64 c) + 1000000``. The fit list holds each distinct vector once. Passes over it:
exact sums per dimension; the covariance of the centred vectors; at the end the covariance of the whitened ones, whose
distance from the identity is reported. A task keeps one matrix, tasks are at most four per core, and their matrices meet row by
row, so the driver receives one matrix of dimension times dimension (``WIDEST`` bounds it at 128 MB).

The leading eigenvectors come from contour integrals. The inertia of shifted matrices (signs of the pivots of an LDL^T
factorisation) counts eigenvalues above a shift; bisection on it finds the shift below the wanted ones and cuts the range
above into slices of at most ``SLICE`` eigenvalues. Each slice is a row of a Spark job: midpoint quadrature of complex
shifted solves round the slice projects a block of vectors onto its eigenspace, Rayleigh-Ritz extracts the components, and
this repeats until residuals vanish and as many are found as the inertia counts. A slice that misses one fails the job.
The slices are made orthogonal by one last Rayleigh-Ritz over all of them; a component's largest entry is positive.

Defined cases: rows with a null vector, an empty one, or null or non-finite entries are dropped, as are rows whose length
is not the one that most distinct vectors have (the greater of equals); entries beyond 2^62 / 64 stop there; a null id is an id
like any other and repeated rows all get results; there are fewer components than asked for where the covariance has
fewer eigenvalues above rounding error, none where all vectors are equal; eigenvalues equal to rounding error share their
space in an arbitrary basis; ``deviation`` is null where it exceeds a long; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from jobgrain.llm.vectors import matrices
from jobgrain.session import materialise

#: Components, eigenvalues in a slice, nodes on the half circle, turns of a slice, and the longest vectors.
COMPONENTS, SLICE, NODES, TURNS, WIDEST = 16, 4, 16, 40, 4096
#: How entries become whole numbers, as fixed by the definition of the result.
SCALE, SHIFT = 64, 1_000_000
_FAR = 2.0**62
_ALPHA = (1 + 17**0.5) / 8


def whole_numbers(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``vec_id, x`` of the rows that stay."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, matrix in matrices(batch.column(1)):
                good = np.isfinite(matrix).all(axis=1)
                with np.errstate(over="ignore"):
                    x = np.clip(np.floor(SCALE * matrix[good]), -_FAR, _FAR).astype(np.int64) + SHIFT
                offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * matrix.shape[1])
                held = pa.ListArray.from_arrays(offsets, pa.array(x.reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at[good])), held], ["vec_id", "x"])

    base = rows.select(F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("embedding"))
    return base.mapInArrow(coded, f"vec_id {base.schema['vec_id'].dataType.simpleString()}, x array<long>")


def _blocks(batches: Iterator[pa.RecordBatch], column: str = "x") -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            yield batch, batch.column(column).flatten().to_numpy().reshape(batch.num_rows, -1)


def sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Rows and exact sums per dimension of a table of vectors of one length."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, 0, 0
        for _, x in _blocks(batches):
            n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            columns = [pa.array(np.append(np.arange(len(high)), -1)), pa.array(np.append(high, 0)), pa.array(np.append(low, n))]
            yield pa.RecordBatch.from_arrays(columns, ["i", "high", "low"])

    whole = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    found = fit.mapInArrow(partial, "i long, high long, low long").groupBy("i").agg(*whole).collect()
    totals = {r["i"]: (int(r["high"]) << 32) + int(r["low"]) for r in found}
    n = totals.pop(-1, 0)
    return n, [totals[i] for i in range(len(totals))]


def centre(n: int, total: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Whole part and remainder over ``n`` of the mean, so that ``n * x - S = n * (x - whole) - rest`` exactly."""
    return np.array([s // n for s in total], np.int64), np.array([s % n for s in total], np.int64)


def covariance(fit: DataFrame, n: int, width: int, place: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Mean outer product of ``place(x)`` over the table, symmetric."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for _, x in _blocks(batches):
            y = place(x)
            total += y.T @ y
        offsets = pa.array(np.arange(width + 1, dtype=np.int32) * width)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.ListArray.from_arrays(offsets, pa.array(total.reshape(-1)))], ["i", "row"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch, row in _blocks(batches, "row"):
            for i, values in zip(batch.column("i").to_pylist(), row):
                held[i] = held[i] + values if i in held else values
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([v.tolist() for v in held.values()], pa.list_(pa.float64()))], ["i", "row"])

    shape = "i long, row array<double>"
    few = fit.coalesce(4 * fit.sparkSession.sparkContext.defaultParallelism)
    out = np.zeros((width, width))
    for r in few.mapInArrow(partial, shape).repartition("i").mapInArrow(fold, shape).collect():
        out[r["i"]] = r["row"]
    return (out + out.T) / (2 * n)


def count_above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues above the shift: the positive part of the inertia, by LDL^T with complete pivoting."""
    a = matrix - shift * np.eye(len(matrix))
    positive = 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        k, off = int(diagonal.argmax()), np.abs(a - np.diag(np.diag(a)))
        r, s = divmod(int(off.argmax()), len(a))
        if max(diagonal[k], off[r, s]) == 0:
            break
        pivots = [k] if diagonal[k] >= _ALPHA * off[r, s] else [r, s]
        rest = np.delete(np.arange(len(a)), pivots)
        block, side = a[np.ix_(pivots, pivots)], a[np.ix_(rest, pivots)]
        positive += int(block[0, 0] > 0) if len(pivots) == 1 else 1  # a two by two pivot has one of each sign
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
        a = (a + a.T) / 2
    return positive


def slices(matrix: np.ndarray, wanted: int = COMPONENTS, size: int = SLICE) -> list[tuple[float, float, int]]:
    """``low, high, count`` of disjoint ranges that hold the ``wanted`` greatest eigenvalues above rounding error, few each.

    Eigenvalues that rounding cannot part stay in one range, so a range may hold more than ``size``, the lowest one more than wanted.
    """
    trace = float(np.trace(matrix))
    floor = 8 * len(matrix) * np.finfo(float).eps * trace
    if trace <= 0 or not (there := count_above(matrix, floor)):
        return []
    wanted = min(wanted, there)
    top = trace * (1 + 1e-9)
    near = floor
    while top > 1.05 * near:  # a tight upper end keeps the contours small
        middle = (near * top) ** 0.5 if near > 0 else top / 2
        near, top = (middle, top) if count_above(matrix, middle) else (near, middle)
    low, high, at = floor, top, there
    while at != wanted:
        middle = (low + high) / 2
        if not low < middle < high or high - low < 1e-14 * top:
            break
        n = count_above(matrix, middle)
        if n >= wanted:
            low, at = middle, n
        else:
            high = middle
    else:  # move the end into the gap below the last wanted one
        under, over = floor, low
        for _ in range(12):
            middle = (under + over) / 2
            under, over = (under, middle) if count_above(matrix, middle) == at else (middle, over)
        above, beyond = low, high
        for _ in range(12):
            middle = (above + beyond) / 2
            above, beyond = (middle, beyond) if count_above(matrix, middle) >= at else (above, middle)
        low = max((over + above) / 2, floor)
    parts, open_parts = [], [(low, top, at, 0)]
    while open_parts:
        lo, hi, many, few = open_parts.pop()
        middle = (lo + hi) / 2
        if many - few <= size or hi - lo < 1e-10 * top:
            if many > few:
                parts.append((lo, hi, many - few))
        else:
            n = count_above(matrix, middle)
            open_parts += [(lo, middle, many, n), (middle, hi, n, few)]
    return sorted(parts, reverse=True)


def contour(matrix: np.ndarray, low: float, high: float, count: int) -> np.ndarray:
    """Orthonormal eigenvectors of the eigenvalues in a range, ``count`` of them by inertia."""
    d = len(matrix)
    middle, radius = (low + high) / 2, (high - low) / 2
    angles = np.pi * (np.arange(NODES) + 0.5) / NODES
    turns = [radius * np.exp(1j * t) for t in angles]
    size = min(d, 2 * count + 8)
    block = np.random.default_rng(7).standard_normal((d, size))
    scale = np.abs(matrix).max() * d
    for _ in range(TURNS):
        projected = sum((w * np.linalg.solve((middle + w) * np.eye(d) - matrix, block.astype(complex))).real for w in turns) / NODES
        basis, _ = np.linalg.qr(projected)
        values, inner = np.linalg.eigh(basis.T @ matrix @ basis)
        block = basis @ inner
        inside = (values > low) & (values <= high)
        off = np.abs(matrix @ block[:, inside] - block[:, inside] * values[inside]).max(initial=0)
        if inside.sum() == count and off <= 1e-13 * scale:
            return block[:, inside]
    raise RuntimeError(f"{int(inside.sum())} components found between {low} and {high}, the inertia counts {count}")


def leading(rows: DataFrame, matrix: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues, falling, and their vectors as columns; one Spark task for each slice."""
    parts = slices(matrix, wanted)
    if not parts:
        return np.empty(0), np.empty((len(matrix), 0))

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in frame.itertuples(index=False):
                found = contour(matrix, part.low, part.high, part.n)
                yield pd.DataFrame({"part": part.part, "vector": list(found.T)})

    spark = rows.sparkSession
    table = spark.createDataFrame([(i, float(lo), float(hi), n) for i, (lo, hi, n) in enumerate(parts)], "part int, low double, high double, n int")
    found = table.repartition(len(parts), "part").mapInPandas(solve, "part int, vector array<double>").collect()
    if len(found) != sum(n for _, _, n in parts):
        raise RuntimeError(f"{len(found)} components found, the inertia counts {parts}")
    basis, _ = np.linalg.qr(np.array([r["vector"] for r in sorted(found, key=lambda r: r["part"])]).T)
    values, inner = np.linalg.eigh(basis.T @ matrix @ basis)
    order = np.argsort(-values, kind="stable")[:wanted]
    vectors = basis @ inner[:, order]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return values[order], vectors * sign


def deviations(x: np.ndarray, n: int, whole: np.ndarray, rest: np.ndarray) -> pa.Array:
    """Exact sum of ``(n * x - S) ** 2`` of every row; null where it exceeds a long."""
    about = ((x - whole).astype(float) - rest / n) * n
    fits = (about * about).sum(axis=1) < 1.01 * 2.0**63  # then no product and no sum below leaves 64 bits
    exact = np.where(fits[:, None], x - whole, 0) * n - rest
    total = (np.abs(exact).astype(np.uint64) ** np.uint64(2)).sum(axis=1, dtype=np.uint64)
    fits &= total < np.uint64(1 << 63)
    return pa.array(np.where(fits, total, 0).astype(np.int64), mask=~fits)


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every row that stays and every component."""
    coded = whole_numbers(rows, key, vector)
    kind = coded.schema["vec_id"].dataType.simpleString()
    shape = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fit = materialise(coded.select("x").distinct(), "fit")
    longest = fit.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if longest is None:
        return rows.sparkSession.createDataFrame([], shape)
    width = longest["width"]
    if width > WIDEST:
        raise ValueError(f"vectors of {width} entries; the covariance is bounded at {WIDEST}")
    fit, coded = fit.filter(F.size("x") == width), coded.filter(F.size("x") == width)
    n, total = sums(fit)
    whole, rest = centre(n, total)
    centred = lambda x: (x - whole).astype(float) - rest / n
    spread = covariance(fit, n, width, centred)
    values, vectors = leading(rows, spread, components)
    count = len(values)
    if not count:
        return rows.sparkSession.createDataFrame([], shape)
    into, explained = vectors / np.sqrt(values), values / np.trace(spread)
    error = float(np.abs(covariance(fit, n, count, lambda x: centred(x) @ into) - np.eye(count)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _blocks(batches):
            each = np.repeat(np.arange(len(x)), count)
            many = len(each)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(many, n)), deviations(x, n, whole, rest).take(pa.array(each)),
                    pa.array((centred(x) @ into).reshape(-1)), pa.array(np.tile(explained, len(x))), pa.array(np.full(many, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return coded.mapInArrow(project, shape)
