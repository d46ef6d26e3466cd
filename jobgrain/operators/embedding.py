"""Skill extraction by vectors: the closest skills by cosine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from jobgrain.session import cut_lineage

TOP_K = 20
THRESHOLD = 0.78
BROADCAST_BYTES = 64 * 1024**2
#: Vectors of a block on either side, and copies of each block of skills, so that a block is not one hot join key.
BLOCK_ROWS, SPREAD = 512, 16
#: Scores that agree to this many places are ties, whatever the order in which a product is summed.
PLACES = 12


def unit_vector(vector: Column) -> Column:
    """The vector scaled to length one, in double; a zero vector stays zero."""
    wide = vector.cast("array<double>")
    norm = F.sqrt(F.aggregate(wide, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.transform(wide, lambda x: F.when(norm > 0, x / norm).otherwise(F.lit(0.0)))


def centroids(df: DataFrame, label: str, vector: str) -> DataFrame:
    """Mean vector per label: one pre-aggregated shuffle on (label, dimension)."""
    long = df.select(F.col(label).alias("_label"), F.posexplode(F.col(vector).cast("array<double>")).alias("_i", "_x"))
    means = long.groupBy("_label", "_i").agg(F.avg("_x").alias("_x"))
    packed = means.groupBy("_label").agg(F.array_sort(F.collect_list(F.struct("_i", "_x"))).alias("_v"))
    return packed.select(F.col("_label").alias("skill"), F.transform("_v", lambda s: s["_x"]).alias("vector"))


def closest_skills(
    texts: DataFrame,
    skills: DataFrame,
    top_k: int = TOP_K,
    threshold: float = THRESHOLD,
    id_column: str = "job_id",
    text_vector: str = "vector",
    skill_vector: str = "vector",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(id, skill, score, rank) of the ``top_k`` closest skills at or above the threshold, ties by name.

    The skill side is measured first. Up to ``broadcast_bytes`` it goes to every task as one matrix and each Arrow
    batch of texts is one matrix product: linear in the texts and without a shuffle. Beyond that both sides are
    packed into blocks, each pair of blocks is one matrix product, and of each text's scores in it only the ``top_k``
    leave the task.
    """
    measure = skills.agg(F.count("*").alias("n"), F.max(F.size(skill_vector)).alias("d")).first()
    if measure["n"] * (measure["d"] or 0) * 8 <= broadcast_bytes:
        return _by_matrix(texts, skills, top_k, threshold, id_column, text_vector, skill_vector)
    return _by_blocks(texts, skills, top_k, threshold, id_column, text_vector, skill_vector)


def _best(scores: np.ndarray, top_k: int, threshold: float) -> tuple[np.ndarray, ...]:
    """Row, column, score and rank of the best columns of each row; ties in the order of the columns."""
    row, col = np.nonzero(scores >= threshold - 10.0**-PLACES)
    value = scores[row, col]
    near = np.round(value, PLACES)
    order = np.lexsort((col, -near, row))
    order = order[near[order] >= threshold]
    row, col, value = row[order], col[order], value[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row, side="left") + 1
    keep = rank <= top_k
    return row[keep], col[keep], value[keep], rank[keep].astype(np.int32)


def _by_matrix(texts, skills, top_k, threshold, id_column, text_vector, skill_vector) -> DataFrame:
    rows = skills.select("skill", unit_vector(F.col(skill_vector)).alias("v")).orderBy("skill").collect()
    matrix = texts.sparkSession.sparkContext.broadcast(
        (np.array([r["skill"] for r in rows], dtype=object), np.array([r["v"] for r in rows], dtype=np.float64))
    )
    id_type = texts.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {id_type}, skill string, score double, rank int"

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, unit_skills = matrix.value
        for batch in batches:
            if len(batch) == 0 or len(names) == 0:
                continue
            block = np.stack(batch["v"].to_numpy()).astype(np.float64)
            row, col, value, rank = _best(block @ unit_skills.T, top_k, threshold)
            # Names are sorted, so the order of the columns breaks ties by name.
            yield pd.DataFrame({id_column: batch["id"].to_numpy()[row], "skill": names[col], "score": value, "rank": rank})

    usable = texts.filter(F.col(text_vector).isNotNull())
    return usable.select(F.col(id_column).alias("id"), unit_vector(F.col(text_vector)).alias("v")).mapInPandas(
        score, schema
    )


def pack_vectors(df: DataFrame, number: str, vector: str, rows: int = BLOCK_ROWS) -> DataFrame:
    """Vectors in blocks of at most ``rows``: (numbers array, matrix binary of little-endian doubles), packed in their task."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                matrix = part.column(1).flatten().to_numpy(zero_copy_only=False).astype("<f8").tobytes()
                numbers = pa.array([part.column(0).to_pylist()], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([numbers, pa.array([matrix], pa.binary())], ["numbers", "matrix"])

    return df.select(F.col(number), F.col(vector)).mapInArrow(pack, "numbers array<bigint>, matrix binary")


def _by_blocks(texts, skills, top_k, threshold, id_column, text_vector, skill_vector) -> DataFrame:
    # Numbers are written before they are packed, so a task that runs again finds the same ones.
    rows = cut_lineage(
        texts.filter(F.col(text_vector).isNotNull()).select(
            F.monotonically_increasing_id().alias("_row"), F.col(id_column), unit_vector(F.col(text_vector)).alias("_v")
        )
    )
    probes = pack_vectors(rows, "_row", "_v").withColumn("_copy", F.pmod(F.xxhash64("numbers"), F.lit(SPREAD)))
    unit = skills.select("skill", unit_vector(F.col(skill_vector)).alias("v"))
    n_blocks = max(1, -(-unit.count() // BLOCK_ROWS))
    blocks = (
        unit.groupBy(F.pmod(F.xxhash64("skill", "v"), F.lit(n_blocks)).alias("_block"))
        .agg(F.array_sort(F.collect_list(F.struct("skill", "v"))).alias("s"))
        .select("_block", F.col("s.skill").alias("names"), F.col("s.v").alias("vectors"))
        .withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)).cast("array<bigint>")))
    )

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, matrix, names, vectors in zip(*(batch.column(c) for c in ("numbers", "matrix", "names", "vectors"))):
                names, vectors = names.values, vectors.values
                right = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(names), -1)
                left = np.frombuffer(matrix.as_buffer(), "<f8").reshape(len(number), -1)
                row, col, value, _ = _best(left @ right.T, top_k, threshold)
                yield pa.RecordBatch.from_arrays(
                    [number.values.take(pa.array(row)), names.take(pa.array(col)), pa.array(value, pa.float64())],
                    ["_row", "skill", "score"],
                )

    pairs = probes.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<bigint>"))).join(
        blocks, ["_block", "_copy"]
    )
    hits = pairs.select("numbers", "matrix", "names", "vectors").mapInArrow(product, "_row bigint, skill string, score double")
    ordered = Window.partitionBy("_row").orderBy(F.desc(F.round("score", PLACES)), "skill")
    best = hits.withColumn("rank", F.row_number().over(ordered)).filter(F.col("rank") <= top_k)
    return rows.select("_row", id_column).join(best, "_row").select(id_column, "skill", "score", "rank")
