"""Contiguous row numbers without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobgrain.session import materialise

_POSITION_BITS = 33


def with_row_number(df: DataFrame, name: str, order_by: list[Column]) -> DataFrame:
    """Prepend numbers 1..n in ``order_by`` order.

    Spark's per-partition counter gives the position in each range of the sorted frame, which is written with it once
    as a columnar table; one small table of range sizes turns the position into a global number.
    """
    if not order_by:
        raise ValueError("rows have no order of their own: name one in order_by")
    marked = materialise(df.orderBy(*order_by).withColumn("_mark", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_mark", _POSITION_BITS)
    sizes = marked.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    # One row per range, so the running sum and the broadcast are bounded by the number of partitions.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    position = F.col("_mark").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        marked.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select((F.col("_before") + position + 1).alias(name), *[F.col(f"`{c}`") for c in df.columns])
    )
