"""Arrays to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def unfold(df: DataFrame, array: Column | str, name: str, *keep: Column | str) -> DataFrame:
    """One row per non-null item.

    A plain ``explode`` makes the optimizer add a filter on the array below it, which evaluates the array twice; for
    arrays that come from tokenising a text this would double the work.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())
