"""Deterministic splits."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def hash_percent(key: Column) -> Column:
    """A stable number 0..99 per key. It depends on the key only, never on partitioning or run."""
    prefix = F.substring(F.md5(key.cast("string")), 1, 8)
    return F.conv(prefix, 16, 10).cast("bigint") % 100


def split_name(key: Column, shares: dict[str, int]) -> Column:
    """Name of the share a key falls into; shares are per cent and sum to 100."""
    if sum(shares.values()) != 100:
        raise ValueError("shares must sum to 100")
    bucket, upper, chain = hash_percent(key), 0, F
    for name, share in shares.items():
        upper += share
        chain = chain.when(bucket < upper, F.lit(name))
    return chain
