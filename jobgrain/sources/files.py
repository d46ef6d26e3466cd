"""Audit of table content: size, digest and copies of each row; sizes of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Bytes per unit.
UNITS = {"B": 1, "KB": 1024, "MB": 1024**2, "GB": 1024**3}


def file_sizes(spark: SparkSession, path: str, pattern: str = "*", unit: str = "B") -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.col("length").alias("bytes"), (F.col("length") / UNITS[unit]).alias("size"))


def content_digests(df: DataFrame, key: str, content: str, algorithm: str = "sha256") -> DataFrame:
    """(key, bytes, digest) of every row; null content has neither size nor digest."""
    digest = {"md5": F.md5, "sha1": F.sha1, "sha256": lambda c: F.sha2(c, 256)}[algorithm]
    data = F.col(content).cast("binary")
    return df.select(key, F.octet_length(data).cast("bigint").alias("bytes"), digest(data).alias("digest"))


def duplicate_content(digests: DataFrame, key: str) -> DataFrame:
    """Digests shared by more than one row. Counts fold in each task, so a digest of many rows is no hot key."""
    return (
        digests.filter(F.col("digest").isNotNull()).groupBy("digest")
        .agg(F.count("*").alias("copies"), F.min(key).alias(f"first_{key}"), F.sum("bytes").alias("bytes"))
        .filter(F.col("copies") > 1)
    )
