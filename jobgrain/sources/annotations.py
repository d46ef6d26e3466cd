"""Annotated texts and JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ANNOTATION_SCHEMA = "text STRING, entities ARRAY<STRUCT<start: INT, `end`: INT, label: STRING>>"


def read_annotations(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Texts with labelled character spans. A file is one JSON array, or one object per line when not multi-line."""
    return spark.read.schema(ANNOTATION_SCHEMA).option("multiLine", multi_line).json(path)


def read_records(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def write_records(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)
