"""Table, region and chart-tool exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobgrain.functions.text import UNKNOWN
from jobgrain.sources.postings import csv_options

# Columns of the two chart-tool exports and their display names.
GEOGRAPHIC_COLUMNS = [
    "job_id", "title", "company", "location_normalized", "city_tier", "region", "posted_date", "posted_year",
    "posted_month", "salary_min", "salary_max", "experience_years", "num_skills",
]
MAIN_COLUMNS = [
    "job_id", "title_normalized", "company", "location_normalized", "city_tier", "region", "posted_date",
    "job_type", "posted_year", "posted_month", "posted_quarter", "salary_min", "salary_max",
    "experience_years", "num_skills",
]
DISPLAY_NAMES = {
    "title_normalized": "title",
    "location_normalized": "location",
    "posted_year": "year",
    "posted_month": "month",
}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Parquet by default; CSV with header for tools that need it. One file per task, never one for all."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.options(**csv_options()).csv(path)
    else:
        writer.format(fmt).save(path)


def write_regional(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """One folder per known region, all written in one pass over the data.

    The rebalance hint brings a region's rows together, then lets adaptive execution split a region that holds most
    rows into advisory-sized tasks and merge the small ones.
    """
    writer = regional_rows(df).hint("rebalance", "region").write.mode(mode).partitionBy("region")
    if fmt == "csv":
        writer.options(**csv_options()).csv(path)
    else:
        writer.format(fmt).save(path)


def regional_rows(df: DataFrame) -> DataFrame:
    """Rows with a known region, the region in the lower case of its folder name."""
    return df.filter(F.col("region") != UNKNOWN).withColumn("region", F.lower("region"))


MANIFEST = "_manifest"


def replace_regions(df: DataFrame, path: str, batch: int, fmt: str = "csv") -> DataFrame:
    """Write the regions of a late batch over their old folders and leave all others as they are; returns the manifest.

    ``write_regional`` replaces the whole folder; here Spark's dynamic overwrite replaces a region's folder when the job
    commits, so a job that fails leaves the old rows. The manifest holds a row for each region and batch: it is
    written after the rows, and a batch that runs again replaces its own entry only, so either may be repeated. Rows of
    unknown regions are not written, as in ``write_regional``; an empty batch touches nothing.
    """
    rows = regional_rows(df)
    writer = rows.hint("rebalance", "region").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer = writer.partitionBy("region")
    if fmt == "csv":
        writer.options(**csv_options()).csv(path)
    else:
        writer.format(fmt).save(path)
    entry = rows.groupBy("region").agg(F.count("*").alias("rows")).withColumn("batch", F.lit(batch).cast("bigint")).coalesce(1)
    entry.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{path}/{MANIFEST}")
    return regional_manifest(df.sparkSession, path)


def regional_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(region, batch, rows): the last batch that replaced each region and the rows it left there."""
    entries = spark.read.schema("region string, rows bigint, batch bigint").parquet(f"{path}/{MANIFEST}")
    return entries.groupBy("region").agg(F.max("batch").alias("batch"), F.max_by("rows", "batch").alias("rows"))


def _export(df: DataFrame, wanted: list[str]) -> DataFrame:
    flags = [c for c in df.columns if c.startswith("has_")]
    present = [c for c in [*wanted, *flags] if c in df.columns]
    return df.select(*[F.col(f"`{c}`").alias(DISPLAY_NAMES.get(c, c)) for c in present])


def geographic_export(df: DataFrame) -> DataFrame:
    """Location columns and skill flags that exist, under their display names."""
    return _export(df, GEOGRAPHIC_COLUMNS)


def main_export(df: DataFrame) -> DataFrame:
    """All posting columns and skill flags that exist, under their display names."""
    return _export(df, MAIN_COLUMNS)
