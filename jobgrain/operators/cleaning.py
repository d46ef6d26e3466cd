"""Validation, normalisation and de-duplication of postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobgrain.functions.arrays import unfold
from jobgrain.functions import dates, salary, text

# What makes two postings the same, and the accepted years of experience.
DEDUP_KEYS = ["title", "company", "location", "posted_date"]
EXPERIENCE_MIN = 0
EXPERIENCE_MAX = 50

# The quality gate for a whole table.
REQUIRED_COLUMNS = ["title", "description"]
MIN_ROWS = 10
MAX_NULL_SHARE = 0.5

# Fixed value: a well-formed e-mail address.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def remove_duplicates(df: DataFrame, keys: list[str] | None = None, order_by: Column | str = "job_id") -> DataFrame:
    """First posting of each key by ``order_by``; null keys count as equal. Raises when a key column is missing.

    ``row_number() = 1`` keeps a deterministic row and plans as a group limit before and after the shuffle, so each
    task sends at most one row per key however many copies there are.
    """
    keys = DEDUP_KEYS if keys is None else keys
    missing = [k for k in keys if k not in df.columns]
    if missing or not keys:
        raise ValueError(f"no column to tell duplicates by: {missing or 'no keys'}; name the keys that are there")
    first = Window.partitionBy(*keys).orderBy(order_by)
    return df.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def drop_incomplete(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Rows whose required texts are neither null nor blank."""
    for name in required or REQUIRED_COLUMNS:
        df = df.filter(text.normalize_text(F.col(name)) != "")
    return df


def clip_experience(years: Column, low: int = EXPERIENCE_MIN, high: int = EXPERIENCE_MAX) -> Column:
    """Years limited to the accepted range; null stays null."""
    return F.when(years.isNotNull(), F.least(F.greatest(years, F.lit(low)), F.lit(high)))


def ordered_bounds(low: Column, high: Column) -> tuple[Column, Column]:
    """The two bounds, exchanged when inverted; a null bound leaves both alone."""
    inverted = low > high
    return F.when(inverted, high).otherwise(low), F.when(inverted, low).otherwise(high)


def validate_postings(df: DataFrame) -> DataFrame:
    """Drop incomplete rows, clip experience, put salary bounds in order. Absent optional columns are skipped."""
    df = drop_incomplete(df)
    if "experience_years" in df.columns:
        df = df.withColumn("experience_years", clip_experience(F.col("experience_years")))
    if {"salary_min", "salary_max"} <= set(df.columns):
        low, high = ordered_bounds(F.col("salary_min"), F.col("salary_max"))
        df = df.withColumns({"salary_min": low, "salary_max": high})
    return df


def preprocess(df: DataFrame, remove_dups: bool = True, dedup_keys: list[str] | None = None) -> DataFrame:
    """The whole cleaning step, narrow but for the optional de-duplication.

    Absent optional columns are tolerated. De-duplication needs its keys: the usual four, or those named.
    """
    if "experience_years" in df.columns and df.schema["experience_years"].dataType.typeName() == "string":
        df = df.withColumn("experience_years", F.col("experience_years").try_cast("double").try_cast("int"))
    for bound in ("salary_min", "salary_max"):
        if bound in df.columns:
            is_text = df.schema[bound].dataType.typeName() == "string"
            amount = salary.clean_salary(F.col(bound)) if is_text else F.col(bound).cast("double")
            df = df.withColumn(bound, amount)
    df = validate_postings(df)
    if remove_dups:
        df = remove_duplicates(df, dedup_keys, order_by="job_id" if "job_id" in df.columns else F.col("description"))
    added = {
        "title_normalized": text.normalize_title(F.col("title")),
        "description_clean": text.normalize_text(F.col("description")),
    }
    if "location" in df.columns:
        added["location_normalized"] = text.normalize_location(F.col("location"))
    df = df.withColumns(added)
    if "posted_date" in df.columns:
        df = df.withColumn("posted_date_parsed", dates.parse_date(F.col("posted_date")))
        df = dates.add_date_parts(df)
    return df


def flag_salary_band(df: DataFrame, column: str) -> DataFrame:
    """Mark, never drop, salaries outside the plausible band."""
    return df.withColumn("salary_plausible", salary.is_plausible_salary(F.col(column)))


def quality_report(
    df: DataFrame, required: list[str] | None = None, min_rows: int = MIN_ROWS, max_null_share: float = MAX_NULL_SHARE
) -> DataFrame:
    """One row per column, present or required: rows, nulls, null share and whether the column passes.

    A single aggregate over one scan, turned into rows afterwards.
    """
    required = REQUIRED_COLUMNS if required is None else required
    present = df.columns
    absent = [c for c in required if c not in present]
    counts = df.agg(
        F.count("*").alias("rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(present)]
    )
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.lit(True).alias("present"), F.col(f"n{i}").alias("nulls"))
        for i, c in enumerate(present)
    ] + [
        F.struct(F.lit(c).alias("column_name"), F.lit(False).alias("present"), F.col("rows").alias("nulls"))
        for c in absent
    ]
    share = F.coalesce(F.try_divide(F.col("nulls").cast("double"), F.col("rows")), F.lit(0.0))
    return (
        counts.select("rows", F.inline(F.array(*entries)))
        .withColumn("required", F.col("column_name").isin(required))
        .withColumn("null_share", share)
        .withColumn(
            "passes", F.col("present") & (F.col("rows") >= min_rows) & (F.col("null_share") <= max_null_share)
        )
        .select("column_name", "present", "required", "rows", "nulls", "null_share", "passes")
    )


def email_report(df: DataFrame, text_column: str, group: str) -> DataFrame:
    """Per group: words with an at sign, how many are well-formed addresses, and how many are not."""
    words = unfold(df, F.split(text_column, r"[ \t\r\n]+"), "word", group).filter(
        F.col("word").contains("@")
    )
    well_formed = F.col("word").rlike(EMAIL_PATTERN)
    return words.groupBy(group).agg(
        F.count_if(well_formed).alias("well_formed"), F.count_if(~well_formed).alias("malformed")
    )
