"""Dates and periods."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

# Accepted date forms, first match wins, so 05/03/2024 is the 3rd of May.
DATE_FORMATS = ["yyyy-M-d", "d-M-yyyy", "M/d/yyyy", "d/M/yyyy", "MMMM d, yyyy", "MMM d, yyyy"]

# The study period.
STUDY_START = "2024-01-01"
STUDY_END = "2025-06-30"


def parse_date(text: Column, formats: list[str] | None = None) -> Column:
    """First format that reads the whole trimmed text, else null."""
    trimmed = F.trim(text.cast("string"))
    return F.coalesce(*[F.try_to_date(trimmed, fmt) for fmt in formats or DATE_FORMATS])


def quarter_label(day: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(day))


def period_label(day: Column, frequency: str) -> Column:
    """Sortable period name: ``2024-01`` or ``2024Q1``."""
    if frequency == "monthly":
        return F.date_format(day, "yyyy-MM")
    if frequency == "quarterly":
        return F.concat(F.year(day), quarter_label(day))
    raise ValueError(f"Unknown frequency: {frequency}")


def add_date_parts(df: DataFrame, day: str = "posted_date_parsed") -> DataFrame:
    return df.withColumns(
        {
            "posted_year": F.year(day),
            "posted_month": F.month(day),
            "posted_quarter": quarter_label(F.col(day)),
        }
    )


def _day(text: str, fmt: str) -> date:
    return datetime.strptime(text, fmt).date()


def day_bounds(start: str, end: str, fmt: str = "%Y-%m-%d") -> tuple[date, date]:
    """Both bounds as days. What is no date in the format, or an end before the start, is an error that names it."""
    first, last = _day(start, fmt), _day(end, fmt)
    if last < first:
        raise ValueError(f"the range ends on {end}, before it starts on {start}")
    return first, last


def within_dates(
    df: DataFrame, day: str, start: str = STUDY_START, end: str = STUDY_END, fmt: str = "%Y-%m-%d"
) -> DataFrame:
    """Rows between two dates, both inclusive. The bounds are checked before anything is read."""
    first, last = day_bounds(start, end, fmt)
    # A half-open range on the column itself reaches the scan as a pushed filter, for dates and timestamps alike.
    return df.filter((F.col(day) >= F.lit(first)) & (F.col(day) < F.date_add(F.lit(last), 1)))
