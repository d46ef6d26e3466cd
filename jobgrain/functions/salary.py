"""Salary text and measures."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Plausible yearly salaries and the upper ends of the salary categories.
PLAUSIBLE_MIN = 100_000.0
PLAUSIBLE_MAX = 10_000_000.0
SALARY_BANDS = [(500_000.0, "Entry (<5L)"), (1_000_000.0, "Mid (5-10L)"), (1_500_000.0, "Senior (10-15L)")]
TOP_SALARY_BAND = "Expert (>15L)"

LAKH = 100_000.0

# The exponent form is how Spark prints large numbers.
_AMOUNT = r"^((?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:e[0-9]+)?)(l|lakhs?|k)?$"


def _amount(text: Column) -> Column:
    number = F.regexp_extract(text, _AMOUNT, 1).try_cast("double")
    unit = F.regexp_extract(text, _AMOUNT, 2)
    return number * F.when(unit == "", 1.0).when(unit == "k", 1_000.0).otherwise(LAKH)


def clean_salary(value: Column) -> Column:
    """Number behind a salary text: separators and currency signs dropped, units applied, ranges averaged."""
    text = F.regexp_replace(F.lower(value.cast("string")), r"[\s,₹$]", "")
    low, high = F.split_part(text, F.lit("-"), F.lit(1)), F.split_part(text, F.lit("-"), F.lit(2))
    is_range = text.rlike(r"^[^-]+-[^-]+$")
    return F.when(is_range, (_amount(low) + _amount(high)) / 2).otherwise(_amount(text))


def average_salary(low: Column, high: Column) -> Column:
    return (low + high) / 2


def is_plausible_salary(value: Column, low: float = PLAUSIBLE_MIN, high: float = PLAUSIBLE_MAX) -> Column:
    return value.between(low, high)


def salary_category(average: Column) -> Column:
    """Band label; a null average falls to the last band, as in an IF / ELSE chain."""
    chain = F.when(average < SALARY_BANDS[0][0], SALARY_BANDS[0][1])
    for upper, label in SALARY_BANDS[1:]:
        chain = chain.when(average < upper, label)
    return chain.otherwise(TOP_SALARY_BAND)
