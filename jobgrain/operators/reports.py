"""Summary tables behind charts and dashboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobgrain.functions.arrays import unfold
from jobgrain.functions.dates import period_label
from jobgrain.functions.quantiles import exact_quantiles
from jobgrain.functions.salary import LAKH

# Bins of the equal-width histograms and the edges of the experience histogram.
HISTOGRAM_BINS = 20
EXPERIENCE_LAST_EDGE = 10


def histogram(df: DataFrame, value: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """(bin, lower, upper, count) with equal-width bins from least to greatest value; empty bins are listed.

    A single distinct value gets the range value - 0.5 .. value + 0.5.
    """
    values = df.filter(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    low, high = F.min("v"), F.max("v")
    pad = F.when(low == high, 0.5).otherwise(0.0)
    bounds = values.agg(F.struct((low - pad).alias("lo"), (high + pad).alias("hi"))).scalar()
    step = (bounds["hi"] - bounds["lo"]) / bins
    number = F.least(F.floor((F.col("v") - bounds["lo"]) / step), F.lit(bins - 1)).cast("int")
    counts = values.groupBy(number.alias("bin")).agg(F.count("*").alias("count"))
    edges = (
        counts.agg(F.count("*").alias("n"))
        .filter("n > 0")
        .select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
        .select("bin", (bounds["lo"] + step * F.col("bin")).alias("lower"),
                (bounds["lo"] + step * (F.col("bin") + 1)).alias("upper"))
    )
    return edges.join(F.broadcast(counts), "bin", "left").select(
        "bin", "lower", "upper", F.coalesce("count", F.lit(0)).alias("count")
    )


def experience_histogram(df: DataFrame, years: str = "experience_years",
                         last_edge: int = EXPERIENCE_LAST_EDGE) -> DataFrame:
    """(bin, count) for whole years 0..last_edge; the last bin is closed, values outside are left out."""
    bin_ = F.least(F.floor(years), F.lit(last_edge - 1)).cast("int")
    return (
        df.filter(F.col(years).between(0, last_edge)).groupBy(bin_.alias("bin")).agg(F.count("*").alias("count"))
    )


def value_counts(df: DataFrame, column: str, name: str, top_n: int | None = None) -> DataFrame:
    """(name, count), most frequent first, ties by value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias(name)).agg(F.count("*").alias("count"))
    return counts if top_n is None else counts.orderBy(F.desc("count"), name).limit(top_n)


def shares(df: DataFrame, column: str, name: str) -> DataFrame:
    """(name, count, percentage of the counted rows)."""
    counts = value_counts(df, column, name)
    return counts.withColumn("percentage", F.col("count") / counts.agg(F.sum("count")).scalar() * 100)


def group_shares(counts: DataFrame) -> DataFrame:
    """(name, count, percentage within its kind) of a few (kind, name, count) rows."""
    known = counts.filter(F.col("name").isNotNull())
    share = F.col("count") / F.sum("count").over(Window.partitionBy("kind")) * 100
    return known.select("name", "count", share.alias("percentage"))


def with_average_salary(df: DataFrame) -> DataFrame:
    """Rows with both bounds, plus their mean in lakhs."""
    both = df.filter(F.col("salary_min").isNotNull() & F.col("salary_max").isNotNull())
    return both.withColumn("avg_salary", (F.col("salary_min") + F.col("salary_max")) / 2 / LAKH)


def salary_boxplot(df: DataFrame, location: str = "location_normalized", top_n: int = 5) -> DataFrame:
    """Quartiles and whiskers (furthest values within 1.5 IQR) of the salary in the most frequent locations."""
    rows = with_average_salary(df).select(F.col(location).alias("location"), "avg_salary")
    top = value_counts(rows, "location", "location", top_n).select("location")
    rows = rows.join(F.broadcast(top), "location", "left_semi")
    marks = exact_quantiles(rows, "avg_salary", [0.25, 0.5, 0.75], by=["location"])
    at = lambda p: F.max(F.when(F.col("probability") == p, F.col("quantile")))
    boxes = marks.groupBy("location").agg(at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    v = F.col("avg_salary")
    return (
        rows.join(F.broadcast(boxes), "location")
        .groupBy("location")
        .agg(
            F.max("q1").alias("q1"), F.max("median").alias("median"), F.max("q3").alias("q3"),
            F.min(F.when(v >= F.col("q1") - reach, v)).alias("whisker_low"),
            F.max(F.when(v <= F.col("q3") + reach, v)).alias("whisker_high"),
        )
    )


def salary_center(df: DataFrame) -> DataFrame:
    """One row: exact median and mean of the average salary in lakhs."""
    rows = with_average_salary(df)
    median = exact_quantiles(rows, "avg_salary", [0.5]).agg(F.max("quantile")).scalar()
    return rows.agg(F.avg("avg_salary").alias("mean_salary")).withColumn("median_salary", median)


def experience_center(df: DataFrame, years: str = "experience_years") -> DataFrame:
    """One row: median and mean. Years are limited to 0..50, so the exact median keeps few distinct values."""
    return df.agg(F.median(years).alias("median_experience"), F.avg(years).alias("mean_experience"))


def headline(df: DataFrame, location: str = "location_normalized", day: str = "posted_date_parsed") -> DataFrame:
    """One row: postings, distinct skills, distinct locations, first and last day, mean salary."""
    skills = unfold(df, "skills", "skill").agg(F.count_distinct("skill")).scalar()
    return df.agg(
        F.count("*").alias("total_jobs"),
        F.count_distinct(location).alias("unique_locations"),
        F.min(day).alias("first_date"),
        F.max(day).alias("last_date"),
        F.avg((F.col("salary_min") + F.col("salary_max")) / 2).alias("avg_salary"),
    ).withColumn("unique_skills", skills)


def skill_diversity(num_skills: Column, years: Column) -> Column:
    """Skills per year of experience, null without experience."""
    return F.try_divide(num_skills, years)


def with_group_average(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """The mean of a group on each of its rows.

    Aggregate and join rather than a window: the mean folds map-side and a group holding most rows is split by
    adaptive execution instead of being sorted in one task.
    """
    means = df.groupBy(F.col(group).alias("_group")).agg(F.avg(value).alias(name))
    return df.join(means, df[group].eqNullSafe(means["_group"]), "left").drop("_group")


def top_skill_per_location(location_counts: DataFrame) -> DataFrame:
    """(location, max_count, skill): highest skill count of each location and its first skill by name."""
    best = F.min(F.struct((-F.col("count")).alias("c"), F.col("skill").alias("s")))
    return location_counts.groupBy("location").agg(best.alias("b")).select(
        "location", (-F.col("b.c")).alias("max_count"), F.col("b.s").alias("skill")
    )


def growth_between(df: DataFrame, day: str, start: str, end: str) -> DataFrame:
    """One row: postings from ``end`` on against postings before ``start``, and the relative change."""
    after, before = F.count_if(F.col(day) >= F.lit(end).cast("date")), F.count_if(F.col(day) < F.lit(start).cast("date"))
    return df.agg(after.alias("after_end"), before.alias("before_start")).withColumn(
        "growth_rate", F.try_divide(F.col("after_end") - F.col("before_start"), F.col("before_start"))
    )


def skills_by_group(df: DataFrame, group: str, skills: str = "skills", top_n: int | None = None) -> DataFrame:
    """(group, skill, count) for all skills, or for the ``top_n`` most frequent ones overall."""
    cells = unfold(df, skills, "skill", group).groupBy(group, "skill").agg(F.count("*").alias("count"))
    if top_n is None:
        return cells
    top = cells.groupBy("skill").agg(F.sum("count").alias("c")).orderBy(F.desc("c"), "skill").limit(top_n)
    return cells.join(F.broadcast(top.select("skill")), "skill", "left_semi").select(group, "skill", "count")


def share_within(cells: DataFrame, group: str) -> DataFrame:
    """Add the percentage of each cell within its group."""
    total = F.sum("count").over(Window.partitionBy(group))  # over aggregated cells
    return cells.withColumn("percentage", F.col("count") / total * 100)


def top_within(df: DataFrame, group: str, value: str, top_n: int) -> DataFrame:
    """(group, value, count, rank): the most frequent values of each group."""
    counts = df.groupBy(group, value).agg(F.count("*").alias("count"))
    ranked = Window.partitionBy(group).orderBy(F.desc("count"), value)
    return counts.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top_n)


def salary_of_skill(df: DataFrame, skill: str, skills: str = "skills") -> DataFrame:
    """One row: salary range of the postings with a skill."""
    return df.filter(F.array_contains(skills, skill)).agg(
        F.count("*").alias("job_count"),
        F.min("salary_min").alias("lowest"),
        F.avg((F.col("salary_min") + F.col("salary_max")) / 2).alias("average"),
        F.max("salary_max").alias("highest"),
    )


def primary_skill(skills: Column, priority: list[str]) -> Column:
    """First skill of the priority list that the posting has."""
    return F.coalesce(*[F.when(F.array_contains(skills, name), F.lit(name)) for name in priority])


def posting_trend(df: DataFrame, day: str, frequency: str = "monthly") -> DataFrame:
    """(period, ordinal, count, fitted): postings per period with the least-squares line through them.

    Periods are calendar labels, so everything after the first aggregate is a few rows per year.
    """
    counts = (
        df.filter(F.col(day).isNotNull())
        .groupBy(period_label(F.col(day), frequency).alias("period"))
        .agg(F.count("*").alias("count"))
    )
    packed = counts.agg(F.array_sort(F.collect_list(F.struct("period", "count"))).alias("p"))
    series = packed.select(F.posexplode("p").alias("ordinal", "s")).select("ordinal", "s.period", "s.count")
    line = series.agg(
        F.struct(F.regr_slope("count", "ordinal").alias("b"), F.regr_intercept("count", "ordinal").alias("a"))
    ).scalar()
    return series.withColumn("fitted", F.coalesce(line["a"] + line["b"] * F.col("ordinal"), F.col("count")))
