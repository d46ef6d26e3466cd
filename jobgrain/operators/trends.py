"""Skill mentions over time: counts, growth, anomalies.

The zero-filled grid (every period that has a mention x every skill) is only built where it is the result. Growth and
anomalies come from the non-zero cells and the number of periods, which give the same sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobgrain.functions.arrays import unfold
from jobgrain.functions.dates import period_label
from jobgrain.operators.cooccurrence import all_pairs, split_skills

# Thresholds of direction, growth, data volume and anomaly, and the list lengths.
SLOPE_LIMIT = 0.1
GROWTH_LIMIT = 0.2
MIN_MENTIONS = 5
Z_LIMIT = 2.0
EDGE_PERIODS = 3
TOP_TRENDS = 20

_PERIOD_BLOCK = 4_096


def mentions(df: DataFrame, frequency: str = "monthly", date_column: str = "posted_date_parsed",
             skills_column: str = "extracted_skills") -> DataFrame:
    """(period, skill), one row per mention of postings with a valid date; repeats within a posting stay."""
    dated = df.filter(F.col(date_column).isNotNull())
    is_array = df.schema[skills_column].dataType.typeName() == "array"
    skills = F.col(skills_column) if is_array else split_skills(skills_column)
    return unfold(dated, skills, "skill", period_label(F.col(date_column), frequency).alias("period"))


def trend_counts(mention_df: DataFrame) -> DataFrame:
    """Mentions per period and skill; cells without a mention are absent."""
    return mention_df.groupBy("period", "skill").agg(F.count("*").alias("count"))


def trend_grid(counts: DataFrame) -> DataFrame:
    """(period, skill, count) with zeros for every period that has any mention."""
    periods = counts.select("period").distinct()
    skills = counts.select("skill").distinct()
    cells = all_pairs(skills, "skill", periods, "period", _PERIOD_BLOCK).toDF("skill", "period")
    zero = F.lit(0).cast("bigint")
    return (
        counts.select("period", "skill", "count")
        .unionByName(cells.select("period", "skill", zero.alias("count")))
        .groupBy("period", "skill")
        .agg(F.sum("count").alias("count"))
    )


def wide_grid(counts: DataFrame, skills: list[str]) -> DataFrame:
    """One row per period and one column per listed skill, for a file sink."""
    return counts.groupBy("period").pivot("skill", skills).agg(F.sum("count")).na.fill(0).orderBy("period")


def long_grid(wide: DataFrame) -> DataFrame:
    """(period, skill, count) back from a wide table."""
    return wide.unpivot("period", [c for c in wide.columns if c != "period"], "skill", "count")


def _period_order(counts: DataFrame) -> DataFrame:
    """(period, ordinal from 0, number of all periods). Periods are calendar labels, a few per year of data."""
    periods = counts.agg(F.array_sort(F.collect_set("period")).alias("p"))
    return periods.select(F.posexplode("p").alias("ordinal", "period"), F.size("p").cast("bigint").alias("_n"))


def _spread_parts(count: Column) -> list[Column]:
    """What the non-zero cells tell about the spread, in double and without squaring a count."""
    return [F.count("*").alias("_k"), F.avg(count).alias("_m"), F.var_pop(count.cast("double")).alias("_v")]


def _squared_deviations(total: Column, n: Column) -> Column:
    """Squared deviations over all ``n`` cells: those of the non-zero ones joined with ``n - k`` zeros."""
    k, m = F.col("_k"), F.col("_m")
    mean = total / n
    return k * F.col("_v") + k * (m - mean) * (m - mean) + (n - k) * mean * mean


def growth_metrics(counts: DataFrame) -> DataFrame:
    """Totals, spread, growth, least-squares slope and direction per skill over all periods.

    With P periods numbered 0..P-1 the zero cells add nothing to any sum, so one aggregate over the non-zero cells
    gives the measures of the full grid.
    """
    order = _period_order(counts)
    # The number of periods comes along with their order, so the counts are read twice in all.
    n, y, x = F.col("_n"), F.col("count"), F.col("ordinal")
    edge = F.least(n, F.lit(EDGE_PERIODS))
    sums = (
        counts.join(F.broadcast(order), "period")
        .groupBy("skill")
        .agg(
            F.sum(y).alias("total_mentions"),
            F.max("_n").alias("_n"),
            *_spread_parts(y),
            F.sum(x * y).alias("_xy"),
            F.sum(F.when(x < EDGE_PERIODS, y).otherwise(0)).alias("_first"),
            F.sum(F.when(x >= n - EDGE_PERIODS, y).otherwise(0)).alias("_last"),
        )
        .filter(F.col("total_mentions") > 0)
    )
    total, first, last = F.col("total_mentions"), F.col("first_period_avg"), F.col("last_period_avg")
    mean, std, slope = F.col("mean_per_period"), F.col("std_per_period"), F.col("trend_slope")
    spread = F.try_divide(_squared_deviations(total, n), n - 1)
    # Over 0..P-1 the mean is (P-1)/2 and the sum of squared deviations P(P^2-1)/12.
    slope_sum = F.col("_xy") - total * ((n - 1) / 2)
    return (
        sums.withColumns(
            {
                "mean_per_period": total / n,
                "std_per_period": F.when(n > 1, F.sqrt(spread)),
                "first_period_avg": F.col("_first") / edge,
                "last_period_avg": F.col("_last") / edge,
                "trend_slope": F.coalesce(F.try_divide(slope_sum * 12, (n * (n * n - 1)).cast("double")), F.lit(0.0)),
            }
        )
        .withColumns(
            {
                "growth_rate": F.when(first > 0, (last - first) / first).otherwise(0.0),
                "trend_direction": F.when(slope > SLOPE_LIMIT, "increasing")
                .when(slope < -SLOPE_LIMIT, "decreasing")
                .otherwise("stable"),
                "volatility_cv": F.when(mean > 0, std / mean).otherwise(0.0),
            }
        )
        .select(
            "skill", "total_mentions", "mean_per_period", "std_per_period", "growth_rate", "trend_slope",
            "trend_direction", "volatility_cv", "first_period_avg", "last_period_avg",
        )
    )


def emerging(growth: DataFrame, top_n: int = TOP_TRENDS) -> DataFrame:
    """Growing skills with enough mentions, strongest first."""
    return (
        growth.filter(
            (F.col("total_mentions") >= MIN_MENTIONS)
            & (F.col("growth_rate") > GROWTH_LIMIT)
            & (F.col("trend_direction") == "increasing")
        )
        .orderBy(F.desc("growth_rate"), "skill")
        .limit(top_n)
    )


def declining(growth: DataFrame, top_n: int = TOP_TRENDS) -> DataFrame:
    """Shrinking skills with enough mentions, strongest last; the strongest ``top_n`` are kept."""
    return (
        growth.filter(
            (F.col("total_mentions") >= MIN_MENTIONS)
            & (F.col("growth_rate") < -GROWTH_LIMIT)
            & (F.col("trend_direction") == "decreasing")
        )
        .orderBy("growth_rate", F.desc("skill"))
        .limit(top_n)
        .orderBy(F.desc("growth_rate"), "skill")
    )


def anomalies(counts: DataFrame, threshold: float = Z_LIMIT) -> DataFrame:
    """Cells of the grid further than ``threshold`` standard deviations from their skill's mean.

    Cells without mentions can only qualify when mean / deviation exceeds the threshold, so missing periods are
    unfolded for those skills alone.
    """
    periods = counts.agg(F.array_sort(F.collect_set("period"))).scalar()
    n = F.size("_periods")
    totals = counts.groupBy("skill").agg(
        F.sum("count").alias("_y"),
        *_spread_parts(F.col("count")),
        F.collect_set("period").alias("_present"),
    )
    spread = F.try_divide(_squared_deviations(F.col("_y"), n), n - 1)
    stats = (
        totals.filter(F.col("_y") >= MIN_MENTIONS)
        .withColumn("_periods", periods)
        .withColumns({"mean": F.col("_y") / n, "_std": F.sqrt(spread)})
        .filter(F.col("_std") > 0)
    )
    missing = stats.filter(F.col("mean") / F.col("_std") > threshold).select(
        "skill",
        F.explode(F.array_except("_periods", F.col("_present"))).alias("period"),
        F.lit(0).cast("bigint").alias("count"),
        "mean", "_std",
    )
    present = counts.join(stats.select("skill", "mean", "_std"), "skill")
    return (
        present.select("skill", "period", "count", "mean", "_std")
        .unionByName(missing)
        .withColumn("z_score", (F.col("count") - F.col("mean")) / F.col("_std"))
        .filter(F.abs("z_score") > threshold)
        .withColumn("anomaly_type", F.when(F.col("z_score") > 0, "spike").otherwise("drop"))
        .select("skill", "period", "count", "mean", "z_score", "anomaly_type")
    )


def trend_summary(counts: DataFrame) -> DataFrame:
    """One row: periods, skills, mentions, mentions per period (mean, least, most), first and last period."""
    per_period = counts.groupBy("period").agg(F.sum("count").alias("c"))
    skills = counts.agg(F.count_distinct("skill")).scalar()
    return per_period.agg(
        F.count("*").alias("num_periods"),
        F.sum("c").alias("total_skill_mentions"),
        F.avg("c").alias("avg_jobs_per_period"),
        F.min("c").alias("min_jobs_per_period"),
        F.max("c").alias("max_jobs_per_period"),
        F.min("period").alias("date_range_start"),
        F.max("period").alias("date_range_end"),
    ).withColumn("num_skills", skills)


def trend_share(df: DataFrame, frequency: str = "monthly", date_column: str = "posted_date_parsed",
                skills_column: str = "skills") -> DataFrame:
    """(period, skill, count, percentage): share of the period's postings that mention the skill.

    One scan: each posting yields its distinct skills and a null marker that counts the posting itself.
    """
    is_array = df.schema[skills_column].dataType.typeName() == "array"
    skills = F.array_distinct(F.col(skills_column) if is_array else split_skills(skills_column))
    marked = F.array_append(skills, F.lit(None).cast("string"))
    cells = (
        df.filter(F.col(date_column).isNotNull())
        .select(period_label(F.col(date_column), frequency).alias("period"), F.explode_outer(marked).alias("skill"))
        .groupBy("period", "skill")
        .agg(F.count("*").alias("count"))
    )
    postings = F.max(F.when(F.col("skill").isNull(), F.col("count"))).over(Window.partitionBy("period"))
    return (
        cells.withColumn("_postings", postings)
        .filter(F.col("skill").isNotNull())
        .select("period", "skill", "count", (F.col("count") / F.col("_postings") * 100).alias("percentage"))
    )


def top_skill_series(counts: DataFrame, top_n: int = 5) -> DataFrame:
    """Grid rows of the most mentioned skills."""
    top = (
        counts.groupBy("skill").agg(F.sum("count").alias("c")).orderBy(F.desc("c"), "skill").limit(top_n).select("skill")
    )
    periods = F.explode(counts.agg(F.collect_set("period")).scalar())
    cells = top.select("skill", periods.alias("period"))
    return cells.join(counts, ["skill", "period"], "left").select(
        "period", "skill", F.coalesce("count", F.lit(0)).alias("count")
    )


def positive_growth(growth: DataFrame, top_n: int = 10) -> DataFrame:
    return growth.filter(F.col("growth_rate") > 0).orderBy(F.desc("growth_rate"), "skill").limit(top_n)
