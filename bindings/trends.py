"""Trends over order dates and over the event stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.views import daily_counts, dated, grid_sql, rounded, sql
from jobgrain.operators import trends
from jobgrain.session import cut_lineage

GROWTH_ROUND = [
    "mean_per_period", "std_per_period", "growth_rate", "trend_slope", "volatility_cv", "first_period_avg",
    "last_period_avg",
]


def _counts(spark, sf, frequency="monthly"):
    """Counts that several aggregates read: a few rows per period, worked out once."""
    return cut_lineage(_lazy_counts(spark, sf, frequency))


def _daily(spark, sf):
    return cut_lineage(daily_counts(spark, sf))


def _lazy_counts(spark, sf, frequency="monthly"):
    return trends.trend_counts(trends.mentions(dated(spark, sf), frequency, "posted_date", "skills"))


def _growth_sql(source: str, tail: str) -> str:
    columns = ", ".join(
        f"round({c}, 6) AS {c}" if c in GROWTH_ROUND else c
        for c in (
            "skill", "total_mentions", "mean_per_period", "std_per_period", "growth_rate", "trend_slope",
            "trend_direction", "volatility_cv", "first_period_avg", "last_period_avg",
        )
    )
    return sql(
        source,
        f"SELECT {columns} FROM growth {tail}",
        grid=grid_sql(source),
        stats="SELECT skill, CAST(sum(c) AS BIGINT) AS total_mentions, avg(c) AS mean_per_period, "
        "stddev_samp(c) AS std_per_period, avg(c) FILTER (x < 3) AS first_period_avg, "
        "avg(c) FILTER (x >= np - 3) AS last_period_avg, coalesce(regr_slope(c, x), 0) AS trend_slope "
        "FROM grid GROUP BY skill",
        growth="SELECT *, CASE WHEN first_period_avg > 0 THEN (last_period_avg - first_period_avg) / first_period_avg "
        "ELSE 0 END AS growth_rate, CASE WHEN trend_slope > 0.1 THEN 'increasing' WHEN trend_slope < -0.1 THEN "
        "'decreasing' ELSE 'stable' END AS trend_direction, std_per_period / mean_per_period AS volatility_cv FROM stats",
    )


def _anomaly_sql(source: str) -> str:
    return sql(
        source,
        "SELECT skill, period, c AS count, round(m, 6) AS mean, round((c - m) / s, 6) AS z_score, "
        "CASE WHEN c > m THEN 'spike' ELSE 'drop' END AS anomaly_type FROM z "
        "WHERE t >= 5 AND s > 0 AND abs((c - m) / s) > 2.0",
        grid=grid_sql(source),
        z="SELECT skill, period, c, avg(c) OVER w AS m, stddev_samp(c) OVER w AS s, sum(c) OVER w AS t FROM grid "
        "WINDOW w AS (PARTITION BY skill)",
    )


def _anomalies(counts):
    return rounded(trends.anomalies(counts), ["mean", "z_score"])


_EMERGING = "WHERE total_mentions >= 5 AND growth_rate > 0.2 AND trend_direction = 'increasing' ORDER BY growth.growth_rate DESC, skill LIMIT 20"
_DECLINING = "WHERE total_mentions >= 5 AND growth_rate < -0.2 AND trend_direction = 'decreasing' ORDER BY growth.growth_rate, skill DESC LIMIT 20"
_GRID_MONTHLY = sql("monthly", "SELECT period, skill, c AS count FROM grid", grid=grid_sql("monthly"))

QUERIES = {
    "mentions": lambda s, d: trends.mentions(dated(s, d), "monthly", "posted_date", "skills"),
    "trend_monthly": lambda s, d: _lazy_counts(s, d),
    "trend_quarterly": lambda s, d: _lazy_counts(s, d, "quarterly"),
    "trend_grid": lambda s, d: trends.trend_grid(_counts(s, d)),
    "trend_long": lambda s, d: _trend_long(s, d),
    "growth_metrics": lambda s, d: rounded(trends.growth_metrics(_counts(s, d, "quarterly")), GROWTH_ROUND),
    "emerging": lambda s, d: rounded(trends.emerging(trends.growth_metrics(_daily(s, d))), GROWTH_ROUND),
    "declining": lambda s, d: rounded(
        trends.declining(trends.growth_metrics(_counts(s, d, "quarterly"))), GROWTH_ROUND
    ),
    "anomalies": lambda s, d: _anomalies(_counts(s, d)),
    "anomalies_daily": lambda s, d: _anomalies(_daily(s, d)),
    "trend_summary": lambda s, d: rounded(trends.trend_summary(_counts(s, d)), ["avg_jobs_per_period"]),
    "trend_share": lambda s, d: rounded(
        trends.trend_share(dated(s, d), "monthly", "posted_date", "skills"), ["percentage"]
    ),
    "top5_trends": lambda s, d: trends.top_skill_series(_counts(s, d), 5),
    "positive_growth": lambda s, d: trends.positive_growth(
        trends.growth_metrics(_daily(s, d))
    ).select("skill", F.round("growth_rate", 6).alias("growth_rate"), "total_mentions"),
}


def _trend_long(spark, sf):
    """Long rows of all skills, however many there are; the wide form is for file sinks with a chosen list."""
    return trends.trend_grid(_counts(spark, sf))


ORACLE = {
    "mentions": sql(
        "mentions dated", "SELECT strftime(posted_date, '%Y-%m') AS period, skill FROM mentions JOIN dated USING (job_id)"
    ),
    "trend_monthly": sql("monthly", "SELECT period, skill, c AS count FROM monthly"),
    "trend_quarterly": sql("quarterly", "SELECT period, skill, c AS count FROM quarterly"),
    "trend_grid": _GRID_MONTHLY,
    "trend_long": _GRID_MONTHLY,
    "growth_metrics": _growth_sql("quarterly", ""),
    "emerging": _growth_sql("daily", _EMERGING),
    "declining": _growth_sql("quarterly", _DECLINING),
    "anomalies": _anomaly_sql("monthly"),
    "anomalies_daily": _anomaly_sql("daily"),
    "trend_summary": sql(
        "monthly",
        "SELECT count(*) AS num_periods, CAST(sum(t) AS BIGINT) AS total_skill_mentions, round(avg(t), 6) AS avg_jobs_per_period, "
        "CAST(min(t) AS BIGINT) AS min_jobs_per_period, CAST(max(t) AS BIGINT) AS max_jobs_per_period, "
        "min(period) AS date_range_start, max(period) AS date_range_end, "
        "(SELECT count(DISTINCT skill) FROM monthly) AS num_skills FROM per",
        per="SELECT period, sum(c) AS t FROM monthly GROUP BY period",
    ),
    "trend_share": sql(
        "monthly dated",
        "SELECT period, skill, c AS count, round(c::DOUBLE / n * 100, 6) AS percentage FROM monthly JOIN per USING (period)",
        per="SELECT strftime(posted_date, '%Y-%m') AS period, count(*) AS n FROM dated GROUP BY 1",
    ),
    "top5_trends": sql(
        "monthly",
        "SELECT period, skill, c AS count FROM grid WHERE skill IN (SELECT skill FROM monthly GROUP BY skill "
        "ORDER BY sum(c) DESC, skill LIMIT 5)",
        grid=grid_sql("monthly"),
    ),
    "positive_growth": _growth_sql(
        "daily", "WHERE growth_rate > 0 ORDER BY growth.growth_rate DESC, skill LIMIT 10"
    ).replace("SELECT skill, total_mentions, round(mean_per_period", "SELECT skill, total_mentions, growth_rate FROM (SELECT skill, total_mentions, round(mean_per_period", 1) + ")",
}
