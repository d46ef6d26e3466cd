"""Places, regional exports and measures over the stand-in postings."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.views import REGIONS, TIERS, jobs, jobs_skills, places, rounded, sql
from jobgrain.functions.dates import add_date_parts
from jobgrain.operators import extraction, geography as geo
from jobgrain.session import shared_path
from jobgrain.sources import sinks

_MEANS = ["avg_skills", "avg_salary_min", "avg_salary_max", "avg_experience"]
_MEANS_SQL = (
    "count(job_id) AS job_count, round(avg(num_skills), 4) AS avg_skills, round(avg(salary_min), 4) AS avg_salary_min, "
    "round(avg(salary_max), 4) AS avg_salary_max, round(avg(experience_years), 4) AS avg_experience"
)


def _means(df):
    return rounded(df, _MEANS, 4)


def _location_stats(spark, sf):
    return _means(geo.location_stats(jobs_skills(spark, sf), "location", TIERS, REGIONS))


def _exported(spark, sf):
    """Cleaned postings with skills, flags and places, in the column names the exports expect."""
    df = jobs_skills(spark, sf).withColumn("posted_date_parsed", F.col("posted_date"))
    df = extraction.add_skill_flags(add_date_parts(df)).drop("skills", "posted_date_parsed")
    return df.withColumnRenamed("location", "location_normalized")


def _export_sql(columns: str) -> str:
    brands = [f"Brand#{i}" for i in range(1, 26)]
    flags = ", ".join(f"coalesce(list_contains(b, '{b}'), false) AS \"has_{b.lower()}\"" for b in brands)
    return sql(
        "jobs_skills mentions", f"SELECT {columns}, {flags} FROM jobs_skills LEFT JOIN lists USING (job_id)",
        lists="SELECT job_id, list(skill) AS b FROM mentions GROUP BY job_id",
    )


def _main(spark, sf):
    df = _exported(spark, sf).withColumnsRenamed({"title": "title_normalized"}).withColumn("job_type", F.lit("Full-time"))
    return _money(sinks.main_export(df))


def _money(df):
    return rounded(df, ["salary_min", "salary_max"], 4)


def _regional(spark, sf):
    """Written one folder per region, read back and counted."""
    path = shared_path(spark, "regions")
    sinks.write_regional(places(spark, sf), path, "parquet")
    return spark.read.parquet(path).groupBy("region").agg(
        F.count("*").alias("postings"), F.sum("job_id").alias("id_sum")
    )


def _late_batch(spark, sf):
    """Regions written, then two of them replaced by a later batch, read back and counted with the batch that wrote them."""
    path = shared_path(spark, "regions")
    postings = places(spark, sf)
    sinks.replace_regions(postings, path, 1, "parquet")
    late = postings.filter(F.col("region").isin("South", "West") & (F.col("experience_years") > 4))
    manifest = sinks.replace_regions(late, path, 2, "parquet")
    held = spark.read.parquet(path).groupBy("region").agg(F.count("*").alias("postings"), F.sum("job_id").alias("id_sum"))
    return held.join(manifest, "region")


def _write_table(spark, sf):
    """Postings through a CSV file and back, nulls and types kept."""
    df = places(spark, sf).select("job_id", "title", "company", "location", "posted_date", "experience_years")
    path = shared_path(spark, "table")
    sinks.write_table(df, path, "csv")
    return spark.read.options(**sinks.csv_options()).schema(df.schema).csv(path)


_LOCATION_SKILLS = {
    "cells": "SELECT location, skill, count(*) AS c FROM jobs0 JOIN mentions USING (job_id) WHERE location IS NOT NULL GROUP BY 1, 2",
    "sums": "SELECT location, count(*) AS n FROM jobs0 WHERE location IS NOT NULL GROUP BY 1",
    "ranked": "SELECT *, row_number() OVER (PARTITION BY location ORDER BY c DESC, skill) AS rank FROM cells JOIN sums USING (location)",
}

_DATE_PARTS_SQL = (
    "CAST(year(posted_date) AS INTEGER) AS year, CAST(month(posted_date) AS INTEGER) AS month"
)
_MONEY_SQL = "round(salary_min, 4) AS salary_min, round(salary_max, 4) AS salary_max, experience_years, num_skills"

QUERIES = {
    "city_tier": lambda s, d: jobs(s, d).select(
        "job_id", "location", geo.classify(F.col("location"), TIERS).alias("city_tier")
    ),
    "city_region": lambda s, d: jobs(s, d).select(
        "job_id", "location", geo.classify(F.col("location"), REGIONS).alias("region")
    ),
    "tier_region_counts": lambda s, d: geo.group_counts(places(s, d)),
    "location_stats": _location_stats,
    "tier_stats": lambda s, d: _means(geo.tier_stats(jobs_skills(s, d))),
    "region_stats": lambda s, d: _means(geo.region_stats(jobs_skills(s, d))),
    "geo_grouping_sets": lambda s, d: _means(geo.geo_grouping_sets(jobs_skills(s, d), "location")),
    "skills_by_location": lambda s, d: rounded(
        geo.skills_by_location(jobs_skills(s, d), "location", "skills"), ["percentage"]
    ).withColumn("rank", F.col("rank").cast("bigint")),
    "city_card": lambda s, d: geo.city_cards(jobs_skills(s, d), "location", "skills"),
    "bi_geographic": lambda s, d: _money(sinks.geographic_export(_exported(s, d))),
    "bi_main": _main,
    "regional_partitions": _regional,
    "regional_late_batch": _late_batch,
    "write_table": _write_table,
}

ORACLE = {
    "city_tier": sql("jobs", "SELECT job_id, location, city_tier FROM jobs"),
    "city_region": sql("jobs", "SELECT job_id, location, region FROM jobs"),
    "tier_region_counts": sql(
        "jobs",
        "SELECT 'tier' AS kind, city_tier AS name, count(*) AS count FROM jobs GROUP BY 2 UNION ALL "
        "SELECT 'region', region, count(*) FROM jobs GROUP BY 2",
    ),
    "location_stats": sql(
        "jobs_skills",
        f"SELECT location, {_MEANS_SQL}, any_value(city_tier) AS tier, any_value(region) AS region FROM jobs_skills "
        "WHERE location IS NOT NULL GROUP BY location",
    ),
    "tier_stats": sql("jobs_skills", f"SELECT city_tier AS tier, {_MEANS_SQL} FROM jobs_skills GROUP BY city_tier"),
    "region_stats": sql("jobs_skills", f"SELECT region, {_MEANS_SQL} FROM jobs_skills GROUP BY region"),
    "geo_grouping_sets": sql(
        "jobs_skills",
        f"SELECT 'location' AS level, location AS name, {_MEANS_SQL} FROM jobs_skills WHERE location IS NOT NULL GROUP BY 2 UNION ALL "
        f"SELECT 'tier', city_tier, {_MEANS_SQL} FROM jobs_skills GROUP BY 2 UNION ALL "
        f"SELECT 'region', region, {_MEANS_SQL} FROM jobs_skills GROUP BY 2",
    ),
    "skills_by_location": sql(
        "jobs0 mentions",
        "SELECT location, skill, c AS count, round(c::DOUBLE / n * 100, 6) AS percentage, rank FROM ranked WHERE rank <= 20",
        **_LOCATION_SKILLS,
    ),
    "city_card": sql(
        "jobs0 mentions",
        "SELECT location, any_value(n) AS job_count, string_agg(skill, ', ' ORDER BY rank) AS top_skills FROM ranked WHERE rank <= 3 GROUP BY location",
        **_LOCATION_SKILLS,
    ),
    "bi_geographic": _export_sql(
        f"job_id, title, company, location, city_tier, region, posted_date, {_DATE_PARTS_SQL}, {_MONEY_SQL}"
    ),
    "bi_main": _export_sql(
        f"job_id, title, company, location, city_tier, region, posted_date, 'Full-time' AS job_type, {_DATE_PARTS_SQL}, "
        f"'Q' || quarter(posted_date) AS posted_quarter, {_MONEY_SQL}"
    ),
    "regional_partitions": sql(
        "jobs",
        "SELECT lower(region) AS region, count(*) AS postings, CAST(sum(job_id) AS BIGINT) AS id_sum FROM jobs WHERE region <> 'Unknown' GROUP BY 1",
    ),
    "regional_late_batch": sql(
        "jobs",
        "SELECT lower(region) AS region, count(*) AS postings, CAST(sum(job_id) AS BIGINT) AS id_sum, "
        "CAST(any_value(n) AS BIGINT) AS batch, count(*) AS rows FROM kept WHERE region <> 'Unknown' GROUP BY 1",
        kept="SELECT *, CASE WHEN region IN ('South', 'West') THEN 2 ELSE 1 END AS n FROM jobs "
        "WHERE region NOT IN ('South', 'West') OR experience_years > 4",
    ),
    "write_table": sql("jobs0", "SELECT job_id, title, company, location, posted_date, experience_years FROM jobs0"),
}
