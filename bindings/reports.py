"""Chart and dashboard tables over the stand-in postings."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.views import baskets, jobs, jobs_skills, places, rounded, sql
from jobgrain.functions import salary
from jobgrain.operators import extraction, geography as geo, reports, sketches

START, END = "1997-01-01", "2000-01-01"
SKILL = "Brand#7"
PRIORITY = ["Brand#3", "Brand#7", "Brand#11", "Brand#20"]


def _histogram_sql(views: str, source: str) -> str:
    return sql(
        views,
        "SELECT CAST(b AS INTEGER) AS bin, round(lo + step * b, 10) AS lower, round(lo + step * (b + 1), 10) AS upper, count(v) AS count "
        "FROM bounds CROSS JOIN range(20) r(b) LEFT JOIN vals ON least(floor((v - lo) / step), 19) = b GROUP BY b, lo, step",
        vals=source,
        bounds="SELECT min(v) AS lo, (max(v) - min(v)) / 20 AS step FROM vals",
    )


_LAKHS = "SELECT location, (salary_min + salary_max) / 2 / 100000 AS v FROM jobs0 WHERE salary_min IS NOT NULL AND salary_max IS NOT NULL"
_CELLS = "SELECT region, skill, count(*) AS c FROM jobs JOIN mentions USING (job_id) GROUP BY 1, 2"


def _estimated(spark, sf):
    """Sketches by month and place, merged by place, beside the exact counts."""
    postings = places(spark, sf).withColumn("month", F.date_format("posted_date", "yyyy-MM"))
    fine = sketches.distinct_sketches(postings, ["month", "region"], ["company"])
    found = sketches.distinct_estimates(sketches.merge_sketches(fine, ["region"]))
    exact = postings.groupBy("region").agg(F.count_distinct("company").alias("companies"))
    near = F.abs(F.col("distinct_company") - F.col("companies")) <= 0.03 * F.col("companies")
    return found.join(exact, "region").select("region", F.col("rows").alias("postings"), "companies", near.alias("near"))


def _lod_company(spark, sf):
    df = jobs_skills(spark, sf).select("job_id", "company", "num_skills")
    return rounded(reports.with_group_average(df, "company", "num_skills", "avg_skills"), ["avg_skills"]).drop("num_skills")


def _lod_location_skill(spark, sf):
    return reports.top_skill_per_location(geo.location_skill_counts(jobs_skills(spark, sf), "location", "skills"))


def _headline(spark, sf):
    return rounded(reports.headline(jobs_skills(spark, sf), "location", "posted_date"), ["avg_salary"], 4)


QUERIES = {
    "hist_num_skills": lambda s, d: rounded(
        reports.histogram(baskets(s, d).select(F.size("skills").alias("v")), "v"), ["lower", "upper"], 10
    ),
    "top20_skills": lambda s, d: extraction.top_skills(baskets(s, d), 20),
    "top_locations": lambda s, d: reports.value_counts(jobs(s, d), "location", "location", 10),
    "tier_share": lambda s, d: rounded(
        reports.group_shares(geo.group_counts(places(s, d))), ["percentage"]
    ),
    "hist_salary": lambda s, d: rounded(
        reports.histogram(reports.with_average_salary(jobs(s, d)), "avg_salary"), ["lower", "upper"], 10
    ),
    "salary_boxplot": lambda s, d: rounded(
        reports.salary_boxplot(jobs(s, d), "location"), ["q1", "median", "q3", "whisker_low", "whisker_high"], 10
    ),
    "salary_center": lambda s, d: rounded(reports.salary_center(jobs(s, d)), ["median_salary", "mean_salary"], 10),
    "hist_experience": lambda s, d: reports.experience_histogram(jobs(s, d)),
    "experience_center": lambda s, d: rounded(reports.experience_center(jobs(s, d)), ["mean_experience"]),
    "headline": _headline,
    "top_titles": lambda s, d: reports.value_counts(jobs(s, d), "title", "title", 5),
    "salary_category": lambda s, d: jobs(s, d)
    .groupBy(
        salary.salary_category(salary.average_salary(F.col("salary_min"), F.col("salary_max"))).alias("category")
    )
    .agg(F.count("*").alias("count")),
    "skill_diversity": lambda s, d: jobs_skills(s, d).select(
        "job_id",
        F.round(reports.skill_diversity(F.col("num_skills"), F.col("experience_years")), 6).alias("skill_diversity"),
    ),
    "lod_company": _lod_company,
    "lod_location_skill": _lod_location_skill,
    "param_growth": lambda s, d: rounded(
        reports.growth_between(jobs(s, d), "posted_date", START, END), ["growth_rate"]
    ),
    "region_skill_stack": lambda s, d: reports.skills_by_group(jobs_skills(s, d), "region", top_n=10),
    "companies_estimated": _estimated,
    "companies_by_region": lambda s, d: reports.top_within(places(s, d), "region", "company", 5).withColumn(
        "rank", F.col("rank").cast("bigint")
    ),
    "salary_by_skill": lambda s, d: rounded(
        reports.salary_of_skill(jobs_skills(s, d), SKILL), ["lowest", "average", "highest"], 4
    ),
    "region_skill_share": lambda s, d: rounded(
        reports.share_within(reports.skills_by_group(jobs_skills(s, d), "region"), "region"), ["percentage"]
    ),
    "primary_skill": lambda s, d: baskets(s, d)
    .select(reports.primary_skill(F.col("skills"), PRIORITY).alias("primary_skill"))
    .groupBy("primary_skill")
    .agg(F.count("*").alias("count")),
    "posting_trend": lambda s, d: rounded(reports.posting_trend(jobs(s, d), "posted_date"), ["fitted"]).withColumn(
        "ordinal", F.col("ordinal").cast("bigint")
    ),
}

ORACLE = {
    "hist_num_skills": _histogram_sql(
        "sizes", "SELECT coalesce(k, 0)::DOUBLE AS v FROM orders LEFT JOIN sizes ON job_id = o_orderkey"
    ),
    "top20_skills": sql("counts", "SELECT skill, c AS count FROM counts ORDER BY c DESC, skill LIMIT 20"),
    "top_locations": sql(
        "jobs0",
        "SELECT location, count(*) AS count FROM jobs0 WHERE location IS NOT NULL GROUP BY location ORDER BY 2 DESC, 1 LIMIT 10",
    ),
    "tier_share": sql(
        "jobs",
        "SELECT city_tier AS name, count(*) AS count, round(count(*)::DOUBLE / sum(count(*)) OVER () * 100, 6) AS percentage FROM jobs GROUP BY 1 UNION ALL "
        "SELECT region, count(*), round(count(*)::DOUBLE / sum(count(*)) OVER () * 100, 6) FROM jobs GROUP BY 1",
    ),
    "hist_salary": _histogram_sql("jobs0", _LAKHS),
    "salary_boxplot": sql(
        "jobs0",
        "SELECT location, round(q1, 10) AS q1, round(m, 10) AS median, round(q3, 10) AS q3, "
        "round(min(v) FILTER (v >= q1 - 1.5 * (q3 - q1)), 10) AS whisker_low, round(max(v) FILTER (v <= q3 + 1.5 * (q3 - q1)), 10) AS whisker_high "
        "FROM vals JOIN boxes USING (location) GROUP BY location, q1, m, q3",
        vals=_LAKHS,
        top="SELECT location FROM vals WHERE location IS NOT NULL GROUP BY location ORDER BY count(*) DESC, location LIMIT 5",
        boxes="SELECT location, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS m, quantile_cont(v, 0.75) AS q3 "
        "FROM vals WHERE location IN (SELECT location FROM top) GROUP BY location",
    ),
    "salary_center": sql(
        "jobs0", "SELECT round(quantile_cont(v, 0.5), 10) AS median_salary, round(avg(v), 10) AS mean_salary FROM vals", vals=_LAKHS
    ),
    "hist_experience": sql(
        "jobs0",
        "SELECT CAST(least(experience_years, 9) AS INTEGER) AS bin, count(*) AS count FROM jobs0 WHERE experience_years BETWEEN 0 AND 10 GROUP BY 1",
    ),
    "experience_center": sql(
        "jobs0",
        "SELECT quantile_cont(experience_years::DOUBLE, 0.5) AS median_experience, round(avg(experience_years), 6) AS mean_experience FROM jobs0",
    ),
    "headline": sql(
        "jobs0 mentions",
        "SELECT count(*) AS total_jobs, count(DISTINCT location) AS unique_locations, min(posted_date) AS first_date, max(posted_date) AS last_date, "
        "round(avg((salary_min + salary_max) / 2), 4) AS avg_salary, (SELECT count(DISTINCT skill) FROM mentions) AS unique_skills FROM jobs0",
    ),
    "top_titles": sql("jobs0", "SELECT title, count(*) AS count FROM jobs0 GROUP BY title ORDER BY 2 DESC, 1 LIMIT 5"),
    "salary_category": sql(
        "jobs0",
        "SELECT CASE WHEN a < 500000 THEN 'Entry (<5L)' WHEN a < 1000000 THEN 'Mid (5-10L)' WHEN a < 1500000 THEN 'Senior (10-15L)' "
        "ELSE 'Expert (>15L)' END AS category, count(*) AS count FROM (SELECT (salary_min + salary_max) / 2 AS a FROM jobs0) q GROUP BY 1",
    ),
    "skill_diversity": sql(
        "jobs_skills",
        "SELECT job_id, CASE WHEN experience_years <> 0 THEN round(num_skills::DOUBLE / experience_years, 6) END AS skill_diversity FROM jobs_skills",
    ),
    "lod_company": sql(
        "jobs_skills", "SELECT job_id, company, round(avg(num_skills) OVER (PARTITION BY company), 6) AS avg_skills FROM jobs_skills"
    ),
    "lod_location_skill": sql(
        "jobs0 mentions",
        "SELECT location, c AS max_count, skill FROM cells QUALIFY row_number() OVER (PARTITION BY location ORDER BY c DESC, skill) = 1",
        cells="SELECT location, skill, count(*) AS c FROM jobs0 JOIN mentions USING (job_id) WHERE location IS NOT NULL GROUP BY 1, 2",
    ),
    "param_growth": sql(
        "jobs0",
        "SELECT a AS after_end, b AS before_start, round((a - b)::DOUBLE / b, 6) AS growth_rate FROM (SELECT "
        f"count(*) FILTER (posted_date >= DATE '{END}') AS a, count(*) FILTER (posted_date < DATE '{START}') AS b FROM jobs0) q",
    ),
    "region_skill_stack": sql(
        "jobs mentions",
        "SELECT region, skill, c AS count FROM cells WHERE skill IN (SELECT skill FROM cells GROUP BY skill ORDER BY sum(c) DESC, skill LIMIT 10)",
        cells=_CELLS,
    ),
    "companies_estimated": sql(
        "jobs", "SELECT region, count(*) AS postings, count(DISTINCT company) AS companies, true AS near FROM jobs GROUP BY region"
    ),
    "companies_by_region": sql(
        "jobs",
        "SELECT region, company, count(*) AS count, row_number() OVER (PARTITION BY region ORDER BY count(*) DESC, company) AS rank "
        "FROM jobs GROUP BY region, company QUALIFY rank <= 5",
    ),
    "salary_by_skill": sql(
        "jobs0 mentions",
        "SELECT count(*) AS job_count, round(min(salary_min), 4) AS lowest, round(avg((salary_min + salary_max) / 2), 4) AS average, "
        f"round(max(salary_max), 4) AS highest FROM jobs0 JOIN mentions USING (job_id) WHERE skill = '{SKILL}'",
    ),
    "region_skill_share": sql(
        "jobs mentions",
        "SELECT region, skill, c AS count, round(c::DOUBLE / sum(c) OVER (PARTITION BY region) * 100, 6) AS percentage FROM cells",
        cells=_CELLS,
    ),
    "primary_skill": sql(
        "mentions",
        "SELECT p AS primary_skill, count(*) AS count FROM (SELECT o_orderkey, CASE "
        + " ".join(f"WHEN bool_or(skill = '{p}') THEN '{p}'" for p in PRIORITY)
        + " END AS p FROM orders LEFT JOIN mentions ON job_id = o_orderkey GROUP BY o_orderkey) q GROUP BY p",
    ),
    "posting_trend": sql(
        "jobs0",
        "SELECT period, x AS ordinal, c AS count, round(regr_intercept(c, x) OVER () + regr_slope(c, x) OVER () * x, 6) AS fitted FROM numbered",
        numbered="SELECT strftime(posted_date, '%Y-%m') AS period, count(*) AS c, row_number() OVER (ORDER BY strftime(posted_date, '%Y-%m')) - 1 AS x FROM jobs0 GROUP BY 1",
    ),
}
