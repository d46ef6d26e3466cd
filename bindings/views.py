"""Stand-ins for postings, skills and texts, built over the driver's tables as a whole.

Each view exists twice: as a DataFrame function and as a SQL common table expression of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobgrain.functions.text import TOKEN_PATTERN
from jobgrain.operators import cooccurrence as co
from jobgrain.operators import geography as geo

# Places of the stand-in postings.
TIERS = {"Tier-1": [f"Nation_{i}" for i in range(8)], "Tier-2": [f"Nation_{i}" for i in range(8, 20)]}
REGIONS = {
    "North": [f"Nation_{i}" for i in range(5)],
    "South": [f"Nation_{i}" for i in range(5, 10)],
    "West": [f"Nation_{i}" for i in range(10, 14)],
    "East": [f"Nation_{i}" for i in range(14, 17)],
    "Central": [f"Nation_{i}" for i in range(17, 20)],
}

# Lexicon for the texts of ``documents``: words that occur there, one phrase nested in another.
LEXICON = [
    ("The", "Technical", "Article", "the"),
    ("Of The", "Technical", "Article", "of the"),
    ("Attion", "Technical", "Noun", "and attion to"),
    ("Que", "Soft", "Romance", "que,les"),
    ("Und", "Soft", "Germanic", "und,der"),
    ("License", "Technical", "Legal", "license,mit,apache,mit license"),
]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def mention_rows(spark: SparkSession, sf: str) -> DataFrame:
    """(job_id, skill) with repeats: brands of an order's parts."""
    parts = table(spark, sf, "part").select("p_partkey", "p_brand")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("job_id"), F.col("p_brand").alias("skill")
    )


def baskets(spark: SparkSession, sf: str) -> DataFrame:
    """(job_id, skills) for every order, also those without lines."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("job_id"))
    return co.collect_baskets(orders, mention_rows(spark, sf))


def dated(spark: SparkSession, sf: str) -> DataFrame:
    """(job_id, posted_date, skills)."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("job_id"), F.col("o_orderdate").cast("date").alias("posted_date")
    )
    sets = mention_rows(spark, sf).groupBy("job_id").agg(F.array_sort(F.collect_set("skill")).alias("skills"))
    return orders.join(sets, "job_id", "left").withColumn(
        "skills", F.coalesce("skills", F.array().cast("array<string>"))
    )


def jobs(spark: SparkSession, sf: str) -> DataFrame:
    """Postings: orders with the customer's place. Some places and some lower salary bounds are unknown."""
    orders = table(spark, sf, "orders")
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    key = F.col("o_orderkey")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias("job_id"),
            F.col("o_orderpriority").alias("title"),
            F.col("c_name").alias("company"),
            F.when(key % 50 != 0, F.col("n_name")).alias("location"),
            F.col("o_orderdate").cast("date").alias("posted_date"),
            F.when(key % 40 != 7, 0.8 * F.col("o_totalprice")).alias("salary_min"),
            (1.2 * F.col("o_totalprice")).alias("salary_max"),
            (key % 11).cast("int").alias("experience_years"),
        )
    )


def places(spark: SparkSession, sf: str) -> DataFrame:
    """Postings with tier and region."""
    return geo.enrich_locations(jobs(spark, sf), "location", TIERS, REGIONS)


def jobs_skills(spark: SparkSession, sf: str) -> DataFrame:
    """Postings with place, ``skills`` and ``num_skills``."""
    sets = mention_rows(spark, sf).groupBy("job_id").agg(F.array_sort(F.collect_set("skill")).alias("skills"))
    return (
        places(spark, sf)
        .join(sets, "job_id", "left")
        .withColumn("skills", F.coalesce("skills", F.array().cast("array<string>")))
        .withColumn("num_skills", F.size("skills"))
    )


def daily_counts(spark: SparkSession, sf: str) -> DataFrame:
    """(period, skill, count) from the event stream: days, and event types of five user groups."""
    events = table(spark, sf, "events")
    return (
        events.select(
            F.date_format("ts", "yyyy-MM-dd").alias("period"),
            F.concat("event_type", (F.col("user_id") % 5).cast("string")).alias("skill"),
        )
        .groupBy("period", "skill")
        .agg(F.count("*").alias("count"))
    )


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        LEXICON, "skill_name string, category string, subcategory string, aliases string"
    )


def part_lexicon(spark: SparkSession, sf: str) -> DataFrame:
    """A lexicon that grows with the data: brand and type as name, size class as category, a row per part name as alias."""
    return table(spark, sf, "part").select(
        F.concat_ws(" ", "p_brand", "p_type").alias("skill_name"),
        F.when(F.col("p_type") == "ECONOMY", "Soft").otherwise("Technical").alias("category"),
        F.col("p_type").alias("subcategory"), F.col("p_name").alias("aliases"),
    )


def rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _groups_sql(column: str, groups: dict[str, list[str]]) -> str:
    cases = " ".join(
        f"WHEN lower({column}) IN ({', '.join(repr(c.lower()) for c in cities)}) THEN '{g}'" for g, cities in groups.items()
    )
    return f"CASE WHEN {column} IS NULL THEN 'Unknown' {cases} ELSE 'Other' END"


def _phrases_sql() -> str:
    rows = []
    for name, category, subcategory, aliases in LEXICON:
        for phrase in dict.fromkeys([name.lower(), *aliases.split(",")]):
            rows.append(f"('{name.lower()}', '{category}', '{subcategory}', '{phrase}')")
    return ", ".join(rows)


CTE = {
    "mentions": "SELECT DISTINCT l_orderkey AS job_id, p_brand AS skill FROM lineitem JOIN part ON l_partkey = p_partkey",
    "n_jobs": "SELECT count(*) AS n FROM orders",
    "counts": "SELECT skill, count(*) AS c FROM mentions GROUP BY skill",
    "pairs": "SELECT a.skill AS skill1, b.skill AS skill2, count(*) AS n12 FROM mentions a JOIN mentions b "
             "ON a.job_id = b.job_id AND a.skill < b.skill GROUP BY 1, 2",
    "assoc": "SELECT skill1, skill2, n12 AS cooccurrence_count, n12::DOUBLE / n AS support, "
             "n12::DOUBLE / c1.c AS confidence_1_to_2, n12::DOUBLE / c2.c AS confidence_2_to_1, "
             "n12::DOUBLE * n / (c1.c::DOUBLE * c2.c) AS lift, c1.c AS skill1_count, c2.c AS skill2_count "
             "FROM pairs JOIN counts c1 ON c1.skill = skill1 JOIN counts c2 ON c2.skill = skill2, n_jobs",
    "assoc_f": "SELECT * FROM assoc WHERE support >= 0.02",
    "edges": "SELECT skill1, skill2, cooccurrence_count AS weight, lift, support, "
             "greatest(confidence_1_to_2, confidence_2_to_1) AS confidence, skill1_count, skill2_count "
             "FROM assoc_f ORDER BY lift DESC, skill1, skill2 LIMIT 100",
    "adj": "SELECT skill1 AS src, skill2 AS dst, weight FROM edges UNION ALL SELECT skill2, skill1, weight FROM edges",
    "jobs0": "SELECT o_orderkey AS job_id, o_orderpriority AS title, c_name AS company, "
             "CASE WHEN o_orderkey % 50 <> 0 THEN n_name END AS location, CAST(o_orderdate AS DATE) AS posted_date, "
             "CASE WHEN o_orderkey % 40 <> 7 THEN 0.8::DOUBLE * o_totalprice END AS salary_min, "
             "1.2::DOUBLE * o_totalprice AS salary_max, CAST(o_orderkey % 11 AS INTEGER) AS experience_years "
             "FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey",
    "jobs": f"SELECT *, {_groups_sql('location', TIERS)} AS city_tier, {_groups_sql('location', REGIONS)} AS region FROM jobs0",
    "sizes": "SELECT job_id, count(*) AS k FROM mentions GROUP BY job_id",
    "jobs_skills": "SELECT jobs.*, CAST(coalesce(k, 0) AS INTEGER) AS num_skills FROM jobs LEFT JOIN sizes USING (job_id)",
    "dated": "SELECT o_orderkey AS job_id, CAST(o_orderdate AS DATE) AS posted_date FROM orders",
    "monthly": "SELECT strftime(posted_date, '%Y-%m') AS period, skill, count(*) AS c FROM mentions JOIN dated USING (job_id) GROUP BY 1, 2",
    "quarterly": "SELECT year(posted_date) || 'Q' || quarter(posted_date) AS period, skill, count(*) AS c "
                 "FROM mentions JOIN dated USING (job_id) GROUP BY 1, 2",
    "daily": "SELECT strftime(ts, '%Y-%m-%d') AS period, event_type || (user_id % 5) AS skill, count(*) AS c FROM events GROUP BY 1, 2",
    "phrases": "SELECT * FROM (VALUES " + _phrases_sql() + ") v(skill, category, subcategory, phrase)",
    "toks": f"SELECT doc_id, regexp_extract_all(lower(text), '{TOKEN_PATTERN}') AS t FROM documents",
    "words": "SELECT doc_id, i, w, lead(w) OVER d AS w2, lead(w, 2) OVER d AS w3 FROM "
             "(SELECT doc_id, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM toks) WINDOW d AS (PARTITION BY doc_id ORDER BY i)",
    "grams": "SELECT doc_id, i, 1 AS n, w AS phrase FROM words UNION ALL "
             "SELECT doc_id, i, 2, w || ' ' || w2 FROM words WHERE w2 IS NOT NULL UNION ALL "
             "SELECT doc_id, i, 3, w || ' ' || w2 || ' ' || w3 FROM words WHERE w3 IS NOT NULL",
    "hits": "SELECT doc_id, i, n, skill, category, subcategory, phrase FROM grams JOIN phrases USING (phrase)",
    "doc_skills": "SELECT DISTINCT doc_id, skill FROM hits",
}

_NEEDS = {
    "counts": ["mentions"], "pairs": ["mentions"], "assoc": ["pairs", "counts", "n_jobs"], "assoc_f": ["assoc"],
    "edges": ["assoc_f"], "adj": ["edges"], "jobs": ["jobs0"], "sizes": ["mentions"], "jobs_skills": ["jobs", "sizes"],
    "monthly": ["mentions", "dated"], "quarterly": ["mentions", "dated"], "words": ["toks"], "grams": ["words"],
    "hits": ["grams", "phrases"], "doc_skills": ["hits"],
}


def sql(names: str, body: str, **extra: str) -> str:
    """A query over the named views and what they build on; ``extra`` adds views of its own."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    parts = [f"{n} AS ({CTE[n]})" for n in ordered] + [f"{n} AS ({b})" for n, b in extra.items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + body


def grid_sql(source: str) -> str:
    """Zero-filled grid over a (period, skill, c) view."""
    return (
        f"SELECT p.period, s.skill, coalesce(c, 0) AS c, row_number() OVER (PARTITION BY s.skill ORDER BY p.period) - 1 AS x, "
        f"count(*) OVER (PARTITION BY s.skill) AS np FROM (SELECT DISTINCT period FROM {source}) p "
        f"CROSS JOIN (SELECT DISTINCT skill FROM {source}) s LEFT JOIN {source} USING (period, skill)"
    )


