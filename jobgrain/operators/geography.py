"""City tiers, regions and measures by place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from jobgrain.functions.text import UNKNOWN
from jobgrain.operators.cooccurrence import split_skills

OTHER = "Other"

# Tier of each known city.
CITY_TIERS = {
    "Tier-1": ["Bangalore", "Mumbai", "Delhi", "Hyderabad", "Chennai", "Kolkata", "Pune", "Ahmedabad"],
    "Tier-2": [
        "Jaipur", "Surat", "Lucknow", "Kanpur", "Nagpur", "Indore", "Thane", "Bhopal", "Visakhapatnam", "Patna",
        "Vadodara", "Ghaziabad", "Ludhiana", "Coimbatore", "Kochi", "Gurgaon", "Noida", "Chandigarh", "Agra",
        "Madurai", "Nashik", "Varanasi",
    ],
}

# Region of each known city.
REGIONS = {
    "North": [
        "Delhi", "Gurgaon", "Noida", "Ghaziabad", "Chandigarh", "Lucknow", "Kanpur", "Jaipur", "Ludhiana", "Agra",
        "Varanasi",
    ],
    "South": ["Bangalore", "Hyderabad", "Chennai", "Kochi", "Coimbatore", "Visakhapatnam", "Madurai"],
    "West": ["Mumbai", "Pune", "Ahmedabad", "Surat", "Thane", "Vadodara", "Nashik"],
    "East": ["Kolkata", "Patna"],
    "Central": ["Bhopal", "Nagpur", "Indore"],
}

TOP_SKILLS = 20


def city_dimension(spark: SparkSession, groups: dict[str, list[str]], name: str) -> DataFrame:
    """(city, <name>) rows with lower-cased city, for use as a table of its own."""
    rows = [(city.lower(), group) for group, cities in groups.items() for city in cities]
    return spark.createDataFrame(rows, f"city string, `{name}` string")


def classify(location: Column, groups: dict[str, list[str]]) -> Column:
    """Group of a city regardless of case; null is Unknown, an unlisted city Other.

    A dimension of a few dozen cities is an IN list per group: hash lookups in the scan stage, no join.
    """
    city = F.lower(location)
    chain = F.when(location.isNull(), F.lit(UNKNOWN))
    for group, cities in groups.items():
        chain = chain.when(city.isin([c.lower() for c in cities]), F.lit(group))
    return chain.otherwise(F.lit(OTHER))


def enrich_locations(df: DataFrame, location: str = "location_normalized", tiers: dict | None = None,
                     regions: dict | None = None) -> DataFrame:
    return df.withColumns(
        {
            "city_tier": classify(F.col(location), CITY_TIERS if tiers is None else tiers),
            "region": classify(F.col(location), REGIONS if regions is None else regions),
        }
    )


def _measures(id_column: str) -> list[Column]:
    return [
        F.count(id_column).alias("job_count"),
        F.avg("num_skills").alias("avg_skills"),
        F.avg("salary_min").alias("avg_salary_min"),
        F.avg("salary_max").alias("avg_salary_max"),
        F.avg("experience_years").alias("avg_experience"),
    ]


def stats_by(df: DataFrame, column: str, name: str, id_column: str = "job_id") -> DataFrame:
    """Postings and mean measures per value; postings without a value are left out."""
    known = df.filter(F.col(column).isNotNull())
    return known.groupBy(F.col(column).alias(name)).agg(*_measures(id_column))


def location_stats(df: DataFrame, location: str = "location_normalized", tiers: dict | None = None,
                   regions: dict | None = None, id_column: str = "job_id") -> DataFrame:
    """Measures per location; tier and region are looked up once per location, after the aggregate."""
    return stats_by(df, location, "location", id_column).withColumns(
        {
            "tier": classify(F.col("location"), CITY_TIERS if tiers is None else tiers),
            "region": classify(F.col("location"), REGIONS if regions is None else regions),
        }
    )


def tier_stats(df: DataFrame, id_column: str = "job_id") -> DataFrame:
    return stats_by(df, "city_tier", "tier", id_column)


def region_stats(df: DataFrame, id_column: str = "job_id") -> DataFrame:
    return stats_by(df, "region", "region", id_column)


def geo_grouping_sets(df: DataFrame, location: str = "location_normalized", id_column: str = "job_id") -> DataFrame:
    """Location, tier and region measures in one pass: (level, name, measures)."""
    keys = [F.col(location), F.col("city_tier"), F.col("region")]
    level = F.grouping_id(*keys)
    return (
        df.groupingSets([[k] for k in keys], *keys)
        .agg(level.alias("_id"), *_measures(id_column))
        .select(
            F.when(F.col("_id") == 3, "location").when(F.col("_id") == 5, "tier").otherwise("region").alias("level"),
            F.coalesce(*keys).alias("name"),
            "job_count", "avg_skills", "avg_salary_min", "avg_salary_max", "avg_experience",
        )
        .filter(F.col("name").isNotNull())
    )


def group_counts(df: DataFrame) -> DataFrame:
    """(kind, name, count) for tiers and regions, both from one pre-aggregate."""
    cells = df.groupBy("city_tier", "region").agg(F.count("*").alias("n"))
    kinds = F.array(
        F.struct(F.lit("tier").alias("kind"), F.col("city_tier").alias("name")),
        F.struct(F.lit("region").alias("kind"), F.col("region").alias("name")),
    )
    return cells.select("n", F.inline(kinds)).groupBy("kind", "name").agg(F.sum("n").alias("count"))


def location_skill_counts(df: DataFrame, location: str = "location_normalized",
                          skills_column: str = "extracted_skills") -> DataFrame:
    """(location, skill, count, postings): mentions of a skill and postings of the location, from one scan."""
    is_array = df.schema[skills_column].dataType.typeName() == "array"
    skills = F.col(skills_column) if is_array else split_skills(skills_column)
    marked = F.array_append(skills, F.lit(None).cast("string"))
    known = df.filter(F.col(location).isNotNull() & (F.col(location) != UNKNOWN))
    cells = (
        known.select(F.col(location).alias("location"), F.explode_outer(marked).alias("skill"))
        .groupBy("location", "skill")
        .agg(F.count("*").alias("count"))
    )
    # Aggregated already: at most one row per location and skill enters the window.
    postings = F.max(F.when(F.col("skill").isNull(), F.col("count"))).over(Window.partitionBy("location"))
    return cells.withColumn("postings", postings).filter(F.col("skill").isNotNull())


def skills_by_location(df: DataFrame, location: str = "location_normalized",
                       skills_column: str = "extracted_skills", top_n: int = TOP_SKILLS) -> DataFrame:
    """Most frequent skills per location with their share of its postings in per cent."""
    ranked = Window.partitionBy("location").orderBy(F.desc("count"), "skill")
    return (
        location_skill_counts(df, location, skills_column)
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= top_n)
        .select("location", "skill", "count", (F.col("count") / F.col("postings") * 100).alias("percentage"), "rank")
    )


def city_cards(df: DataFrame, location: str = "location_normalized", skills_column: str = "extracted_skills",
               top_n: int = 3) -> DataFrame:
    """(location, job_count, top_skills): postings and the names of the leading skills."""
    known = df.filter(F.col(location).isNotNull() & (F.col(location) != UNKNOWN))
    counts = known.groupBy(F.col(location).alias("location")).agg(F.count("*").alias("job_count"))
    best = (
        skills_by_location(df, location, skills_column, top_n)
        .groupBy("location")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "skill"))).alias("s"))
    )
    return counts.join(best, "location", "left").select(
        "location", "job_count",
        F.coalesce(F.array_join(F.transform("s", lambda x: x["skill"]), ", "), F.lit("")).alias("top_skills"),
    )
