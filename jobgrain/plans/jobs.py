"""The batch jobs: clean, extract, co-occurrence, trends, geography.

Each job reads its input once per result and writes tables below one folder. The table of postings with skills is
written as parquet between the steps, so that every analysis reads only the columns it needs. Intermediate tables of a
job are deleted when it ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobgrain.operators import cleaning, communities, cooccurrence, embedding, extraction, geography, graph, trends
from jobgrain.session import cut_lineage, scratch
from jobgrain.sources import sinks


def clean_job(
    postings: DataFrame, out: str, remove_dups: bool = True, dedup_keys: list[str] | None = None
) -> DataFrame:
    """Cleaned postings as a table."""
    path = f"{out}/cleaned"
    sinks.write_table(cleaning.preprocess(postings, remove_dups, dedup_keys), path)
    return postings.sparkSession.read.parquet(path)


def extract_job(
    cleaned: DataFrame,
    lexicon: DataFrame,
    out: str,
    text_column: str = "description_clean",
    text_vectors: DataFrame | None = None,
    skill_vectors: DataFrame | None = None,
    threshold: float = embedding.THRESHOLD,
    top_k: int = embedding.TOP_K,
    top_flags: int = extraction.TOP_FLAGS,
) -> DataFrame:
    """Postings with ``skills``, ``extracted_skills``, ``num_skills``, their places and a flag for each of the ``top_flags``
    most frequent skills, as a table; statistics of the skills, their categories and the main chart export beside it.

    Phrases alone need no shuffle. With vectors of texts and skills the closest skills are added to each set.
    """
    with scratch(cleaned.sparkSession):
        return _extract(cleaned, lexicon, out, text_column, text_vectors, skill_vectors, threshold, top_k, top_flags)


def _extract(cleaned, lexicon, out, text_column, text_vectors, skill_vectors, threshold, top_k, top_flags) -> DataFrame:
    df = extraction.extract_phrases(cleaned, lexicon, text_column)
    if text_vectors is not None and skill_vectors is not None:
        near = embedding.closest_skills(text_vectors, skill_vectors, top_k, threshold)
        sets = near.groupBy("job_id").agg(F.collect_set("skill").alias("_near"))
        near_or_none = F.coalesce("_near", F.array().cast("array<string>"))
        df = (
            df.join(sets, "job_id", "left")
            .withColumn("skills", F.array_sort(F.array_union("skills", near_or_none)))
            .drop("_near")
        )
    df = extraction.add_skill_columns(df)
    if "location_normalized" in df.columns:
        df = geography.enrich_locations(df)
    # The skills are counted for the flags and then written with them, so they are found once.
    found = cut_lineage(df)
    path = f"{out}/jobs_with_skills"
    sinks.write_table(extraction.add_skill_flags(found, top_flags), path)
    jobs = cleaned.sparkSession.read.parquet(path)
    _write_all(
        {
            "skill_statistics": extraction.skill_statistics(jobs),
            "skills_by_category": extraction.skills_by_category(jobs, lexicon),
            "jobs_main": sinks.main_export(jobs),
        },
        out,
    )
    return jobs


def cooccurrence_job(
    jobs: DataFrame,
    out: str,
    min_support: float = cooccurrence.MIN_SUPPORT,
    top_n: int = cooccurrence.TOP_ASSOCIATIONS,
    min_confidence: float | None = None,
    matrix: str = "sparse",
) -> dict[str, DataFrame]:
    """Pair counts, associations, edges, nodes with measures and clusters.

    ``matrix="dense"`` writes every ordered pair of skills instead of those seen together, ``"wide"`` a square table of
    them besides; both grow with the square of the vocabulary.
    """
    with scratch(jobs.sparkSession):
        return _cooccurrence(jobs, out, min_support, top_n, min_confidence, matrix)


def _cooccurrence(jobs, out, min_support, top_n, min_confidence, matrix) -> dict[str, DataFrame]:
    baskets = jobs.select("job_id", "skills") if "skills" in jobs.columns else cooccurrence.baskets(jobs)
    measured = cooccurrence.association_metrics(baskets, min_support)
    if min_confidence is not None:
        measured = cooccurrence.confident(measured, min_confidence)
    associations = cut_lineage(measured)
    edges, nodes = graph.network_edges(associations, top_n), graph.network_nodes(associations, top_n)
    tables = {
        "cooccurrence": cooccurrence.pair_counts(baskets) if matrix == "sparse" else cooccurrence.dense_matrix(baskets),
        "associations": cooccurrence.by_lift(associations),
        "network_edges": edges,
        "network_metrics": graph.network_metrics(edges, nodes),
        "clusters": communities.greedy_clusters(edges),
    }
    written = _write_all(tables, out)
    if matrix == "wide":
        names = [r["skill1"] for r in written["cooccurrence"].select("skill1").distinct().orderBy("skill1").collect()]
        written |= _write_all({"cooccurrence_wide": cooccurrence.wide_matrix(written["cooccurrence"], names)}, out)
    return written


def trends_job(
    jobs: DataFrame,
    out: str,
    frequency: str = "monthly",
    date_column: str = "posted_date_parsed",
    threshold: float = trends.Z_LIMIT,
    top_n: int = trends.TOP_TRENDS,
) -> dict[str, DataFrame]:
    """Trend grid, growth, emerging and declining skills, anomalies and the summary."""
    with scratch(jobs.sparkSession):
        return _trends(jobs, out, frequency, date_column, threshold, top_n)


def _trends(jobs, out, frequency, date_column, threshold, top_n) -> dict[str, DataFrame]:
    skills = "skills" if "skills" in jobs.columns else "extracted_skills"
    if jobs.filter(F.col(date_column).isNotNull()).isEmpty():
        raise ValueError("No valid dates in data")
    counts = cut_lineage(trends.trend_counts(trends.mentions(jobs, frequency, date_column, skills)))
    if counts.isEmpty():
        raise ValueError("No skills found")
    growth = trends.growth_metrics(counts)
    tables = {
        "trends": trends.trend_grid(counts),
        "trends_growth": growth.orderBy(F.desc("growth_rate"), "skill"),
        "trends_emerging": trends.emerging(growth, top_n),
        "trends_declining": trends.declining(growth, top_n),
        "trends_anomalies": trends.anomalies(counts, threshold).orderBy(F.desc(F.abs("z_score")), "skill", "period"),
        "trends_summary": trends.trend_summary(counts),
    }
    return _write_all(tables, out)


def geography_job(jobs: DataFrame, out: str) -> dict[str, DataFrame]:
    """Measures by location, tier and region, leading skills per location, regional subsets and the chart export."""
    if not {"city_tier", "region"} <= set(jobs.columns):
        jobs = geography.enrich_locations(jobs)
    ordered: list[Column] = [F.desc("job_count")]
    tables = {
        "location_stats": geography.location_stats(jobs).orderBy(*ordered, "location"),
        "tier_stats": geography.tier_stats(jobs).orderBy(*ordered, "tier"),
        "region_stats": geography.region_stats(jobs).orderBy(*ordered, "region"),
        "skills_by_location": geography.skills_by_location(jobs),
        "jobs_geographic": sinks.geographic_export(jobs),
    }
    sinks.write_regional(jobs.drop("skills"), f"{out}/by_region")
    return _write_all(tables, out)


def run_all(
    postings: DataFrame,
    lexicon: DataFrame,
    out: str,
    frequency: str = "monthly",
    clean_options: dict | None = None,
    extract_options: dict | None = None,
    cooccurrence_options: dict | None = None,
    trend_options: dict | None = None,
) -> dict[str, DataFrame]:
    """From raw postings to every result table. The options are the named parameters of the single jobs."""
    cleaned = clean_job(postings, out, **clean_options or {})
    jobs = extract_job(cleaned, lexicon, out, **extract_options or {})
    return {
        "cleaned": cleaned,
        "jobs_with_skills": jobs,
        **cooccurrence_job(jobs, out, **cooccurrence_options or {}),
        **trends_job(jobs, out, **{"frequency": frequency, **(trend_options or {})}),
        **geography_job(jobs, out),
    }


def _write_all(tables: dict[str, DataFrame], out: str) -> dict[str, DataFrame]:
    written = {}
    for name, df in tables.items():
        path = f"{out}/{name}"
        sinks.write_table(df, path)
        written[name] = df.sparkSession.read.parquet(path)
    return written
