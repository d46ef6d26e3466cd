"""Skill extraction over ``documents`` and ``embeddings``, and skill columns over orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.views import baskets, lexicon, part_lexicon, rounded, sql, table
from jobgrain.functions.arrays import unfold
from jobgrain.functions.text import tokens
from jobgrain.operators import embedding, extraction
from jobgrain.session import shared_path
from jobgrain.sources.annotations import read_records, write_records
from jobgrain.sources.lexicon import lexicon_phrases

# The vectors of ``embeddings`` are far apart: the usual 0.78 would find nothing.
THRESHOLD = 0.30


def documents(spark, sf):
    return table(spark, sf, "documents")


def with_skills(spark, sf):
    return extraction.extract_phrases(documents(spark, sf), lexicon(spark), "text", "doc_id")


def doc_skills(spark, sf):
    return unfold(with_skills(spark, sf), "skills", "skill", "doc_id")


def _joined_skills(spark, sf):
    """What ``extract_phrases`` finds when the lexicon is too large to travel inside the expression."""
    found = extraction.extract_phrases(documents(spark, sf), lexicon(spark), "text", "doc_id", inline_phrases=0)
    return unfold(found, "skills", "skill", "doc_id")


def closest(spark, sf, most=embedding.BROADCAST_BYTES):
    """Label centroids stand for skills, every vector for a text."""
    vectors = table(spark, sf, "embeddings")
    skills = embedding.centroids(vectors, "label", "embedding").select(
        F.concat(F.lit("label "), "skill").alias("skill"), "vector"
    )
    return embedding.closest_skills(
        vectors, skills, top_k=embedding.TOP_K, threshold=THRESHOLD, id_column="vec_id", text_vector="embedding",
        broadcast_bytes=most,
    )


_CLOSEST = {
    "dims": "SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings",
    "means": "SELECT label, i, avg(x) AS x FROM dims GROUP BY label, i",
    "cent": "SELECT label, list(x ORDER BY i) AS v FROM means GROUP BY label",
    "scored": "SELECT vec_id, 'label ' || cent.label AS skill, list_cosine_similarity(embedding::DOUBLE[], v) AS score FROM embeddings, cent",
    "ranked": "SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, skill) AS rank FROM scored",
    "close": f"SELECT * FROM ranked WHERE rank <= 20 AND score >= {THRESHOLD}",
}


def _hybrid(spark, sf):
    vectors = closest(spark, sf).select(F.col("vec_id").alias("doc_id"), "skill")
    return extraction.union_skills(doc_skills(spark, sf), vectors, "doc_id")


def _jobs_with_skills(spark, sf):
    df = extraction.add_skill_columns(with_skills(spark, sf))
    return df.select("doc_id", "extracted_skills", F.col("num_skills").cast("bigint").alias("num_skills"))


def _skill_flags(spark, sf):
    """Rows and positives per flag column, read back from the wide table."""
    wide = extraction.add_skill_flags(baskets(spark, sf))
    flags = [c for c in wide.columns if c.startswith("has_")]
    sums = wide.agg(F.count("*").alias("n"), *[F.count_if(F.col(f"`{c}`")).alias(f"f{i}") for i, c in enumerate(flags)])
    pairs = F.array(*[F.struct(F.lit(c).alias("flag"), F.col(f"f{i}").alias("positives")) for i, c in enumerate(flags)])
    return sums.select("n", F.inline(pairs)).select("flag", "positives", F.col("n").alias("total_rows"))


def _skill_stats(spark, sf):
    stats = extraction.skill_statistics(with_skills(spark, sf))
    return rounded(stats, ["avg_skills_per_job"]).withColumn(
        "max_skills_per_job", F.col("max_skills_per_job").cast("bigint")
    )


_STATS_SQL = sql(
    "doc_skills",
    "SELECT count(*) AS total_jobs, count(*) FILTER (k > 0) AS jobs_with_skills, round(avg(k), 6) AS avg_skills_per_job, "
    "quantile_cont(k::DOUBLE, 0.5) AS median_skills_per_job, max(k) AS max_skills_per_job, "
    "(SELECT count(DISTINCT skill) FROM doc_skills) AS total_unique_skills FROM per",
    per="SELECT documents.doc_id, count(skill) AS k FROM documents LEFT JOIN doc_skills USING (doc_id) GROUP BY documents.doc_id",
)


def _stats_json(spark, sf):
    stats = _skill_stats(spark, sf)
    path = shared_path(spark, "stats")
    write_records(stats, path)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stats.schema)
    return read_records(spark, path, schema)


QUERIES = {
    "lexicon_phrases": lambda s, d: lexicon_phrases(part_lexicon(s, d)),
    "tokenize": lambda s, d: unfold(documents(s, d), tokens(F.col("text")), "token").groupBy("token").agg(
        F.count("*").alias("count")
    ),
    "extract_phrases": doc_skills,
    "embed_topk": lambda s, d: rounded(closest(s, d), ["score"]).withColumn("rank", F.col("rank").cast("bigint")),
    "embed_topk_blocks": lambda s, d: rounded(closest(s, d, 0), ["score"]).withColumn("rank", F.col("rank").cast("bigint")),
    "extract_phrases_joined": _joined_skills,
    "extract_hybrid": _hybrid,
    "jobs_with_skills": _jobs_with_skills,
    "top_skills": lambda s, d: extraction.top_skills(baskets(s, d), 10),
    "skill_flags": _skill_flags,
    "skill_stats": _skill_stats,
    "stats_json": _stats_json,
    "skills_by_category": lambda s, d: extraction.skills_by_category(with_skills(s, d), lexicon(s)),
}

ORACLE = {
    "lexicon_phrases": "WITH lex AS (SELECT p_brand || ' ' || p_type AS name, CASE WHEN p_type = 'ECONOMY' THEN 'Soft' ELSE 'Technical' END AS category, "
    "p_type AS subcategory, p_name FROM part) SELECT DISTINCT lower(name) AS skill, category, subcategory, unnest([lower(name), lower(p_name)]) AS phrase FROM lex",
    "tokenize": sql("toks", "SELECT w AS token, count(*) AS count FROM (SELECT unnest(t) AS w FROM toks) q GROUP BY w"),
    "extract_phrases": sql("doc_skills", "SELECT doc_id, skill FROM doc_skills"),
    "embed_topk_blocks": sql("", "SELECT vec_id, skill, round(score, 6) AS score, rank FROM close", **_CLOSEST),
    "extract_phrases_joined": sql("doc_skills", "SELECT doc_id, skill FROM doc_skills"),
    "embed_topk": sql("", "SELECT vec_id, skill, round(score, 6) AS score, rank FROM close", **_CLOSEST),
    "extract_hybrid": sql(
        "doc_skills", "SELECT doc_id, skill FROM doc_skills UNION SELECT vec_id, skill FROM close", **_CLOSEST
    ),
    "jobs_with_skills": sql(
        "doc_skills",
        "SELECT documents.doc_id, coalesce(string_agg(skill, ';' ORDER BY skill), '') AS extracted_skills, count(skill) AS num_skills "
        "FROM documents LEFT JOIN doc_skills USING (doc_id) GROUP BY documents.doc_id",
    ),
    "top_skills": sql("counts", "SELECT skill, c AS count FROM counts ORDER BY c DESC, skill LIMIT 10"),
    "skill_flags": sql(
        "counts",
        "SELECT 'has_' || lower(replace(replace(skill, ' ', '_'), '-', '_')) AS flag, c AS positives, (SELECT count(*) FROM orders) AS total_rows "
        "FROM (SELECT * FROM counts ORDER BY c DESC, skill LIMIT 50) q",
    ),
    "skill_stats": _STATS_SQL,
    "stats_json": _STATS_SQL,
    "skills_by_category": sql(
        "doc_skills phrases",
        "SELECT category, subcategory, CAST(sum(c) AS BIGINT) AS mentions, count(DISTINCT skill) AS skills FROM per GROUP BY ROLLUP (category, subcategory)",
        per="SELECT skill, category, subcategory, count(*) AS c FROM doc_skills JOIN (SELECT DISTINCT skill, category, subcategory FROM phrases) p USING (skill) GROUP BY 1, 2, 3",
    ),
}
