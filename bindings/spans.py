"""Annotated spans, splits, scores and votes over ``documents``; file sources over the data folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.views import lexicon, rounded, sql, table
from jobgrain.functions.arrays import unfold
from jobgrain.functions import salary
from jobgrain.functions.text import TOKEN_PATTERN
from jobgrain.operators import extraction, spans
from jobgrain.session import materialise, shared_path
from jobgrain.sources import annotations, files, postings
from jobgrain.sources.sinks import write_table

# Skill the stand-in predictor misses; documents whose predictions are one character off.
MISSED = "license"
SHIFTED = 5
SOURCES = [["The", "Of The", "Attion"], ["The", "Que", "License"], ["Of The", "Que", "Und", "License"]]

_WORD = r"[\p{L}\p{N}]"


def _documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


def _weak(spark, sf):
    return spans.weak_labels(_documents(spark, sf), lexicon(spark))


def _shift(doc_id):
    return F.when(doc_id % SHIFTED == 0, 1).otherwise(0)


def _predicted(found):
    """The stand-in predictor's spans, made from the weak labels."""
    shift = _shift(F.col("doc_id"))
    kept = found.filter(F.col("skill") != MISSED)
    return kept.withColumns({"start": F.col("start") + shift, "end": F.col("end") + shift})


def _predicted_lists(spark, sf):
    """The same as an array beside each text."""
    shift = _shift(F.col("doc_id"))
    kept = F.filter("entities", lambda e: e["skill"] != MISSED)
    moved = F.transform(
        kept, lambda e: F.struct((e["start"] + shift).alias("start"), (e["end"] + shift).alias("end"), e["skill"].alias("skill"))
    )
    listed = extraction.phrase_lists(_documents(spark, sf), lexicon(spark), "text", "entities")
    return listed.withColumn("entities", moved)


def _annotated(spark, sf):
    """Texts with their spans written as JSON lines and read back with the declared schema."""
    entity = lambda e: F.struct(
        e["start"].cast("int").alias("start"), e["end"].cast("int").alias("end"), F.lit(spans.LABEL).alias("label")
    )
    lists = F.array_sort(F.transform("entities", entity))
    df = _predicted_lists(spark, sf).select("text", F.when(F.size("entities") > 0, lists).alias("entities"))
    path = shared_path(spark, "annotations")
    annotations.write_records(df, path)
    return annotations.read_annotations(spark, path, multi_line=False)


def _span_rows(spark, sf):
    rows = spans.spans(_annotated(spark, sf))
    return rows.select(F.md5("text").alias("text_digest"), "start", "end", "label", "surface")


def _span_check(spark, sf):
    return spans.check_entities(_predicted_lists(spark, sf))


def _span_prf(spark, sf):
    """Gold and predicted spans come from one pass over the texts, written as a table of offsets."""
    gold = materialise(_weak(spark, sf).drop("surface"), "gold")
    return rounded(spans.span_scores(gold, _predicted(gold)), ["precision", "recall", "f1"])


def _votes(spark, sf):
    names = lexicon(spark)
    found = [
        unfold(
            extraction.extract_phrases(
                _documents(spark, sf), names.filter(F.col("skill_name").isin(subset)), "text", "doc_id"
            ),
            "skills", "skill", "doc_id",
        )
        for subset in SOURCES
    ]
    return spans.vote(found, min_votes=2).withColumn("votes", F.col("votes").cast("bigint"))


def _split(spark, sf):
    df = spans.with_split(_documents(spark, sf), "doc_id", spans.TRAIN_DEV)
    return spans.with_split(df, "doc_id", spans.TRAIN_DEV_TEST, "three_way").select("doc_id", "split", "three_way")


def _read_postings(spark, sf):
    """Postings with whole documents as descriptions, quotes and line breaks included, through CSV."""
    docs = table(spark, sf, "documents")
    df = docs.select(
        F.col("doc_id").alias("job_id"), F.concat(F.lit('Say "'), "lang", F.lit('", please')).alias("title"),
        F.col("source").alias("company"), F.col("lang").alias("location"), F.lit("2024-01-15").alias("posted_date"),
        F.col("text").alias("description"), F.col("n_chars").cast("double").alias("salary_min"),
        F.lit(None).cast("double").alias("salary_max"), (F.col("doc_id") % 11).cast("int").alias("experience_years"),
        F.lit("Full-time").alias("job_type"),
    )
    path = shared_path(spark, "postings")
    write_table(df, path, "csv")
    read = postings.read_postings(spark, path)
    amounts = {c: salary.clean_salary(F.col(c)) for c in ("salary_min", "salary_max")}
    return read.withColumns(amounts).withColumn("description", F.md5("description"))


def _input_audit(spark, sf):
    """Size, digest and copies of every page; the host stands for the content too, so that copies occur."""
    digests = files.content_digests(table(spark, sf, "pages"), "page_id", "html")
    hosts = files.content_digests(
        table(spark, sf, "pages").select("page_id", F.element_at(F.split("url", "/"), 3).alias("host")), "page_id", "host", "md5"
    )
    both = digests.unionByName(hosts)
    copies = files.duplicate_content(both, "page_id").select("digest", "copies", "first_page_id")
    return both.join(copies, "digest", "left").select(
        "page_id", "bytes", "digest", F.coalesce("copies", F.lit(1)).alias("copies"),
        F.coalesce("first_page_id", "page_id").alias("first_page_id"),
    )


_SPANS = {
    "gaps": f"SELECT doc_id, regexp_split_to_array(lower(text), '{TOKEN_PATTERN}') AS g FROM documents",
    "gap_rows": "SELECT doc_id, unnest(g) AS g, generate_subscripts(g, 1) AS i FROM gaps",
    "ends": "SELECT doc_id, i, w, sum(length(g) + length(w)) OVER (PARTITION BY doc_id ORDER BY i) AS e "
    "FROM (SELECT doc_id, i, w FROM words) a JOIN gap_rows USING (doc_id, i)",
    "offsets": "SELECT doc_id, i, e - length(w) AS s, [e, lead(e) OVER d, lead(e, 2) OVER d] AS es FROM ends "
    "WINDOW d AS (PARTITION BY doc_id ORDER BY i)",
    "weak": "SELECT doc_id, CAST(s AS BIGINT) AS s, CAST(es[n] AS BIGINT) AS e, skill FROM hits JOIN offsets USING (doc_id, i)",
    "pred": f"SELECT doc_id, s + CASE WHEN doc_id % {SHIFTED} = 0 THEN 1 ELSE 0 END AS s, "
    f"e + CASE WHEN doc_id % {SHIFTED} = 0 THEN 1 ELSE 0 END AS e, skill FROM weak WHERE skill <> '{MISSED}'",
}
_BUCKET = "('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 100"


def _votes_sql() -> str:
    union = " UNION ALL ".join(
        f"SELECT doc_id, skill FROM doc_skills WHERE skill IN ({', '.join(repr(n.lower()) for n in names)})" for names in SOURCES
    )
    return sql("doc_skills", f"SELECT doc_id, skill, count(*) AS votes FROM ({union}) q GROUP BY 1, 2 HAVING count(*) >= 2")


QUERIES = {
    "weak_labels": _weak,
    "annotations": lambda s, d: _annotated(s, d).select(
        F.md5("text").alias("text_digest"), F.coalesce(F.size("entities"), F.lit(0)).cast("bigint").alias("n_entities")
    ),
    "spans": _span_rows,
    "span_check": _span_check,
    "split_sets": _split,
    "span_prf": _span_prf,
    "ensemble_vote": _votes,
    "read_postings": _read_postings,
    "input_audit": _input_audit,
}

ORACLE = {
    "input_audit": "WITH d AS (SELECT page_id, strlen(html) AS bytes, sha256(html) AS digest FROM pages UNION ALL "
    "SELECT page_id, strlen(h), md5(h) FROM (SELECT page_id, string_split(url, '/')[3] AS h FROM pages) q) "
    "SELECT page_id, bytes, digest, count(*) OVER g AS copies, min(page_id) OVER g AS first_page_id FROM d WINDOW g AS (PARTITION BY digest)",
    "weak_labels": sql(
        "words hits",
        "SELECT doc_id, s AS start, e AS \"end\", 'SKILL' AS label, skill, substr(text, CAST(s + 1 AS BIGINT), CAST(e - s AS BIGINT)) AS surface "
        "FROM weak JOIN documents USING (doc_id)",
        **_SPANS,
    ),
    "annotations": sql(
        "words hits",
        "SELECT md5(any_value(text)) AS text_digest, count(s) AS n_entities FROM documents LEFT JOIN pred USING (doc_id) GROUP BY doc_id",
        **_SPANS,
    ),
    "spans": sql(
        "words hits",
        "SELECT md5(text) AS text_digest, CAST(s AS INTEGER) AS start, CAST(e AS INTEGER) AS \"end\", 'SKILL' AS label, "
        "substr(text, s + 1, e - s) AS surface FROM pred JOIN documents USING (doc_id)",
        **_SPANS,
    ),
    "span_check": sql(
        "words hits",
        "SELECT doc_id, s AS start, e AS \"end\", skill, s >= 0 AND e <= length(text) "
        f"AND NOT (s > 0 AND regexp_matches(substr(text, s, 1), '{_WORD}') AND regexp_matches(substr(text, s + 1, 1), '{_WORD}')) "
        f"AND NOT (e < length(text) AND regexp_matches(substr(text, e, 1), '{_WORD}') AND regexp_matches(substr(text, e + 1, 1), '{_WORD}')) "
        "AND regexp_matches(substr(text, s + 1, 1), '\\S') AND regexp_matches(substr(text, e, 1), '\\S') AS is_valid "
        "FROM pred JOIN documents USING (doc_id)",
        **_SPANS,
    ),
    "split_sets": f"SELECT doc_id, CASE WHEN {_BUCKET} < 80 THEN 'train' ELSE 'dev' END AS split, "
    f"CASE WHEN {_BUCKET} < 80 THEN 'train' WHEN {_BUCKET} < 90 THEN 'dev' ELSE 'test' END AS three_way FROM documents",
    "span_prf": sql(
        "words hits",
        "SELECT round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1, "
        "CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn FROM (SELECT "
        "count(*) FILTER (g.s IS NOT NULL AND p.s IS NOT NULL)::DOUBLE AS tp, count(*) FILTER (g.s IS NULL)::DOUBLE AS fp, "
        "count(*) FILTER (p.s IS NULL)::DOUBLE AS fn FROM (SELECT DISTINCT doc_id, s, e FROM weak) g "
        "FULL JOIN (SELECT DISTINCT doc_id, s, e FROM pred) p USING (doc_id, s, e)) q",
        **_SPANS,
    ),
    "ensemble_vote": _votes_sql(),
    "read_postings": "SELECT doc_id AS job_id, 'Say \"' || lang || '\", please' AS title, source AS company, lang AS location, "
    "'2024-01-15' AS posted_date, md5(text) AS description, n_chars::DOUBLE AS salary_min, NULL::DOUBLE AS salary_max, "
    "CAST(doc_id % 11 AS INTEGER) AS experience_years, 'Full-time' AS job_type FROM documents",
}
