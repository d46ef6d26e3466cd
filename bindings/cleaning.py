"""Cleaning operators over dirty values printed from the order table."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from bindings.views import jobs, rounded, sql, table
from jobgrain.functions import dates, salary, text
from jobgrain.functions.text import TITLE_SYNONYMS, CITY_SYNONYMS
from jobgrain.operators import cleaning
from jobgrain.sources.postings import map_foreign_columns


def _key() -> Column:
    return F.col("o_orderkey")


# Dirty spellings handed out by order key; the last slot takes a column of the table instead.
TITLES = ["data scientist", "ML  Engineer", " fullstack developer", "SRE", "DevOps Engineer", None, "backend\tdeveloper"]
CITIES = ["bangalore", "Bengaluru", " BLR", "bombay", "New  Delhi", "gurugram", "hyd", None, ""]
DATE_PRINTS = [
    ("yyyy-MM-dd", "%Y-%m-%d"), ("dd-MM-yyyy", "%d-%m-%Y"), ("MM/dd/yyyy", "%m/%d/%Y"), ("dd/MM/yyyy", "%d/%m/%Y"),
    ("MMMM d, yyyy", "%B %-d, %Y"), ("MMM d, yyyy", "%b %-d, %Y"),
]
_DAY_SQL = "CASE o_orderkey % 7 " + " ".join(
    f"WHEN {i} THEN strftime(o_orderdate, '{f}')" for i, (_, f) in enumerate(DATE_PRINTS)
) + " ELSE 'not a date' END"
_PARSED_SQL = "CAST(coalesce(" + ", ".join(
    f"try_strptime(d, '{f}')" for f in ("%Y-%m-%d", "%d-%m-%Y", "%m/%d/%Y", "%d/%m/%Y", "%B %d, %Y", "%b %d, %Y")
) + ") AS DATE)"
_NORM_SQL = r"coalesce(trim(regexp_replace(lower({c}), '\s+', ' ', 'g')), '')"
_TITLE_CASE_SQL = "array_to_string(list_transform(string_split({c}, ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def _pick(values: list[str | None], other):
    chain = F
    for i, value in enumerate(values):
        chain = chain.when(_key() % (len(values) + 1) == i, F.lit(value))
    return chain.otherwise(other)


def _pick_sql(values: list[str | None], other: str) -> str:
    quoted = ["NULL" if v is None else "'" + v + "'" for v in values]
    return f"CASE o_orderkey % {len(values) + 1} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(quoted)) + f" ELSE {other} END"


def _canonical_sql(column: str, synonyms: dict[str, list[str]]) -> str:
    cases = " ".join(f"WHEN {column} IN ({', '.join(repr(s) for s in v)}) THEN '{k}'" for k, v in synonyms.items())
    return f"CASE WHEN {column} = '' THEN 'Unknown' {cases} ELSE {_TITLE_CASE_SQL.format(c=column)} END"


def _names_sql(values, other, synonyms, raw, out) -> str:
    return (
        f"SELECT o_orderkey AS job_id, {raw}, {_canonical_sql('n', synonyms)} AS {out} FROM "
        f"(SELECT o_orderkey, {raw}, {_NORM_SQL.format(c=raw)} AS n FROM "
        f"(SELECT o_orderkey, {_pick_sql(values, other)} AS {raw} FROM orders) a) b"
    )


def _orders(spark, sf):
    return table(spark, sf, "orders")


def _titles(spark, sf):
    df = _orders(spark, sf).select(_key().alias("job_id"), _pick(TITLES, F.col("o_orderpriority")).alias("title"))
    return df.withColumn("title_normalized", text.normalize_title(F.col("title")))


def _cities(spark, sf):
    df = _orders(spark, sf).select(_key().alias("job_id"), _pick(CITIES, F.col("o_orderpriority")).alias("location"))
    return df.withColumn("location_normalized", text.normalize_location(F.col("location")))


def _dirty_dates(spark, sf):
    printed = F
    for i, (pattern, _) in enumerate(DATE_PRINTS):
        printed = printed.when(_key() % 7 == i, F.date_format("o_orderdate", pattern))
    return _orders(spark, sf).select(_key().alias("job_id"), printed.otherwise("not a date").alias("posted_date"))


def _parsed(spark, sf):
    return _dirty_dates(spark, sf).withColumn("posted_date_parsed", dates.parse_date(F.col("posted_date")))


def _dirty_salary(spark, sf):
    whole = F.floor("o_totalprice").cast("bigint")
    lakhs, thousands = F.floor(whole / 100_000), F.floor(whole / 1_000)
    plain = whole.cast("string")
    forms = [
        plain, F.format_number(whole, 0), F.concat(F.lit("₹"), plain), F.concat(lakhs, F.lit("L")),
        F.concat(lakhs, F.lit(" lakhs")), F.concat(thousands, F.lit("k")), F.concat(plain, F.lit("-"), whole * 2),
    ]
    chain = F
    for i, form in enumerate(forms):
        chain = chain.when(_key() % 8 == i, form)
    return _orders(spark, sf).select(_key().alias("job_id"), chain.otherwise("invalid").alias("salary_text"))


def _invalid(spark, sf):
    """Postings with missing texts, wild experience and inverted salaries."""
    low, high = 0.8 * F.col("o_totalprice"), 1.2 * F.col("o_totalprice")
    swapped = _key() % 3 == 0
    return _orders(spark, sf).select(
        _key().alias("job_id"),
        F.when(_key() % 10 == 0, F.lit(None)).when(_key() % 10 == 1, "").otherwise(F.col("o_orderpriority")).alias("title"),
        F.when(_key() % 10 == 2, F.lit(None)).when(_key() % 10 == 3, "  ").otherwise(F.col("o_orderstatus")).alias("description"),
        F.when(_key() % 17 != 0, _key() % 70 - 10).cast("int").alias("experience_years"),
        F.when(swapped, high).otherwise(low).alias("salary_min"),
        F.when(_key() % 13 != 0, F.when(swapped, low).otherwise(high)).alias("salary_max"),
    )


_INVALID_SQL = (
    "SELECT o_orderkey AS job_id, CASE o_orderkey % 10 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE o_orderpriority END AS title, "
    "CASE o_orderkey % 10 WHEN 2 THEN NULL WHEN 3 THEN '  ' ELSE o_orderstatus END AS description, "
    "CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderkey % 70 - 10 AS INTEGER) END AS experience_years, "
    "CASE WHEN o_orderkey % 3 = 0 THEN 1.2::DOUBLE ELSE 0.8::DOUBLE END * o_totalprice AS salary_min, "
    "CASE WHEN o_orderkey % 13 <> 0 THEN CASE WHEN o_orderkey % 3 = 0 THEN 0.8::DOUBLE ELSE 1.2::DOUBLE END * o_totalprice END AS salary_max "
    "FROM orders"
)


def _duplicates(spark, sf):
    return _orders(spark, sf).select(
        _key().alias("job_id"), F.col("o_orderpriority").alias("title"), F.col("o_custkey").alias("company"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("location"),
    )


def _raw_postings(spark, sf):
    """Raw postings that exercise the whole cleaning step."""
    printed = F
    for i, (pattern, _) in enumerate(DATE_PRINTS):
        printed = printed.when(_key() % 7 == i, F.date_format("o_orderdate", pattern))
    return _orders(spark, sf).select(
        _key().alias("job_id"),
        _pick(TITLES, F.col("o_orderpriority")).alias("title"),
        F.concat(F.lit("Company "), F.col("o_custkey") % 10).alias("company"),
        _pick(CITIES, F.col("o_orderpriority")).alias("location"),
        printed.alias("posted_date"),
        F.concat(F.lit("  Wanted:  "), "o_orderpriority").alias("description"),
        F.format_number(F.floor("o_totalprice"), 0).alias("salary_min"),
        F.concat(F.floor(F.col("o_totalprice") / 1_000), F.lit("k")).alias("salary_max"),
        (_key() % 70 - 10).cast("int").alias("experience_years"),
    )


def _preprocess(spark, sf):
    cleaned = cleaning.preprocess(_raw_postings(spark, sf), remove_dups=True)
    return cleaned.select(
        "job_id", "title_normalized", "location_normalized", "description_clean", "posted_date_parsed", "posted_year",
        "posted_month", "posted_quarter", "salary_min", "salary_max", "experience_years",
    )


_PREPROCESS_SQL = (
    "WITH raw AS (SELECT o_orderkey, " + _pick_sql(TITLES, "o_orderpriority") + " AS title, 'Company ' || (o_custkey % 10) AS company, "
    + _pick_sql(CITIES, "o_orderpriority") + " AS location, " + _DAY_SQL + " AS posted_date, o_orderdate, "
    "'  Wanted:  ' || o_orderpriority AS description, floor(o_totalprice) AS a, floor(o_totalprice / 1000) * 1000 AS b, "
    "CAST(o_orderkey % 70 - 10 AS INTEGER) AS e FROM orders), "
    "kept AS (SELECT * FROM raw WHERE trim(title) <> '' QUALIFY row_number() OVER "
    "(PARTITION BY title, company, location, posted_date ORDER BY o_orderkey) = 1), "
    "named AS (SELECT *, " + _NORM_SQL.format(c="title") + " AS tn, " + _NORM_SQL.format(c="location") + " AS ln, "
    + _PARSED_SQL.replace("(d,", "(posted_date,") + " AS d FROM kept) "
    "SELECT o_orderkey AS job_id, " + _canonical_sql("tn", TITLE_SYNONYMS) + " AS title_normalized, "
    + _canonical_sql("ln", CITY_SYNONYMS) + " AS location_normalized, " + _NORM_SQL.format(c="description") + " AS description_clean, "
    "d AS posted_date_parsed, CAST(year(d) AS INTEGER) AS posted_year, CAST(month(d) AS INTEGER) AS posted_month, "
    "'Q' || quarter(d) AS posted_quarter, CAST(least(a, b) AS DOUBLE) AS salary_min, CAST(greatest(a, b) AS DOUBLE) AS salary_max, "
    "least(greatest(e, 0), 50) AS experience_years FROM named"
)


def _quality(spark, sf):
    report = cleaning.quality_report(_invalid(spark, sf), required=["title", "description", "company"])
    return rounded(report, ["null_share"])


def _quality_sql() -> str:
    present = ["job_id", "title", "description", "experience_years", "salary_min", "salary_max"]
    rows = [
        f"SELECT '{c}' AS column_name, true AS present, {str(c in ('title', 'description')).lower()} AS required, "
        f"count(*) AS rows, count(*) - count({c}) AS nulls FROM inv" for c in present
    ] + ["SELECT 'company', false, true, count(*), count(*) FROM inv"]
    return (
        f"WITH inv AS ({_INVALID_SQL}) SELECT column_name, present, required, rows, nulls, "
        "round(nulls::DOUBLE / rows, 6) AS null_share, present AND rows >= 10 AND nulls::DOUBLE / rows <= 0.5 AS passes FROM ("
        + " UNION ALL ".join(rows) + ") q"
    )


def _import_mapped(spark, sf):
    """A foreign table: known and unknown column names, no job_id."""
    foreign = _orders(spark, sf).select(
        F.col("o_orderpriority").alias("Job Title"), F.col("o_custkey").alias("Company Name"),
        F.col("o_totalprice").alias("Max Salary"), F.col("o_orderstatus").alias("Status"), _key(),
    )
    order = [F.desc("salary_max"), F.col("o_orderkey")]
    return map_foreign_columns(foreign, order_by=order).drop("o_orderkey")


QUERIES = {
    "import_mapped": _import_mapped,
    "normalize_text": lambda s, d: table(s, d, "documents").select(
        "doc_id", F.md5(text.normalize_text(F.col("text"))).alias("digest"),
        F.length(text.normalize_text(F.col("text"))).cast("bigint").alias("n_chars"),
    ),
    "normalize_title": _titles,
    "normalize_location": _cities,
    "parse_date": _parsed,
    "date_parts": lambda s, d: dates.add_date_parts(_parsed(s, d)).select(
        "job_id", "posted_year", "posted_month", "posted_quarter"
    ),
    "clean_salary": lambda s, d: _dirty_salary(s, d).select(
        "job_id", salary.clean_salary(F.col("salary_text")).alias("salary")
    ),
    "dedup_postings": lambda s, d: cleaning.remove_duplicates(_duplicates(s, d), ["title", "company", "location"]),
    "validate_required": lambda s, d: cleaning.drop_incomplete(_invalid(s, d)).select("job_id", "title", "description"),
    "clip_experience": lambda s, d: _invalid(s, d).select(
        "job_id", cleaning.clip_experience(F.col("experience_years")).alias("experience_years")
    ),
    "swap_salaries": lambda s, d: cleaning.validate_postings(_invalid(s, d)).select(
        "job_id", F.round("salary_min", 4).alias("salary_min"), F.round("salary_max", 4).alias("salary_max")
    ),
    "preprocess": _preprocess,
    "salary_band": lambda s, d: cleaning.flag_salary_band(jobs(s, d), "salary_min").select("job_id", "salary_plausible"),
    "quality_report": _quality,
    "date_range": lambda s, d: dates.within_dates(
        _orders(s, d).select(_key().alias("job_id"), "o_orderdate"), "o_orderdate", "1997-03-01", "1998-06-30"
    ).select("job_id", F.col("o_orderdate").cast("date").alias("posted_date")),
    "email_report": lambda s, d: cleaning.email_report(table(s, d, "documents"), "text", "source"),
    "avg_salary": lambda s, d: jobs(s, d).select(
        "job_id", F.round(salary.average_salary(F.col("salary_min"), F.col("salary_max")), 4).alias("avg_salary")
    ),
}

ORACLE = {
    "import_mapped": "SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS job_id, o_orderpriority AS title, "
    'o_custkey AS company, o_totalprice AS salary_max, o_orderstatus AS "Status" FROM orders',
    "normalize_text": f"SELECT doc_id, md5({_NORM_SQL.format(c='text')}) AS digest, length({_NORM_SQL.format(c='text')}) AS n_chars FROM documents",
    "normalize_title": _names_sql(TITLES, "o_orderpriority", TITLE_SYNONYMS, "title", "title_normalized"),
    "normalize_location": _names_sql(CITIES, "o_orderpriority", CITY_SYNONYMS, "location", "location_normalized"),
    "parse_date": f"SELECT o_orderkey AS job_id, d AS posted_date, {_PARSED_SQL} AS posted_date_parsed FROM "
    f"(SELECT o_orderkey, {_DAY_SQL} AS d FROM orders) q",
    "date_parts": f"SELECT job_id, CAST(year(p) AS INTEGER) AS posted_year, CAST(month(p) AS INTEGER) AS posted_month, "
    f"'Q' || quarter(p) AS posted_quarter FROM (SELECT o_orderkey AS job_id, {_PARSED_SQL} AS p FROM "
    f"(SELECT o_orderkey, {_DAY_SQL} AS d FROM orders) q) r",
    "clean_salary": "SELECT o_orderkey AS job_id, CAST(CASE WHEN o_orderkey % 8 < 3 THEN s WHEN o_orderkey % 8 < 5 THEN s // 100000 * 100000 "
    "WHEN o_orderkey % 8 = 5 THEN s // 1000 * 1000 WHEN o_orderkey % 8 = 6 THEN s * 1.5 END AS DOUBLE) AS salary FROM "
    "(SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS s FROM orders) q",
    "dedup_postings": "SELECT job_id, title, company, location FROM (SELECT o_orderkey AS job_id, o_orderpriority AS title, o_custkey AS company, "
    "CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS location FROM orders) q "
    "QUALIFY row_number() OVER (PARTITION BY title, company, location ORDER BY job_id) = 1",
    "validate_required": f"SELECT job_id, title, description FROM ({_INVALID_SQL}) q WHERE trim(title) <> '' AND trim(description) <> ''",
    "clip_experience": f"SELECT job_id, CASE WHEN experience_years IS NOT NULL THEN least(greatest(experience_years, 0), 50) END AS experience_years FROM ({_INVALID_SQL}) q",
    "swap_salaries": f"SELECT job_id, round(CASE WHEN salary_min > salary_max THEN salary_max ELSE salary_min END, 4) AS salary_min, "
    f"round(CASE WHEN salary_min > salary_max THEN salary_min ELSE salary_max END, 4) AS salary_max FROM ({_INVALID_SQL}) q "
    "WHERE trim(title) <> '' AND trim(description) <> ''",
    "preprocess": _PREPROCESS_SQL,
    "salary_band": sql("jobs0", "SELECT job_id, salary_min BETWEEN 100000 AND 10000000 AS salary_plausible FROM jobs0"),
    "quality_report": _quality_sql(),
    "date_range": "SELECT o_orderkey AS job_id, CAST(o_orderdate AS DATE) AS posted_date FROM orders WHERE o_orderdate >= DATE '1997-03-01' AND o_orderdate < DATE '1998-07-01'",
    "email_report": "WITH words AS (SELECT source, unnest(regexp_split_to_array(text, '[ \\t\\r\\n]+')) AS w FROM documents) "
    "SELECT source, count(*) FILTER (ok) AS well_formed, count(*) FILTER (NOT ok) AS malformed FROM (SELECT source, "
    f"regexp_matches(w, '{cleaning.EMAIL_PATTERN}') AS ok FROM words WHERE contains(w, '@')) q GROUP BY source",
    "avg_salary": sql("jobs0", "SELECT job_id, round((salary_min + salary_max) / 2, 4) AS avg_salary FROM jobs0"),
}
