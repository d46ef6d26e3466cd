import pytest
from helpers import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from jobgrain.operators import cleaning


def test_duplicates_keep_the_first(spark):
    df = spark.createDataFrame(
        [(3, "A", "x", None, "d"), (1, "A", "x", None, "d"), (2, "A", "x", "y", "d"), (4, "A", "x", None, "e")],
        "job_id int, title string, company string, location string, posted_date string",
    )
    assert rows(cleaning.remove_duplicates(df).select("job_id")) == [(1,), (2,), (4,)]
    assert rows(cleaning.remove_duplicates(df.repartition(5)).select("job_id")) == [(1,), (2,), (4,)]


def test_hot_duplicate_group_shrinks_before_the_shuffle(spark):
    df = spark.range(2000).select(F.col("id").alias("job_id"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("title"))
    kept = cleaning.remove_duplicates(df, ["title"])
    assert kept.count() == 1001
    assert "WindowGroupLimit" in kept._jdf.queryExecution().toString()


def test_incomplete_rows_go(spark):
    df = spark.createDataFrame(
        [("a", "x"), (None, "x"), ("", "x"), ("b", None), ("c", "  ")], "title string, description string"
    )
    assert rows(cleaning.drop_incomplete(df)) == [("a", "x")]


def test_experience_and_salary_bounds(spark):
    df = spark.createDataFrame(
        [("a", "x", -1, 2.0, 1.0), ("b", "x", 5, 1.0, 2.0), ("c", "x", 99, 3.0, None), ("d", "x", None, None, 1.0)],
        "title string, description string, experience_years int, salary_min double, salary_max double",
    )
    assert rows(cleaning.validate_postings(df), "title", "experience_years", "salary_min", "salary_max") == [
        ("a", 0, 1.0, 2.0), ("b", 5, 1.0, 2.0), ("c", 50, 3.0, None), ("d", None, None, 1.0),
    ]


def test_preprocess_whole_and_partial(spark):
    df = spark.createDataFrame(
        [
            (1, "ml engineer", "Co", "blr", "2024-02-01", " Torch  needed", "8L", "1,200,000", 4),
            (2, "ml engineer", "Co", "blr", "2024-02-01", "copy", "8L", "12L", 4),
            (3, None, "Co", "blr", "2024-02-01", "x", "1", "2", 4),
        ],
        "job_id int, title string, company string, location string, posted_date string, description string, "
        "salary_min string, salary_max string, experience_years int",
    )
    row = cleaning.preprocess(df).collect()
    assert len(row) == 1
    first = row[0].asDict()
    assert first["title_normalized"] == "Machine Learning Engineer" and first["location_normalized"] == "Bangalore"
    assert first["description_clean"] == "torch needed" and str(first["posted_date_parsed"]) == "2024-02-01"
    assert (first["posted_year"], first["posted_month"], first["posted_quarter"]) == (2024, 2, "Q1")
    assert (first["salary_min"], first["salary_max"]) == (800_000.0, 1_200_000.0)
    assert cleaning.preprocess(df, remove_dups=False).count() == 2
    short = cleaning.preprocess(df.select("title", "description"), remove_dups=False)
    assert set(short.columns) == {"title", "description", "title_normalized", "description_clean"}
    with pytest.raises(AnalysisException):
        cleaning.preprocess(df.drop("title"), remove_dups=False).count()


def test_quality_report(spark):
    df = spark.createDataFrame([(i, None if i % 4 else "d") for i in range(12)], "title int, description string")
    report = {r["column_name"]: r for r in cleaning.quality_report(df, ["title", "description", "company"]).collect()}
    assert report["title"]["passes"] and report["title"]["nulls"] == 0
    assert not report["description"]["passes"] and report["description"]["null_share"] == pytest.approx(0.75)
    assert not report["company"]["present"] and not report["company"]["passes"]
    assert not any(r["passes"] for r in cleaning.quality_report(df.limit(5)).collect())


def test_email_report(spark):
    df = spark.createDataFrame(
        [("a", "mail me@home.org now or you@x"), ("a", "me@home.org### and @"), ("b", None), ("b", "nothing")],
        "g string, t string",
    )
    assert rows(cleaning.email_report(df, "t", "g")) == [("a", 1, 3)]
