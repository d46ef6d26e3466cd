import hashlib
import json
from pathlib import Path

import pytest
from helpers import rows
from pyspark.sql import functions as F

from jobgrain import session
from jobgrain.operators import spans
from jobgrain.plans import jobs as plans
from jobgrain.sources import annotations, files, lexicon, postings, sinks

HEADER = "job_id,title,company,location,posted_date,description,salary_min,salary_max,experience_years,job_type\n"


@pytest.fixture(scope="module")
def posting_file(tmp_path_factory):
    path = tmp_path_factory.mktemp("in") / "postings.csv"
    texts = ["Python and SQL, teamwork", "ML with python", "C++, CI/CD", "SQL Server and SQL", "python; sql; ML"]
    cities = ["blr", "Bombay", "Pune", "Nashik", ""]
    lines = [
        f'{i + 1},ml engineer,Co {i % 4},{cities[i % 5]},2024-0{1 + i % 6}-1{i % 10},"{texts[i % 5]}, said ""they""",{500000 + i},{900000 + i},{i % 8},Full-time'
        for i in range(60)
    ]
    path.write_text(HEADER + "\n".join([*lines, "61,,X,Delhi,2024-01-01,gone,1,2,3,Full-time"]) + "\n")
    return str(path)


def test_read_postings(spark, posting_file):
    df = postings.read_postings(spark, posting_file)
    assert df.count() == 61 and dict(df.dtypes)["salary_min"] == "string" and dict(df.dtypes)["job_id"] == "bigint"
    assert df.filter("job_id = 1").first()["description"] == 'Python and SQL, teamwork, said "they"'


def test_multi_line_and_blanks_survive_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b",\n c '), (2, None), (3, " x")], "job_id int, description string")
    sinks.write_table(df, str(tmp_path / "t"), "csv")
    back = postings.read_postings(spark, str(tmp_path / "t"), "job_id INT, description STRING", multi_line=True)
    assert rows(back) == rows(df)


def test_foreign_columns(spark, tmp_path):
    path = tmp_path / "foreign.csv"
    path.write_text("Job Title,Location,Extra\n" + "".join(f"t{i},c{i},e{i}\n" for i in range(40)))
    df = postings.import_foreign_csv(spark, str(path))
    assert df.columns == ["job_id", "title", "location", "Extra"]
    assert all(r["title"] == f"t{r['job_id'] - 1}" for r in df.collect()) and df.agg(F.max("job_id")).first()[0] == 40
    assert postings.map_foreign_columns(df.withColumnRenamed("title", "Job Title")).columns == df.columns


def test_lexicon_file(spark, tmp_path):
    path = tmp_path / "lexicon.csv"
    path.write_text('skill_name,category,subcategory,aliases\nPython,Technical,Language,"python, py"\nTeamwork,Soft,People,\n')
    found = lexicon.lexicon_phrases(lexicon.read_lexicon(spark, str(path)))
    assert rows(found, "skill", "phrase") == [("python", "py"), ("python", "python"), ("teamwork", "teamwork")]


def test_annotations(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text(json.dumps([{"text": "Need Python now", "entities": [{"start": 5, "end": 11, "label": "SKILL"}]}, {"text": "none", "entities": []}]))
    found = spans.spans(annotations.read_annotations(spark, str(path)))
    assert rows(found, "start", "end", "surface") == [(5, 11, "Python")]


def test_records(spark, tmp_path):
    df = spark.createDataFrame([(1, None, 0.5)], "a int, b string, c double")
    annotations.write_records(df, str(tmp_path / "r"))
    assert rows(annotations.read_records(spark, str(tmp_path / "r"), "a int, b string, c double")) == [(1, None, 0.5)]


def test_content_audit(spark, tmp_path):
    contents = {1: "x" * 100, 2: "x" * 100, 3: "é", 4: None, 5: None, 6: ""}
    df = spark.createDataFrame([*contents.items()], "id int, body string")
    for algorithm in ("sha256", "sha1", "md5"):
        found = files.content_digests(df, "id", "body", algorithm)
        expected = [(i, None if c is None else len(c.encode()), None if c is None else hashlib.new(algorithm, c.encode()).hexdigest()) for i, c in contents.items()]
        assert rows(found) == sorted(expected, key=lambda r: str(r[0]))
    assert rows(files.duplicate_content(found, "id"), "copies", "first_id", "bytes") == [(2, 1, 200)]
    (tmp_path / "a").write_bytes(b"x" * 100)
    assert files.file_sizes(spark, str(tmp_path), "a", "KB").first()["size"] == 100 / 1024


def test_exports(spark):
    df = spark.createDataFrame([(1, "t", "x", 2024, True)], "job_id int, title string, location_normalized string, posted_year int, `has_c++` boolean")
    assert sinks.geographic_export(df).columns == ["job_id", "title", "location", "year", "has_c++"]
    assert sinks.main_export(df.withColumnRenamed("title", "title_normalized")).columns == ["job_id", "title", "location", "year", "has_c++"]


def test_regional_folders(spark, tmp_path):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(["North", "South", "North", "Unknown", "Other"] * 20)], "job_id int, region string")
    sinks.write_regional(df, str(tmp_path / "r"))
    assert {p.name for p in (tmp_path / "r").iterdir() if p.is_dir()} == {"region=north", "region=south", "region=other"}
    assert spark.read.options(**postings.csv_options()).csv(str(tmp_path / "r")).count() == 80


def test_shared_folder_comes_from_the_session(spark, shared_folder):
    assert session.shared_root(spark) == shared_folder
    assert session.shared_path(spark, "x").startswith(shared_folder)
    doubled = spark.range(5).withColumn("twice", F.col("id") * 2)
    assert session.cut_lineage(doubled).count() == 5 and list(Path(shared_folder).glob("cut-*"))
    assert session.cut_lineage(doubled.filter("id > 9")).isEmpty()


def test_all_jobs(spark, posting_file, small_lexicon, tmp_path):
    out = str(tmp_path / "out")
    tables = plans.run_all(postings.read_postings(spark, posting_file), small_lexicon, out)
    assert tables["jobs_with_skills"].count() == 60
    first = tables["jobs_with_skills"].filter("job_id = 1").first()
    assert first["extracted_skills"] == "python;sql;teamwork" and first["city_tier"] == "Tier-1" and first["region"] == "South"
    assert tables["trends"].agg(F.sum("count")).first()[0] == tables["jobs_with_skills"].agg(F.sum("num_skills")).first()[0]
    assert tables["associations"].filter("skill1 = 'python' AND skill2 = 'sql'").first()["cooccurrence_count"] == 24
    assert tables["location_stats"].agg(F.sum("job_count")).first()[0] == 60
    assert tables["network_metrics"].count() == tables["clusters"].count() > 3
    assert tables["trends_summary"].first()["num_periods"] == 6
    other = plans.run_all(
        postings.read_postings(spark, posting_file), small_lexicon, f"{out}-other", clean_options={"remove_dups": False},
        extract_options={"top_flags": 1}, cooccurrence_options={"top_n": 2, "matrix": "dense"}, trend_options={"frequency": "quarterly", "top_n": 1},
    )
    assert sum(c.startswith("has_") for c in other["jobs_with_skills"].columns) == 1
    assert other["network_edges"].count() == 2 and other["trends_emerging"].count() <= 1
    assert other["cooccurrence"].count() > tables["cooccurrence"].count() and other["trends_summary"].first()["num_periods"] == 2
    with pytest.raises(ValueError):
        plans.trends_job(tables["jobs_with_skills"].withColumn("posted_date_parsed", F.lit(None).cast("date")), out)
    with pytest.raises(ValueError):
        plans.trends_job(tables["jobs_with_skills"].withColumn("skills", F.array().cast("array<string>")), out)


def test_extraction_with_vectors(spark, small_lexicon, tmp_path):
    cleaned = spark.createDataFrame([(1, "python"), (2, "nothing")], "job_id int, description_clean string")
    texts = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "job_id int, vector array<float>")
    skills = spark.createDataFrame([("rust", [0.1, 1.0]), ("go", [1.0, 0.1])], "skill string, vector array<float>")
    df = plans.extract_job(cleaned, small_lexicon, str(tmp_path), text_vectors=texts, skill_vectors=skills)
    assert rows(df, "job_id", "extracted_skills", "num_skills") == [(1, "go;python", 2), (2, "rust", 1)]


def test_a_late_batch_replaces_its_regions_only(spark, tmp_path):
    import os

    path = str(tmp_path / "regions")
    schema = "job_id int, region string"
    first = spark.createDataFrame([(1, "North"), (2, "South"), (3, "South"), (4, "Unknown")], schema)
    manifest = sinks.replace_regions(first, path, 1, "parquet")
    assert rows(manifest) == [("north", 1, 1), ("south", 1, 2)]
    north = sorted(os.listdir(f"{path}/region=north"))
    late = spark.createDataFrame([(5, "South"), (6, "East"), (7, None)], schema)
    for _ in range(2):  # the same batch again changes nothing
        assert rows(sinks.replace_regions(late, path, 2, "parquet")) == [("east", 2, 1), ("north", 1, 1), ("south", 2, 1)]
        assert rows(spark.read.parquet(path), "job_id", "region") == [(1, "north"), (5, "south"), (6, "east")]
    assert sorted(os.listdir(f"{path}/region=north")) == north
    assert rows(sinks.replace_regions(late.limit(0), path, 3, "parquet")) == [("east", 2, 1), ("north", 1, 1), ("south", 2, 1)]
