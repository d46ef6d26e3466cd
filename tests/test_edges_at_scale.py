"""Both sides of every switch, hostile values, and readers that must not lose rows."""

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from jobgrain.functions.quantiles import exact_quantiles
from jobgrain.operators import cleaning, cooccurrence as co, embedding, extraction, trends
from jobgrain.plans import jobs as plans
from jobgrain.sources import postings


@pytest.mark.parametrize("inline", [2_000, 0])
def test_phrases_keep_rows_apart(spark, small_lexicon, inline):
    texts = [(1, "python"), (1, "sql"), (None, "ml and c++"), (2, None), (2, "nothing"), (2, "nothing")]
    df = spark.createDataFrame([(t, i) for i, t in texts], "description_clean string, job_id int")
    found = extraction.extract_phrases(df, small_lexicon, inline_phrases=inline)
    assert found.columns == ["description_clean", "job_id", "skills"]
    expected = [["python"], ["sql"], ["c++", "machine learning"], [], [], []]
    assert rows(found) == sorted(((t, i, s) for (i, t), s in zip(texts, expected)), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("inline", [512, 2])
def test_repeated_items_count_once(spark, inline):
    sets = spark.createDataFrame([(["a", "a", "b"],), (["b", "a", "c", "c", "d"],), (["a"],), ([],), (None,)], "skills array<string>")
    expected = [("a", "b", 2), ("a", "c", 1), ("a", "d", 1), ("b", "c", 1), ("b", "d", 1), ("c", "d", 1)]
    assert rows(co.pair_counts(sets, inline)) == expected


@pytest.mark.parametrize("size", [64 * 1024**2, 0])
def test_vectors_rank_by_row(spark, size):
    texts = spark.createDataFrame([(1, [1.0, 0.1]), (1, [0.1, 1.0]), (None, [1.0, 1.0]), (2, None)], "job_id int, vector array<double>")
    skills = spark.createDataFrame([("x", [1.0, 0.0]), ("y", [0.0, 1.0]), ("z", [1.0, 1.0])], "skill string, vector array<double>")
    found = embedding.closest_skills(texts, skills, top_k=2, threshold=0.0, broadcast_bytes=size)
    assert rows(found, "job_id", "skill", "rank") == [(1, "x", 1), (1, "y", 1), (1, "z", 2), (1, "z", 2), (None, "x", 2), (None, "z", 1)]


def test_long_form_has_all_skills(spark):
    counts = spark.range(1500).select(F.lit("2024-01").alias("period"), F.col("id").cast("string").alias("skill"), F.lit(1).cast("bigint").alias("count"))
    assert trends.trend_grid(counts).count() == 1500


def test_trend_arithmetic_of_large_counts(spark):
    rng = np.random.default_rng(1)
    cells = {"huge": [4_000_000_000 + int(x) for x in rng.integers(-5, 5, 80)], "close": [100_000_000 + int(x) for x in rng.integers(0, 4, 80)],
             "gaps": [100_000_000 * int(x) for x in rng.integers(0, 2, 80)]}
    data = [(f"{2000 + p // 12}-{p % 12 + 1:02d}", s, c) for s, values in cells.items() for p, c in enumerate(values) if c]
    counts = spark.createDataFrame(data, "period string, skill string, count long")
    found = {r["skill"]: r for r in trends.growth_metrics(counts).collect()}
    for skill, values in cells.items():
        assert found[skill]["std_per_period"] == pytest.approx(np.std(values, ddof=1), rel=1e-6 if skill == "huge" else 1e-9)
        assert found[skill]["total_mentions"] == sum(values)
    expected = sum(abs((c - np.mean(v)) / np.std(v, ddof=1)) > 2 for v in cells.values() for c in v)
    assert trends.anomalies(counts).count() == expected


@pytest.mark.parametrize("rest", [50_000, 100])
def test_outliers_do_not_widen_the_last_step(spark, rest):
    values = [*np.random.default_rng(3).random(20_000), 1e6, 1e9, 1e12, -1e300, 1e300]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    found = {r["probability"]: r["quantile"] for r in exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.999, 1.0], rest=rest).collect()}
    for p, q in found.items():
        assert q == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_duplicates_need_their_keys(spark):
    df = spark.createDataFrame([(1, "t", "one"), (2, "t", "two")], "job_id int, title string, description string")
    for keys in (None, ["title", "company"], []):
        with pytest.raises(ValueError, match="duplicates"):
            cleaning.remove_duplicates(df, keys)
    with pytest.raises(ValueError, match="company"):
        cleaning.preprocess(df)
    assert cleaning.preprocess(df, remove_dups=False).count() == 2
    assert cleaning.preprocess(df, dedup_keys=["title"]).count() == 1


def test_blank_means_blank(spark):
    df = spark.createDataFrame([("\t\n", "x"), (" ", "x"), ("t", "  \r"), ("t", "x"), (None, "x")], "title string, description string")
    assert cleaning.drop_incomplete(df).count() in (1, 2)
    assert cleaning.drop_incomplete(df.filter("title is null or title != 't'")).count() == 0


def test_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text('title,job_id,experience_years,salary_min,description,own\n"a b",7,3.0,10L,"line one\nline ""two""",z\nc,8,x,,d,\n')
    df = postings.read_postings(spark, str(path))
    assert df.columns == ["job_id", "title", "description", "salary_min", "experience_years", "own"]
    assert rows(df) == [(7, "a b", 'line one\nline "two"', "10L", 3, "z"), (8, "c", "d", None, None, None)]
    cleaned = {r["job_id"]: r for r in cleaning.preprocess(df, remove_dups=False).collect()}
    assert cleaned[7]["salary_min"] == 1_000_000.0 and cleaned[7]["description_clean"] == 'line one line "two"'


def test_broken_files_fail_loudly(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "1.csv").write_text('title,description\nx,"one\ntwo"\n')
    with pytest.raises(Exception, match="MALFORMED|CSV"):
        postings.read_postings(spark, str(tmp_path / "a"), multi_line=False).collect()
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "1.csv").write_text("title,description\nx,y\n")
    (tmp_path / "b" / "2.csv").write_text("description,title\ny,x\n")
    with pytest.raises(Exception, match="(?i)header"):
        postings.read_postings(spark, str(tmp_path / "b")).collect()


def test_numbers_follow_file_names(spark, tmp_path):
    for name, size in (("a", 3), ("b", 4000), ("c", 50)):
        (tmp_path / f"{name}.csv").write_text("Job Title,Extra\n" + "".join(f"{name}{i},{'x' * 50}\n" for i in range(size)))
    found = postings.import_foreign_csv(spark, str(tmp_path))
    order = [r["title"] for r in found.orderBy("job_id").collect()]
    assert order == [f"a{i}" for i in range(3)] + [f"b{i}" for i in range(4000)] + [f"c{i}" for i in range(50)]
    with pytest.raises(ValueError, match="order_by"):
        postings.map_foreign_columns(found.drop("job_id"))


def test_jobs_read_such_files(spark, small_lexicon, tmp_path):
    path = tmp_path / "p.csv"
    header = "description,title,company,location,posted_date,job_id,salary_min,salary_max,experience_years,job_type\n"
    path.write_text(header + "".join(f'"python\nand sql {i}",ml engineer,Co {i % 3},Pune,2024-0{1 + i % 6}-1{i % 10},{i},{i + 5}L,,2.0,x\n' for i in range(40)))
    tables = plans.run_all(postings.read_postings(spark, str(path)), small_lexicon, str(tmp_path / "out"))
    got = tables["jobs_with_skills"]
    assert got.count() == got.filter("size(skills) = 2").count() == 30  # ten share title, company, place and date


@pytest.mark.parametrize("inline", [2_000, 0])
def test_offsets_and_phrases_agree(spark, inline):
    lexicon = spark.createDataFrame([("İstanbul", "Place", None, "big city"), ("x", "Other", None, None)], "skill_name string, category string, subcategory string, aliases string")
    texts = [(1, "In İSTANBUL, a  Big  City x"), (1, "x"), (None, "istanbul and İstanbul"), (2, None), (3, "é x" * 400)]
    df = spark.createDataFrame(texts, "job_id int, t string")
    spans = extraction.phrase_offsets(df, lexicon, "t", "job_id", inline).collect()
    for s in spans:
        assert any(s["job_id"] == i and t is not None and t[s["start"] : s["end"]] == s["surface"] for i, t in texts)
    assert sorted((str(s["job_id"]), s["skill"]) for s in spans if s["job_id"] != 3) == [
        ("1", "i̇stanbul"), ("1", "i̇stanbul"), ("1", "x"), ("1", "x"), ("None", "i̇stanbul")
    ]
    assert sum(s["job_id"] == 3 for s in spans) == 1
    found = extraction.extract_phrases(df, lexicon, "t", inline_phrases=inline)
    assert rows(found, "job_id", "skills") == [(1, ["i̇stanbul", "x"]), (1, ["x"]), (2, []), (3, ["x"]), (None, ["i̇stanbul"])]


def test_a_large_lexicon_is_one_join(spark):
    lexicon = spark.range(10_000).select(
        F.concat(F.lit("word"), "id").alias("skill_name"), F.lit("c").alias("category"), F.lit(None).cast("string").alias("subcategory"),
        F.concat(F.lit("two word"), "id").alias("aliases"),
    )
    df = spark.createDataFrame([(1, "word7 and two word9999, word10000")], "job_id int, t string")
    found = extraction.phrase_offsets(df, lexicon, "t", "job_id")
    assert rows(found, "start", "end", "skill") == [(0, 5, "word7"), (10, 22, "word9999"), (14, 22, "word9999")]


def test_job_options_and_side_tables(spark, small_lexicon, tmp_path, shared_folder):
    df = spark.createDataFrame(
        [(i, ["python", "sql"] if i % 2 else ["python"], "python", 1, "T", "Pune") for i in range(30)],
        "job_id int, skills array<string>, extracted_skills string, num_skills int, title string, location_normalized string",
    )
    tables = plans.cooccurrence_job(df, str(tmp_path / "o"), min_confidence=0.9, matrix="wide")
    assert tables["associations"].count() == 1 and tables["cooccurrence_wide"].columns == ["skill1", "python", "sql"]
    assert plans.cooccurrence_job(df, str(tmp_path / "s"))["cooccurrence"].columns == ["skill1", "skill2", "cooccurrence_count"]
    cleaned = spark.createDataFrame([(1, "python and sql"), (2, "python")], "job_id int, description_clean string")
    jobs = plans.extract_job(cleaned, small_lexicon, str(tmp_path / "e"), top_flags=1)
    assert [c for c in jobs.columns if c.startswith("has_")] == ["has_python"]
    for name in ("skill_statistics", "skills_by_category", "jobs_main"):
        assert spark.read.parquet(str(tmp_path / "e" / name)).count() > 0
    import glob

    assert not glob.glob(f"{shared_folder}/job-*")
