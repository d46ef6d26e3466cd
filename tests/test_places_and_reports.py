import re

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from bindings import spans as bound
from jobgrain.operators import geography as geo, reports, spans


@pytest.fixture(scope="module")
def jobs(spark):
    data = [
        (1, "Bangalore", "Co1", ["a", "b"], 1e5, 3e5, 1), (2, "bangalore", "Co1", ["a"], 2e5, 4e5, 2),
        (3, "Nashik", "Co2", [], None, 5e5, 0), (4, "Atlantis", None, ["b", "c"], 4e5, 6e5, None),
        (5, None, "Co2", ["a"], 5e5, 7e5, 12), (6, "Unknown", "Co2", ["c"], 1e6, 3e6, 10),
    ]
    df = spark.createDataFrame(
        data, "job_id int, location_normalized string, company string, skills array<string>, salary_min double, "
        "salary_max double, experience_years int",
    )
    return geo.enrich_locations(df).withColumn("num_skills", F.size("skills"))


def test_places(jobs, spark):
    assert rows(jobs.select("job_id", "city_tier", "region")) == [
        (1, "Tier-1", "South"), (2, "Tier-1", "South"), (3, "Tier-2", "West"), (4, "Other", "Other"),
        (5, "Unknown", "Unknown"), (6, "Other", "Other"),
    ]
    cities = geo.city_dimension(spark, geo.CITY_TIERS, "tier")
    assert cities.count() == 30 and cities.filter("city = 'varanasi' AND tier = 'Tier-2'").count() == 1
    assert {c for cs in geo.REGIONS.values() for c in cs} == {c for cs in geo.CITY_TIERS.values() for c in cs}


def test_counts_and_means(jobs):
    assert {(r["kind"], r["name"]): r["count"] for r in geo.group_counts(jobs).collect()}[("tier", "Other")] == 2
    tiers = {r["tier"]: r for r in geo.tier_stats(jobs).collect()}
    assert tiers["Tier-1"]["avg_salary_min"] == 1.5e5 and tiers["Tier-2"]["avg_salary_min"] is None
    assert sum(r["job_count"] for r in tiers.values()) == 6
    places = {r["location"]: r for r in geo.location_stats(jobs).collect()}
    assert None not in places and places["Atlantis"]["tier"] == "Other" and places["Bangalore"]["region"] == "South"
    sets = geo.geo_grouping_sets(jobs)
    for level, single in (("location", geo.location_stats(jobs)), ("tier", geo.tier_stats(jobs)), ("region", geo.region_stats(jobs))):
        assert rows(sets.filter(F.col("level") == level), "name", "job_count", "avg_skills") == rows(single, level, "job_count", "avg_skills")


def test_skills_by_location(jobs):
    text = jobs.withColumn("extracted_skills", F.array_join("skills", ";"))
    for df, column in ((jobs, "skills"), (text, "extracted_skills")):
        found = rows(geo.skills_by_location(df, skills_column=column), "location", "skill", "count", "percentage")
        assert ("Bangalore", "a", 1, 100.0) in found and not [r for r in found if r[0] in (None, "Unknown")]
    assert rows(geo.skills_by_location(jobs, skills_column="skills", top_n=1), "location", "skill") == [
        ("Atlantis", "b"), ("Bangalore", "a"), ("bangalore", "a"),
    ]
    assert ("Nashik", 1, "") in rows(geo.city_cards(jobs, skills_column="skills"))


def test_histograms(jobs, spark):
    values = [float(v) for v in np.random.default_rng(1).gamma(2, 10, 500)]
    found = reports.histogram(spark.createDataFrame([(v,) for v in values], "v double"), "v").orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=20)
    assert [r["count"] for r in found] == list(counts)
    assert [r["lower"] for r in found] + [found[-1]["upper"]] == pytest.approx(list(edges))
    same = reports.histogram(spark.createDataFrame([(3.0,)] * 4, "v double"), "v").filter("count > 0").collect()
    assert len(same) == 1 and same[0]["bin"] == 10
    assert rows(reports.experience_histogram(jobs)) == [(0, 1), (1, 1), (2, 1), (9, 1)]


def test_salary_tables(spark):
    generator = np.random.default_rng(2)
    data = [(f"c{c}", float(x), float(x) + 1e5) for c in range(6) for x in generator.lognormal(13, 1, 20 + c)]
    df = spark.createDataFrame(data, "location_normalized string, salary_min double, salary_max double")
    boxes = {r["location"]: r for r in reports.salary_boxplot(df).collect()}
    assert set(boxes) == {f"c{c}" for c in range(1, 6)}
    for name, box in boxes.items():
        v = np.array([(a + b) / 2 / 1e5 for c, a, b in data if c == name])
        q1, median, q3 = np.quantile(v, [0.25, 0.5, 0.75])
        assert [box["q1"], box["median"], box["q3"]] == pytest.approx([q1, median, q3])
        assert box["whisker_low"] == pytest.approx(v[v >= q1 - 1.5 * (q3 - q1)].min())
        assert box["whisker_high"] == pytest.approx(v[v <= q3 + 1.5 * (q3 - q1)].max())
    center = reports.salary_center(df).first()
    everything = [(a + b) / 2 / 1e5 for _, a, b in data]
    assert center["median_salary"] == pytest.approx(np.median(everything)) and center["mean_salary"] == pytest.approx(np.mean(everything))


def test_small_reports(jobs):
    assert rows(reports.value_counts(jobs, "city_tier", "tier", 1)) == [("Other", 2)]
    assert sum(r["percentage"] for r in reports.shares(jobs, "region", "name").collect()) == pytest.approx(100)
    assert reports.experience_center(jobs).first() == (2.0, 5.0)
    head = reports.headline(jobs, day="job_id").first().asDict()
    assert (head["total_jobs"], head["unique_skills"], head["unique_locations"]) == (6, 3, 5)
    diversity = jobs.select("job_id", reports.skill_diversity(F.col("num_skills"), F.col("experience_years")).alias("d"))
    assert rows(diversity) == [(1, 2.0), (2, 0.5), (3, None), (4, None), (5, 1 / 12), (6, 0.1)]
    means = reports.with_group_average(jobs, "company", "num_skills", "m")
    assert rows(means, "job_id", "m") == [(1, 1.5), (2, 1.5), (3, 2 / 3), (4, 2.0), (5, 2 / 3), (6, 2 / 3)]
    top = reports.top_skill_per_location(geo.location_skill_counts(jobs, skills_column="skills"))
    assert ("Atlantis", 1, "b") in rows(top)
    cells = reports.skills_by_group(jobs, "region", top_n=1)
    assert {r["skill"] for r in cells.collect()} == {"a"}
    shared = reports.share_within(reports.skills_by_group(jobs, "region"), "region")
    assert rows(shared.filter("region = 'South'"), "skill", "percentage") == [("a", pytest.approx(200 / 3)), ("b", pytest.approx(100 / 3))]
    assert rows(reports.top_within(jobs, "region", "company", 1).filter("region = 'South'")) == [("South", "Co1", 2, 1)]
    assert reports.salary_of_skill(jobs, "c").first() == (2, 4e5, 1_250_000.0, 3e6)
    assert rows(jobs.select("job_id", reports.primary_skill(F.col("skills"), ["c", "a"]).alias("p")))[3] == (4, "c")


def test_growth_and_posting_line(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-03-10')) AS d")
    assert reports.growth_between(days, "d", "2024-02-01", "2024-03-01").first() == (10, 31, pytest.approx(-21 / 31))
    assert reports.growth_between(days, "d", "2020-01-01", "2024-03-01").first()[2] is None
    line = reports.posting_trend(days, "d").orderBy("ordinal").collect()
    assert [r["count"] for r in line] == [31, 29, 10]
    assert [r["fitted"] for r in line] == pytest.approx(list(np.polyval(np.polyfit([0, 1, 2], [31, 29, 10], 1), [0, 1, 2])))


def test_spans(spark):
    df = spark.createDataFrame(
        [(1, "Python, SQL and Pandas", [(0, 6, "SKILL"), (8, 11, "SKILL"), (7, 11, "SKILL"), (16, 20, "SKILL"), (16, 99, "SKILL")]), (2, "x", [])],
        "doc_id int, text string, entities array<struct<start:int, end:int, label:string>>",
    )
    found = spans.check_spans(spans.spans(df))
    assert rows(found, "start", "end", "surface", "is_valid") == [
        (0, 6, "Python", True), (16, 20, "Pand", False), (16, 99, "Pandas", False), (7, 11, " SQL", False), (8, 11, "SQL", True),
    ]


def test_spans_are_checked_beside_their_text(spark):
    """Spans anywhere in a long text, across blocks, outside of it and null: as rows and as arrays, and as plain Python has them."""
    text = "é, Σx  (y) " * 300 + "end"
    n = len(text)
    places = [(a, b) for a in [*range(-3, 14), *range(1018, 1030), *range(n - 4, n + 3)] for b in (a - 1, a, a + 1, a + 3, a + 1500)]
    schema = "doc_id int, text string, entities array<struct<start:int, end:int, label:string>>"
    given = [(1, text, [(a, b, "S") for a, b in places]), (2, "", [(0, 1, "S")]), (3, None, [(0, 1, "S")]), (4, "ab", []), (5, "ab", None)]
    df = spark.createDataFrame(given, schema)
    word = str.isalnum

    def valid(t, a, b):
        if not 0 <= a < b <= len(t):
            return False
        cut = a > 0 and word(t[a - 1]) and word(t[a]) or b < len(t) and word(t[b - 1]) and word(t[b])
        return not cut and not t[a].isspace() and not t[b - 1].isspace()

    checked = spans.check_entities(df)
    assert checked.columns == ["doc_id", "start", "end", "label", "is_valid"]
    got = rows(checked.drop("label"))
    texts = {i: t for i, t, _ in given}
    assert got == sorted(
        [(i, a, b, texts[i] is not None and valid(texts[i], a, b)) for i, _, e in given for a, b, _ in e or []],
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )
    unfolded = spans.spans(df)
    assert rows(spans.check_spans(unfolded), "doc_id", "start", "end", "is_valid") == got
    inside = unfolded.filter("doc_id = 1 AND start >= 0 AND `end` >= start").collect()
    assert inside and all(r.surface == text[r.start : r.end] for r in inside)


def test_span_queries_bring_no_text_through_a_shuffle(spark):
    sf = "/root/testdata/sf0.001"
    for name in ("span_check", "weak_labels"):
        assert "Exchange" not in bound.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    tables = re.findall(r"documents[.]parquet", bound.QUERIES["span_prf"](spark, sf)._jdf.queryExecution().executedPlan().toString())
    assert not tables  # gold and predicted are read from the table of offsets


def test_span_scores(spark):
    schema = "doc_id int, start int, `end` int, label string"
    gold = spark.createDataFrame([(1, 0, 3, "S"), (1, 5, 8, "S"), (2, 0, 3, "S")], schema)
    predicted = spark.createDataFrame([(1, 0, 3, "S"), (1, 0, 3, "S"), (1, 5, 9, "S")], schema)
    assert spans.span_scores(gold, predicted).first() == (0.5, pytest.approx(1 / 3), pytest.approx(0.4), 1, 1, 2)
    assert spans.span_scores(gold.limit(0), predicted.limit(0)).first() == (0.0, 0.0, 0.0, 0, 0, 0)


def test_vote(spark):
    make = lambda *pairs: spark.createDataFrame(list(pairs), "doc_id int, skill string")
    sources = [make((1, "a"), (1, "b")), make((1, "a"), (1, "a"), (2, "c")), make((1, "b"), (1, "a"))]
    assert rows(spans.vote(sources)) == [(1, "a", 3), (1, "b", 2), (2, "c", 1)]
    assert rows(spans.vote(sources, 2)) == [(1, "a", 3), (1, "b", 2)]
