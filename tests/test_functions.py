import random

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from jobgrain.functions import dates, quantiles, salary, text
from jobgrain.functions.hashing import hash_percent, split_name
from jobgrain.functions.quantiles import exact_quantiles
from jobgrain.functions.rowids import with_row_number


def apply(spark, values, function, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["out"] for r in df.withColumn("out", function(F.col("v"))).orderBy("i").collect()]


def test_normalize_text(spark):
    given = ["  HELLO   World ", "a\tb\n c", "", "   ", None]
    assert apply(spark, given, text.normalize_text) == ["hello world", "a b c", "", "", ""]


@pytest.mark.parametrize("name,spellings", list(text.TITLE_SYNONYMS.items()))
def test_title_spellings(spark, name, spellings):
    given = [s.upper() for s in spellings] + [f"  {s} " for s in spellings]
    assert set(apply(spark, given, text.normalize_title)) == {name}


@pytest.mark.parametrize("name,spellings", list(text.CITY_SYNONYMS.items()))
def test_city_spellings(spark, name, spellings):
    assert set(apply(spark, [s.title() for s in spellings], text.normalize_location)) == {name}


def test_unknown_names(spark):
    assert apply(spark, ["chief  cook", None, ""], text.normalize_title) == ["Chief Cook", "Unknown", "Unknown"]
    assert apply(spark, ["small town", None], text.normalize_location) == ["Small Town", "Unknown"]


def test_tokens(spark):
    given = ["Node.js, C++ and C#!", "CI/CD problem-solving", "Élan vital. End", "", None]
    assert apply(spark, given, text.tokens) == [
        ["node.js", ",", "c++", "and", "c#", "!"],
        ["ci", "/", "cd", "problem", "-", "solving"],
        ["élan", "vital", ".", "end"],
        [],
        None,
    ]


def test_parse_date(spark):
    given = ["2024-01-15", "15-01-2024", "01/15/2024", "15/01/2024", "January 15, 2024", "Jan 15, 2024", " 2024-1-15 "]
    assert {str(d) for d in apply(spark, given, dates.parse_date)} == {"2024-01-15"}
    assert str(apply(spark, ["05/03/2024"], dates.parse_date)[0]) == "2024-05-03"
    assert apply(spark, ["not a date", None, "", "2024-13-45"], dates.parse_date) == [None] * 4


def test_periods(spark):
    df = spark.sql("SELECT DATE'2024-11-05' AS d")
    assert df.select(dates.period_label(F.col("d"), "monthly")).first()[0] == "2024-11"
    assert df.select(dates.period_label(F.col("d"), "quarterly")).first()[0] == "2024Q4"
    with pytest.raises(ValueError):
        dates.period_label(F.col("d"), "weekly")
    assert dates.add_date_parts(df, "d").first()[1:] == (2024, 11, "Q4")


def test_date_range(spark):
    df = spark.sql("SELECT explode(sequence(DATE'2023-12-31', DATE'2024-01-04')) AS d")
    assert dates.within_dates(df, "d", "2024-01-01", "2024-01-03").count() == 3
    for start, end in (("2024-02-01", "2024-01-01"), ("yesterday", "2024-01-01")):
        with pytest.raises(ValueError):
            dates.within_dates(df, "d", start, end)


def test_clean_salary(spark):
    given = ["1000000", "1,000,000", "₹1000000", "$1000000", "10L", "10 lakhs", "1000k", "800000-1200000", "8L - 12L", "1 lakh"]
    assert apply(spark, given, salary.clean_salary) == [1_000_000.0] * 9 + [100_000.0]
    assert apply(spark, ["invalid", None, "", "1-2-3", "L", "10x"], salary.clean_salary) == [None] * 6
    assert apply(spark, [1_000_000], salary.clean_salary, "bigint") == [1_000_000.0]
    assert apply(spark, [1_250_000.5, 1e7], salary.clean_salary, "double") == [1_250_000.5, 1e7]


def test_salary_bands(spark):
    given = [499_999.0, 500_000.0, 1_000_000.0, 1_500_000.0, None]
    assert apply(spark, given, salary.salary_category, "double") == [
        "Entry (<5L)", "Mid (5-10L)", "Senior (10-15L)", "Expert (>15L)", "Expert (>15L)",
    ]
    assert apply(spark, [99_999.0, 100_000.0, 1e7, 1e7 + 1], salary.is_plausible_salary, "double") == [
        False, True, True, False,
    ]


def test_hash_split_is_stable(spark):
    df = spark.range(5000).withColumn("b", hash_percent(F.col("id"))).withColumn(
        "s", split_name(F.col("id"), {"train": 80, "dev": 20})
    )
    again = spark.range(0, 5000, 1, 7).withColumn("b", hash_percent(F.col("id"))).select("id", "b")
    assert df.select("id", "b").exceptAll(again).isEmpty()
    assert df.agg(F.min("b"), F.max("b")).first() == (0, 99)
    assert 0.77 < df.filter("s = 'train'").count() / 5000 < 0.83
    with pytest.raises(ValueError):
        split_name(F.col("id"), {"train": 80, "dev": 10})


def test_row_numbers(spark):
    df = spark.range(0, 1000, 1, 7).withColumn("k", (F.col("id") * 7919) % 1000)
    plain = with_row_number(df, "n", [F.col("id")])
    assert rows(plain.select("n")) == sorted(((i,) for i in range(1, 1001)), key=str)
    assert plain.filter("n != id + 1").isEmpty()
    assert with_row_number(df, "n", [F.col("k")]).filter("n != k + 1").isEmpty()
    with pytest.raises(ValueError, match="order_by"):
        with_row_number(df, "n", [])


@pytest.mark.parametrize("shape", ["uniform", "hot", "tail", "constant", "single"])
def test_exact_quantiles(spark, shape):
    random.seed(7)
    values = {
        "uniform": [random.uniform(0, 1e6) for _ in range(3000)],
        "hot": [5.0] * 2000 + [random.gauss(5, 1) for _ in range(1000)],
        "tail": [random.paretovariate(0.3) for _ in range(3000)],
        "constant": [3.0] * 50,
        "single": [42.0],
    }[shape]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 1.0), ("b", 2.0), ("c", None)], "g string, v double")
    probabilities = [0.0, 0.25, 0.5, 0.9, 1.0]
    grouped = {(r["g"], r["probability"]): r["quantile"] for r in exact_quantiles(df, "v", probabilities, ["g"]).collect()}
    alone = {r["probability"]: r["quantile"] for r in exact_quantiles(df.filter("g = 'a'"), "v", probabilities).collect()}
    for p in probabilities:
        assert grouped[("a", p)] == pytest.approx(np.quantile(values, p), rel=1e-12)
        assert alone[p] == pytest.approx(np.quantile(values, p), rel=1e-12)
        assert grouped[("b", p)] == pytest.approx(1 + p)
    assert len(grouped) == 2 * len(probabilities)


@pytest.mark.parametrize("accuracy", [10_000, 3])
def test_quantiles_from_brackets(spark, accuracy):
    rng = np.random.default_rng(11)
    groups = {"even": rng.integers(0, 9, 4_000).astype(float), "wide": np.exp(rng.normal(0, 30, 4_000)), "one": np.array([5.0]),
              "hot": np.concatenate([np.zeros(5_000), rng.normal(size=500)])}
    df = spark.createDataFrame([(g, float(v)) for g, values in groups.items() for v in values] + [("even", None), (None, 1.0)], "g string, v double")
    probabilities = [0.0, 0.0001, 0.25, 0.5, 0.75, 0.9999, 1.0]
    found = exact_quantiles(df, "v", probabilities, ["g"], accuracy=accuracy).collect()
    assert len(found) == len(groups) * len(probabilities)
    for r in found:
        assert r["quantile"] == pytest.approx(np.quantile(groups[r["g"]], r["probability"]), rel=1e-12)
    assert exact_quantiles(df.limit(0), "v", [0.5], ["g"]).count() == exact_quantiles(df.limit(0), "v", [0.5]).count() == 0


def test_brackets_leave_few_values(spark):
    rows = spark.range(200_000).select(F.rand(7).alias("_v"))
    brackets = quantiles._brackets(rows, [0.25, 0.5, 0.75], [], 10_000)
    folded = quantiles._folded(rows, brackets, [])
    assert folded.agg(F.sum("_w")).first()[0] == 200_000 and folded.count() < 1_000
    assert quantiles._located(folded, brackets, []).filter("_missed").count() == 0
