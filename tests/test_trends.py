import random

import numpy as np
import pandas as pd
import pytest
from helpers import rows

from jobgrain.operators import trends


@pytest.fixture(scope="module")
def mention_data():
    random.seed(5)
    periods = ["2023-11", "2023-12", "2024-02", "2024-03", "2024-05", "2024-06"]
    data = []
    for i, p in enumerate(periods):
        data += [(p, "rising")] * (2 * i * i) + [(p, "falling")] * (30 - 5 * i) + [(p, "flat")] * 4
        data += [(p, f"rare{k}") for k in range(3) if random.random() < 0.5]
    return data + [("2024-03", "spiky")] * 40 + [(p, "steady") for p in periods[:-1] for _ in range(20)]


@pytest.fixture(scope="module")
def counts(spark, mention_data):
    return trends.trend_counts(spark.createDataFrame(mention_data, "period string, skill string")).cache()


@pytest.fixture(scope="module")
def wide(mention_data):
    df = pd.DataFrame(mention_data, columns=["period", "skill"])
    return df.groupby(["period", "skill"]).size().unstack(fill_value=0).sort_index()


def test_mentions_are_a_bag(spark):
    df = spark.createDataFrame([("2024-01-05", "a; a;b"), ("2024-04-30", None), (None, "a")], "d string, s string")
    df = df.selectExpr("CAST(d AS DATE) AS d", "s")
    assert rows(trends.mentions(df, "monthly", "d", "s")) == [("2024-01", "a"), ("2024-01", "a"), ("2024-01", "b")]
    assert rows(trends.mentions(df, "quarterly", "d", "s"))[0] == ("2024Q1", "a")
    with pytest.raises(ValueError):
        trends.mentions(df, "yearly", "d", "s")


def test_grid(counts, wide, mention_data):
    grid = trends.trend_grid(counts)
    assert {(r[0], r[1]): r[2] for r in grid.collect()} == {(p, s): wide.loc[p, s] for p in wide.index for s in wide.columns}
    assert grid.groupBy().sum("count").first()[0] == len(mention_data)
    names = list(wide.columns)
    assert rows(trends.long_grid(trends.wide_grid(counts, names)).select(*grid.columns)) == rows(grid)


def test_growth(counts, wide):
    found = {r["skill"]: r for r in trends.growth_metrics(counts).collect()}
    assert set(found) == set(wide.columns)
    for skill, r in found.items():
        s = wide[skill]
        first, last = s.head(3).mean(), s.tail(3).mean()
        assert r["total_mentions"] == s.sum()
        assert r["mean_per_period"] == pytest.approx(s.mean()) and r["std_per_period"] == pytest.approx(s.std())
        assert r["growth_rate"] == pytest.approx((last - first) / first if first > 0 else 0.0)
        assert r["trend_slope"] == pytest.approx(np.polyfit(range(len(s)), s.values, 1)[0], abs=1e-9)
        assert r["volatility_cv"] == pytest.approx(s.std() / s.mean())
    assert found["rising"]["trend_direction"] == "increasing" and found["falling"]["trend_direction"] == "decreasing"
    assert found["flat"]["trend_direction"] == "stable"


def test_one_and_two_periods(spark):
    one = spark.createDataFrame([("2024-01", "a", 7)], "period string, skill string, count bigint")
    r = trends.growth_metrics(one).first()
    assert (r["trend_slope"], r["trend_direction"], r["std_per_period"], r["growth_rate"]) == (0.0, "stable", None, 0.0)
    assert trends.anomalies(one).isEmpty()
    two = spark.createDataFrame([("2024-01", "a", 2), ("2024-02", "a", 6)], "period string, skill string, count bigint")
    r = trends.growth_metrics(two).first()
    assert (r["first_period_avg"], r["last_period_avg"], r["trend_slope"]) == (4.0, 4.0, pytest.approx(4.0))


def test_emerging_and_declining(counts):
    growth = trends.growth_metrics(counts)
    assert [r["skill"] for r in trends.emerging(growth).collect()][0] == "rising"
    assert "falling" in [r["skill"] for r in trends.declining(growth).collect()]
    everything = [r["growth_rate"] for r in trends.declining(growth).collect()]
    assert everything == sorted(everything, reverse=True)
    assert trends.declining(growth, 1).first()["growth_rate"] == min(everything)
    assert all(r["growth_rate"] > 0 for r in trends.positive_growth(growth).collect())


@pytest.mark.parametrize("threshold", [0.5, 1.5, 2.0])
def test_anomalies(counts, wide, threshold):
    expected = set()
    for skill in wide.columns:
        s = wide[skill]
        if s.sum() >= 5 and s.std() > 0:
            for period, z in ((s - s.mean()) / s.std()).items():
                if abs(z) > threshold:
                    expected.add((skill, period, s[period], "spike" if z > 0 else "drop"))
    found = set(rows(trends.anomalies(counts, threshold), "skill", "period", "count", "anomaly_type"))
    assert found == expected
    assert ("steady", "2024-06", 0, "drop") in found


def test_summary_and_series(counts, wide):
    r = trends.trend_summary(counts).first()
    per_period = wide.sum(axis=1)
    assert (r["num_periods"], r["num_skills"], r["total_skill_mentions"]) == (*wide.shape, wide.values.sum())
    assert (r["min_jobs_per_period"], r["max_jobs_per_period"]) == (per_period.min(), per_period.max())
    assert (r["date_range_start"], r["date_range_end"]) == ("2023-11", "2024-06")
    series = trends.top_skill_series(counts, 2)
    top = wide.sum().sort_values(ascending=False).head(2).index
    assert {(r["period"], r["skill"]): r["count"] for r in series.collect()} == {(p, s): wide.loc[p, s] for p in wide.index for s in top}


def test_share(spark):
    df = spark.createDataFrame([("2024-01-01", ["a", "b"]), ("2024-01-02", ["a"]), ("2024-01-03", []), ("2024-02-01", ["b"])], "d string, skills array<string>")
    df = df.selectExpr("CAST(d AS DATE) AS d", "skills")
    found = {(r[0], r[1]): (r[2], r[3]) for r in trends.trend_share(df, "monthly", "d").collect()}
    assert found[("2024-01", "a")] == (2, pytest.approx(200 / 3)) and found[("2024-02", "b")] == (1, 100.0) and len(found) == 3
