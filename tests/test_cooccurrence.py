import random
from collections import Counter
from itertools import combinations

import pytest
from helpers import rows
from pyspark.sql import functions as F

from jobgrain.operators import cooccurrence as co


@pytest.fixture(scope="module")
def sets():
    random.seed(11)
    names = [f"s{i:02d}" for i in range(30)]
    data = [random.sample(names, random.choice([0, 1, 2, 3, 6])) for _ in range(300)]
    return data + [names] * 3 + [["s01", "s02"]] * 150  # some very large sets, and one set a third of all postings


@pytest.fixture(scope="module")
def baskets(spark, sets):
    return spark.createDataFrame([(i, s) for i, s in enumerate(sets)], "job_id int, skills array<string>")


@pytest.fixture(scope="module")
def expected(sets):
    return Counter(p for s in sets for p in combinations(sorted(s), 2))


def test_split_skills(spark):
    df = spark.createDataFrame([(1, " a; b ;a;;"), (2, ""), (3, None)], "job_id int, extracted_skills string")
    assert rows(co.baskets(df).select("job_id", F.array_join("skills", "|").alias("s"))) == [(1, "a|b"), (2, ""), (3, "")]
    assert df.select(F.size(co.split_skills("extracted_skills"))).first()[0] == 3


def test_collect_baskets(spark):
    postings = spark.createDataFrame([(1,), (2,)], "job_id int")
    mentions = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b")], "job_id int, skill string")
    found = co.collect_baskets(postings, mentions)
    assert rows(found.select("job_id", F.array_join("skills", "|").alias("s"))) == [(1, "a|b"), (2, "")]


@pytest.mark.parametrize("inline", [512, 4, 1])
def test_pair_counts(baskets, expected, inline):
    found = {(r[0], r[1]): r[2] for r in co.pair_counts(baskets, inline).collect()}
    assert found == dict(expected)


def test_pairs_do_not_depend_on_partitions(baskets, expected):
    found = {(r[0], r[1]): r[2] for r in co.pair_counts(baskets.repartition(13)).collect()}
    assert found == dict(expected)


@pytest.mark.parametrize("block", [4096, 7])
def test_matrix_is_dense_and_symmetric(baskets, expected, block):
    cells = {(r[0], r[1]): r[2] for r in co.dense_matrix(baskets, block).collect()}
    assert len(cells) == 900
    assert all(cells[a, b] == cells[b, a] == expected.get((a, b), 0) for a, b in combinations(sorted({a for a, _ in cells}), 2))
    assert all(cells[a, a] == 0 for a in {a for a, _ in cells})


def test_wide_matrix(spark):
    baskets = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"])], "job_id int, skills array<string>")
    assert rows(co.wide_matrix(co.dense_matrix(baskets), ["a", "b"])) == [("a", 0, 1), ("b", 1, 0)]


@pytest.mark.parametrize("support", [None, 0.02, 0.05])
def test_association_metrics(baskets, sets, expected, support):
    n, counts = len(sets), Counter(x for s in sets for x in s)
    found = {(r["skill1"], r["skill2"]): r for r in co.association_metrics(baskets, support).collect()}
    kept = {p for p, c in expected.items() if support is None or c / n >= support}
    assert set(found) == kept and kept
    for (a, b), r in found.items():
        c = expected[a, b]
        assert r["support"] == c / n
        assert r["confidence_1_to_2"] == c / counts[a] and r["confidence_2_to_1"] == c / counts[b]
        assert r["lift"] == pytest.approx(c * n / (counts[a] * counts[b]))


def test_filters(baskets, expected):
    assoc = co.association_metrics(baskets)
    assert all(max(r["confidence_1_to_2"], r["confidence_2_to_1"]) >= 0.4 for r in co.confident(assoc, 0.4).collect())
    pairs = co.pair_counts(baskets)
    assert co.heatmap(pairs, 20).count() == sum(c >= 20 for c in expected.values())
    partners = dict(rows(co.partners(pairs, "s05")))
    assert partners == {(b if a == "s05" else a): c for (a, b), c in expected.items() if "s05" in (a, b)}
    lifts = [r["lift"] for r in co.by_lift(assoc).collect()]
    assert lifts == sorted(lifts, reverse=True)


def test_plan_shuffles_counts_not_pairs(baskets):
    plan = co.pair_counts(baskets)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "partial_count" in plan


@pytest.mark.parametrize("buckets", [1, 64, 100, 4096])
def test_two_passes_give_the_same_associations(spark, buckets):
    many = [(i, ["a", "b"] + [f"s{(i * 7 + k * k) % 60:02}" for k in range(12)]) for i in range(300)]
    sets = spark.createDataFrame(many, "job_id long, skills array<string>")
    assert rows(co.association_metrics(sets, 0.1, buckets)) == rows(co.association_metrics(sets, 0.1))
    left, every = co.in_frequent_buckets(sets, F.lit(30), buckets).count(), co.pairs_of(sets).count()
    assert left == every if buckets == 1 else left < every or buckets < 1000
