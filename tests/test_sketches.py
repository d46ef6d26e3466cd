import pytest
from helpers import rows
from pyspark.sql import functions as F

from jobgrain.operators import sketches


def postings(spark, start, end):
    return spark.range(start, end).select(
        F.format_string("2024-%02d", F.col("id") % 12 + 1).alias("period"),
        F.when(F.col("id") % 3 != 0, "Pune").otherwise(F.lit(None)).alias("place"),
        F.concat(F.lit("c"), F.col("id") % 40_000).alias("company"),
        F.when(F.col("id") % 2 == 0, F.col("id").cast("double")).alias("pay"),
    )


def test_estimates_are_near_and_merging_equals_one_pass(spark):
    df = postings(spark, 0, 120_000)
    fine = sketches.distinct_sketches(df, ["period", "place"], ["company", "pay"])
    found = sketches.distinct_estimates(sketches.merge_sketches(fine, ["place"]))
    exact = df.groupBy("place").agg(F.count("*").alias("rows"), F.count_distinct("company").alias("c"), F.count_distinct("pay").alias("p"))
    want = {r["place"]: r for r in exact.collect()}
    for r in found.collect():
        assert r["rows"] == want[r["place"]]["rows"]
        assert r["distinct_company"] == pytest.approx(want[r["place"]]["c"], rel=0.02)
        assert r["distinct_pay"] == pytest.approx(want[r["place"]]["p"], rel=0.02)
    parts = sketches.distinct_sketches(postings(spark, 0, 50_000), ["place"], ["company"]).unionByName(
        sketches.distinct_sketches(postings(spark, 50_000, 120_000), ["place"], ["company"])
    )
    whole = sketches.distinct_estimates(sketches.distinct_sketches(df, ["place"], ["company"]))
    assert rows(sketches.distinct_estimates(sketches.merge_sketches(parts, ["place"]))) == rows(whole)


def test_no_keys_nulls_and_no_rows(spark):
    df = spark.createDataFrame([("a", None), ("a", 1), (None, 1)], "company string, n int")
    one = sketches.distinct_estimates(sketches.distinct_sketches(df, [], ["company", "n"]))
    assert rows(one) == [(3, 1, 1)]
    assert sketches.distinct_sketches(df.limit(0), ["company"], ["n"]).count() == 0
