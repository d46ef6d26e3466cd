"""Skill lexicon: canonical names, their categories and the phrases that stand for them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobgrain.functions.text import phrase_key, tokens
from jobgrain.sources.postings import csv_options

LEXICON_SCHEMA = "skill_name STRING, category STRING, subcategory STRING, aliases STRING"


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.options(**csv_options()).schema(LEXICON_SCHEMA).csv(path)


def lexicon_phrases(lexicon: DataFrame) -> DataFrame:
    """One row per skill and distinct phrase: the lower-cased name itself plus its comma-separated aliases.

    A skill may come as one row with all its aliases or as many rows with some each.
    """
    name = F.trim(F.lower("skill_name"))
    aliases = F.transform(F.split(F.coalesce(F.lower("aliases"), F.lit("")), ","), lambda s: F.trim(s))
    spellings = F.array_distinct(F.concat(F.array(name), F.filter(aliases, lambda a: a != "")))
    return lexicon.select(
        name.alias("skill"), "category", "subcategory", F.explode(spellings).alias("phrase")
    ).distinct()


def phrase_keys(lexicon: DataFrame) -> DataFrame:
    """Phrases as the matcher compares them: (skill, phrase_key, first_token, n_tokens)."""
    return (
        lexicon_phrases(lexicon)
        .select(
            "skill",
            phrase_key(F.col("phrase")).alias("phrase_key"),
            F.try_element_at(tokens(F.col("phrase")), F.lit(1)).alias("first_token"),
            F.size(tokens(F.col("phrase"))).alias("n_tokens"),
        )
        .filter(F.col("n_tokens") > 0)
        .distinct()
    )
