"""Skill sets per posting, pair counts and association measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobgrain.functions.arrays import unfold
from jobgrain.session import cut_lineage

# Default thresholds.
MIN_SUPPORT = 0.02
TOP_ASSOCIATIONS = 100

# Sets above this size are cut into blocks whose pairs are spread over tasks.
INLINE_SET = 512
# Right-hand blocks of a dense table.
DENSE_BLOCK = 4_096


def split_skills(column: Column | str) -> Column:
    """Trimmed non-empty items of a ``;`` list, in order and with repeats; null gives an empty array."""
    items = F.transform(F.split(F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")), ";"), lambda s: F.trim(s))
    return F.filter(items, lambda s: s != "")


def baskets(df: DataFrame, skills_column: str = "extracted_skills", id_column: str = "job_id") -> DataFrame:
    """(id, skills): the set of skills of every posting, also of those without any."""
    return df.select(id_column, F.array_distinct(split_skills(skills_column)).alias("skills"))


def collect_baskets(postings: DataFrame, mentions: DataFrame, id_column: str = "job_id") -> DataFrame:
    """Baskets from (id, skill) rows: repeats fold map-side, so a hot posting shuffles its vocabulary only."""
    sets = mentions.groupBy(id_column).agg(F.array_sort(F.collect_set("skill")).alias("skills"))
    empty = F.array().cast("array<string>")
    return postings.select(id_column).join(sets, id_column, "left").withColumn("skills", F.coalesce("skills", empty))


def skill_counts(basket_df: DataFrame) -> DataFrame:
    return (
        unfold(basket_df, "skills", "skill").groupBy("skill").agg(F.count("*").alias("skill_count"))
    )


def pairs_of(basket_df: DataFrame, inline_set: int = INLINE_SET) -> DataFrame:
    """(skill1, skill2) for every unordered pair of every posting, skill1 < skill2.

    Pairs are formed inside the row of a posting. A set larger than ``inline_set`` is cut into blocks;
    each pair of blocks becomes a row of its own and is spread over the cluster before its pairs are formed. Repeated
    items of a set count once.
    """
    sets = basket_df.select(F.array_sort(F.array_distinct("skills")).alias("skills")).filter(F.size("skills") > 1)
    inline = (
        sets.filter(F.size("skills") <= inline_set)
        .select("skills", F.posexplode_outer("skills").alias("i", "skill1"))
        .select("skill1", F.explode_outer(F.slice("skills", F.col("i") + 2, F.size("skills"))).alias("skill2"))
    )
    last = F.floor((F.size("skills") - 1) / inline_set).cast("int")
    block = lambda b: F.slice("skills", b * inline_set + 1, F.lit(inline_set))
    split = (
        sets.filter(F.size("skills") > inline_set)
        .withColumn("_a", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("_b", F.explode(F.sequence(F.col("_a"), last)))
        .select(block(F.col("_a")).alias("left"), block(F.col("_b")).alias("right"))
        .repartition(F.xxhash64("left", "right"))
        .select("right", F.explode("left").alias("skill1"))
        .select("skill1", F.explode("right").alias("skill2"))
        .filter(F.col("skill1") < F.col("skill2"))
    )
    return inline.filter(F.col("skill2").isNotNull()).unionByName(split)


def pair_counts(basket_df: DataFrame, inline_set: int = INLINE_SET) -> DataFrame:
    """Postings per unordered pair (skill1 < skill2).

    Pairs are summed in the stage that forms them, so what is shuffled is at most one row per task and distinct pair,
    never the pairs themselves.
    """
    return _counted(pairs_of(basket_df, inline_set))


def _counted(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("skill1", "skill2").agg(F.count("*").alias("cooccurrence_count"))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("skill1", "skill2"), F.lit(buckets))


def in_frequent_buckets(basket_df: DataFrame, least: Column, buckets: int, inline_set: int = INLINE_SET) -> DataFrame:
    """The pairs whose hash bucket holds at least ``least`` of all pairs: none that is so frequent itself is missing.

    A first pass forms the pairs and counts them by bucket, at most ``buckets`` sums in a task and in all. The frequent
    buckets become one row of ``buckets`` bits, which every task of the second pass gets.
    """
    sums = pairs_of(basket_df, inline_set).groupBy(_bucket(buckets).alias("bucket")).agg(F.count("*").alias("n"))
    words = (
        sums.filter(F.col("n") >= least)
        .groupBy(F.floor(F.col("bucket") / 64).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bucket % 64 as int))")).alias("bits"))
    )
    bits = cut_lineage(words.agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("words")))
    held = F.coalesce(F.element_at(bits.select("words").scalar(), F.floor(F.col("bucket") / 64).cast("int")), F.lit(0))
    return (
        pairs_of(basket_df, inline_set).withColumn("bucket", _bucket(buckets))
        .filter(F.getbit(held, F.col("bucket") % 64) == 1)
        .drop("bucket")
    )




def dense_matrix(basket_df: DataFrame, block: int = DENSE_BLOCK) -> DataFrame:
    """(skill1, skill2, count) for every ordered pair of known skills: symmetric, zero on the diagonal.

    The zero cells come from an equi-join of the skills with blocks of skills, and equal cells fold into one sum.
    """
    pairs = pair_counts(basket_df)
    cell = F.col("cooccurrence_count").alias("count")
    both = pairs.select("skill1", "skill2", cell).unionByName(
        pairs.select(F.col("skill2").alias("skill1"), F.col("skill1").alias("skill2"), cell)
    )
    names = unfold(basket_df, "skills", "skill").distinct()
    zeros = all_pairs(names, "skill", names, "skill", block).toDF("skill1", "skill2")
    return (
        both.unionByName(zeros.withColumn("count", F.lit(0).cast("bigint")))
        .groupBy("skill1", "skill2")
        .agg(F.sum("count").alias("count"))
    )


def all_pairs(left: DataFrame, left_column: str, right: DataFrame, right_column: str, block: int) -> DataFrame:
    """Every (left, right) combination for outputs that are dense by definition.

    The right side is packed into blocks of about ``block`` values. Left rows are sent once per block and unfold it
    in place, so the work is spread by block and left value.
    """
    number = F.greatest(F.ceil(right.agg(F.count("*")).scalar() / F.lit(block)), F.lit(1)).cast("int")
    packed = right.groupBy(F.pmod(F.hash(right_column), number).alias("_block")).agg(
        F.collect_list(right_column).alias("_values")
    )
    routed = left.select(
        F.col(left_column).alias("_left"), F.explode(F.sequence(F.lit(0), number - 1)).alias("_block")
    )
    return routed.join(packed, "_block").select("_left", F.explode("_values").alias("_right"))


def wide_matrix(matrix: DataFrame, names: list[str]) -> DataFrame:
    """Square table for a file sink; the column list is given, so no extra pass looks for it."""
    return matrix.groupBy("skill1").pivot("skill2", names).agg(F.first("count")).orderBy("skill1")


def association_metrics(basket_df: DataFrame, min_support: float | None = None, buckets: int | None = None) -> DataFrame:
    """Support, both confidences and lift of every pair seen together.

    With ``min_support`` only skills that reach it alone are kept before pairs are formed: a pair is never more
    frequent than its rarer skill. At most (mean set size / min_support) skills remain, whatever the data volume. With
    ``buckets`` as well, pairs are formed twice and counted only where their hash bucket can reach the support, for
    vocabularies whose frequent skills make many pairs and few frequent ones.
    """
    # One pass for skills and postings: a null marker per posting counts the postings themselves. The result is as
    # small as the vocabulary and read several times below.
    marked = F.array_append("skills", F.lit(None).cast("string"))
    tallies = cut_lineage(
        basket_df.select(F.explode_outer(marked).alias("skill")).groupBy("skill").agg(F.count("*").alias("skill_count"))
    )
    total = F.lit(tallies.filter(F.col("skill").isNull()).agg(F.sum("skill_count")).first()[0] or 0)
    counts = tallies.filter(F.col("skill").isNotNull())
    if min_support is not None:
        counts = counts.filter(F.col("skill_count") / total >= min_support)
        frequent = counts.agg(F.collect_list("skill")).scalar()
        basket_df = basket_df.select(F.array_intersect("skills", frequent).alias("skills"))
    if min_support is not None and buckets is not None:
        pairs = _counted(in_frequent_buckets(basket_df, min_support * total, buckets))
    else:
        pairs = pair_counts(basket_df)
    if min_support is not None:
        pairs = pairs.filter(F.col("cooccurrence_count") / total >= min_support)
    first = counts.select(F.col("skill").alias("skill1"), F.col("skill_count").alias("skill1_count"))
    second = counts.select(F.col("skill").alias("skill2"), F.col("skill_count").alias("skill2_count"))
    both, n1, n2 = F.col("cooccurrence_count"), F.col("skill1_count"), F.col("skill2_count")
    return (
        pairs.join(first, "skill1")
        .join(second, "skill2")
        .select(
            "skill1",
            "skill2",
            "cooccurrence_count",
            (both / total).alias("support"),
            (both / n1).alias("confidence_1_to_2"),
            (both / n2).alias("confidence_2_to_1"),
            (both.cast("double") * total / (n1.cast("double") * n2)).alias("lift"),
            "skill1_count",
            "skill2_count",
        )
    )


def confident(associations: DataFrame, min_confidence: float) -> DataFrame:
    """Optional filter on the better of the two confidences."""
    return associations.filter(F.greatest("confidence_1_to_2", "confidence_2_to_1") >= min_confidence)


def by_lift(associations: DataFrame) -> DataFrame:
    return associations.orderBy(F.desc("lift"), "skill1", "skill2")


def heatmap(pairs: DataFrame, min_count: int) -> DataFrame:
    return pairs.filter(F.col("cooccurrence_count") >= min_count)


def partners(pairs: DataFrame, skill: str) -> DataFrame:
    """(partner, count) of one skill."""
    return pairs.filter((F.col("skill1") == skill) | (F.col("skill2") == skill)).select(
        F.when(F.col("skill1") == skill, F.col("skill2")).otherwise(F.col("skill1")).alias("partner"),
        F.col("cooccurrence_count").alias("count"),
    )
