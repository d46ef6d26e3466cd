"""Annotated spans: checks, weak labels, splits, scores and votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobgrain.functions.hashing import split_name
from jobgrain.functions.text import blocks, cut
from jobgrain.operators.extraction import phrase_offsets

LABEL = "SKILL"

# Shares of the two splits in per cent.
TRAIN_DEV = {"train": 80, "dev": 20}
TRAIN_DEV_TEST = {"train": 80, "dev": 10, "test": 10}

_WORD = r"[\p{L}\p{N}]"


def spans(df: DataFrame, text: str = "text", entities: str = "entities") -> DataFrame:
    """One row per span with its surface text; offsets count characters from 0, the end is exclusive."""
    rest = [c for c in df.columns if c != entities]
    start, size = F.col("start"), F.col("end") - F.col("start")
    # Blocks are made once per text. Only a start before the text leaves them, for what ``substring`` makes of it.
    surface = F.when(start >= 0, cut(F.col("_blocks"), start, size)).otherwise(F.substring(F.col(text), start + 1, size))
    unfolded = df.withColumn("_blocks", blocks(F.col(text))).select(*rest, "_blocks", F.inline(entities))
    return unfolded.withColumn("surface", surface).drop("_blocks")


def _around(start: Column, end: Column) -> tuple[Column, Column]:
    """First character and size of the span with one character more at either side, where there is one."""
    first = F.greatest(start - 1, F.lit(0))
    return first, end + 1 - first


def _boundary(around: Column, start: Column, end: Column) -> Column:
    first, _ = _around(start, end)
    inside = (start >= 0) & (start < end) & (end - first <= F.length(around))
    char = lambda at, n=1: F.substring(around, (at - first).cast("int"), F.lit(n))
    cut_left = (start > 0) & char(start, 2).rlike(f"^{_WORD}{_WORD}")
    cut_right = (end - first < F.length(around)) & char(end, 2).rlike(f"^{_WORD}{_WORD}")
    visible = char(start + 1).rlike(r"\S") & char(end).rlike(r"\S")
    return F.coalesce(inside & visible & ~cut_left & ~cut_right, F.lit(False))


def on_boundary(text: Column, start: Column, end: Column) -> Column:
    """Neither edge of the span cuts through a word, the span lies in the text and has visible edges."""
    first, size = _around(start, end)
    return _boundary(F.substring(text, (first + 1).cast("int"), size.cast("int")), start, end)


def check_spans(span_df: DataFrame, text: str = "text") -> DataFrame:
    """Flag each span as valid or not; callers keep one side and report the other."""
    return span_df.withColumn("is_valid", on_boundary(F.col(text), F.col("start"), F.col("end")))


def check_entities(df: DataFrame, text: str = "text", entities: str = "entities") -> DataFrame:
    """The same for spans in an array beside their text: one row per span with ``is_valid``, without the text.

    A span costs its own length, wherever in the text it lies, and no text is brought to its spans by a join.
    """
    rest = [c for c in df.columns if c not in (text, entities)]
    parts, start, end = F.col("_blocks"), F.col("start"), F.col("end")
    return (
        df.withColumn("_blocks", blocks(F.col(text)))
        .select(*rest, "_blocks", F.posexplode_outer(entities).alias("_at", "_span"))
        .filter(F.col("_at").isNotNull())
        .select(*rest, "_blocks", "_span.*")
        .withColumn("_around", cut(parts, *_around(start, end)))
        .withColumn("is_valid", _boundary(F.col("_around"), start, end))
        .drop("_blocks", "_around")
    )


def weak_labels(df: DataFrame, lexicon: DataFrame, text: str = "text", id_column: str = "doc_id",
                label: str = LABEL) -> DataFrame:
    """Candidate spans of all lexicon phrases: (id, start, end, label, skill, surface)."""
    found = phrase_offsets(df, lexicon, text, id_column)
    return found.select(id_column, "start", "end", F.lit(label).alias("label"), "skill", "surface")


def with_split(df: DataFrame, key: str, shares: dict[str, int] | None = None, name: str = "split") -> DataFrame:
    """Assign each row to a set by its key alone, so sets stay the same across runs and partitionings."""
    return df.withColumn(name, split_name(F.col(key), TRAIN_DEV if shares is None else shares))


def span_scores(gold: DataFrame, predicted: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """One row: exact-span true and false positives, false negatives, precision, recall and F1.

    Both sets are tagged and folded by span in one shuffle, which replaces a full outer join.
    """
    keys = [id_column, "start", "end", "label"]
    tagged = gold.select(*keys, F.lit(1).alias("g"), F.lit(0).alias("p")).unionByName(
        predicted.select(*keys, F.lit(0).alias("g"), F.lit(1).alias("p"))
    )
    folded = tagged.groupBy(*keys).agg(F.max("g").alias("g"), F.max("p").alias("p"))
    counts = folded.agg(
        F.count_if((F.col("g") == 1) & (F.col("p") == 1)).alias("tp"),
        F.count_if(F.col("g") < F.col("p")).alias("fp"),
        F.count_if(F.col("g") > F.col("p")).alias("fn"),
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    p, r = F.col("precision"), F.col("recall")
    return (
        counts.withColumns(
            {
                "precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")),
                "recall": ratio(F.col("tp"), F.col("tp") + F.col("fn")),
            }
        )
        .withColumn("f1", ratio(2 * p * r, p + r))
        .select("precision", "recall", "f1", "tp", "fp", "fn")
    )


def vote(sources: list[DataFrame], min_votes: int = 1, id_column: str = "doc_id") -> DataFrame:
    """(id, skill, votes) named by at least ``min_votes`` of the extractors; 1 is their union."""
    tagged = [s.select(id_column, "skill", F.lit(i).alias("source")) for i, s in enumerate(sources)]
    union = tagged[0]
    for part in tagged[1:]:
        union = union.unionByName(part)
    # A distinct count over few sources, folded map-side as a bit set.
    bits = F.bit_or(F.expr("shiftleft(1, source)"))
    return (
        union.groupBy(id_column, "skill")
        .agg(F.bit_count(bits).alias("votes"))
        .filter(F.col("votes") >= min_votes)
    )
