"""Exact duplicates: frequent digests apart, by a Misra-Gries summary and a broadcast of their winners.

Two texts are equal when they are identical after every blank of ``[\\x20\\x09-\\x0D]`` is deleted. Of equal texts the row
with the most code points stays, then the smallest id, then an arbitrary one of rows that agree in both.

Steps: one pass over the texts writes a narrow table of digests with a row number; a Misra-Gries summary of that table
names at most ``1 / support`` digests that can hold more than ``support`` of the rows; their true counts and winners are
computed by an aggregate that folds in each task and the frequent ones are broadcast (at most ``1 / support`` rows), so
the hot groups never cross the network; the other digests, each with at most ``support`` of the rows, are shuffled.

Defined cases: a null text counts as empty; all texts without other characters form one group; a null id is larger than
any other; repeated rows are copies of each other, so one of them stays; an empty table gives an empty result; further
columns are carried through by ``drop_copies`` and ignored by ``copy_groups``, whatever their names are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobgrain.session import materialise

#: The characters that do not count, as fixed by the definition of equality.
BLANKS = " \t\n\x0b\x0c\r"
#: Share of the rows above which a digest is dealt with by broadcast.
SUPPORT = 1 / 2000


def _identity(key: str, text: str) -> list[Column]:
    """Id, digest, length and row number. The number is stable only in a written table."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return [
        F.col(key).alias("doc_id"),
        F.sha2(F.translate(whole, BLANKS, "").cast("binary"), 256).alias("digest"),
        F.length(whole).cast("bigint").alias("n_chars"),
        F.monotonically_increasing_id().alias("row"),
    ]


def _winner() -> Column:
    """Greatest where a row has most characters, then smallest id, then smallest number; ``~`` reverses without overflow."""
    return F.max(F.struct("n_chars", F.bitwise_not("doc_id").alias("rank"), F.bitwise_not("row").alias("turn"), "doc_id", "row"))


def frequent_digests(table: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Winner and true count of every digest with more than ``support`` of the rows: at most ``1 / support`` rows."""
    candidates = table.stat.freqItems(["digest"], support).select(F.explode("digest_freqItems").alias("digest"))
    total = table.agg(F.count("*").alias("total"))
    counted = (
        table.join(F.broadcast(candidates), "digest", "left_semi")
        .groupBy("digest").agg(_winner().alias("best"), F.count("*").alias("group_size"))
    )
    return counted.join(F.broadcast(total), F.col("group_size") > support * F.col("total")).drop("total")


def resolve(table: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Keeper, group size and decision of every row of a written table of digests."""
    split = table.join(F.broadcast(frequent_digests(table, support)), "digest", "left")
    heavy = split.filter(F.col("best").isNotNull())
    group = Window.partitionBy("digest")
    rest = (
        split.filter(F.col("best").isNull()).select(*table.columns)
        .select("*", _winner().over(group).alias("best"), F.count("*").over(group).alias("group_size"))
    )
    return heavy.unionByName(rest).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"),
        F.col("digest").alias("text_sha256"), "row",
    )


def copy_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row."""
    table = materialise(docs.select(*_identity(key, text)), "digests")
    return resolve(table, support).drop("row")


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """The rows that stay, with all their columns. Only the numbers of dropped rows are joined back."""
    numbered = materialise(
        docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), *_identity(key, text)), "numbered"
    )
    dropped = resolve(numbered.drop("doc"), support).filter(~F.col("kept")).select("row")
    return numbered.join(dropped, "row", "left_anti").select("doc.*")
