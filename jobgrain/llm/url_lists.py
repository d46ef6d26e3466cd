"""URL filters with dated lists: entries become validity intervals, captures are judged by those active at fetch time.

An entry says that on a date a list begins (``add``) or ceases (``remove``) to hold a host, a domain with all its
subdomains, or a host with a path prefix of whole segments. The entries of one list and value, ordered by date, become
intervals ``[since, until)``; a capture yields its own keys: its host, and the domain suffixes and path prefixes of as many
labels or segments as some entry has
and an as-of join on key and time finds the active ones. Everything is DataFrame operations; the join is left to Spark,
which measures the interval side before it broadcasts and splits the key of a hot host otherwise.

Defined cases: an ``add`` and a ``remove`` on one date count as the ``remove``; an ``add`` while the value is held changes
nothing; a null or malformed URL has no key and matches nothing; a null fetch date matches nothing; entries with a null in
list, kind, value or date are ignored; hosts may have any length and any number of labels; repeated captures keep their rows; empty tables give empty results or no match.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; empty when there is none."""
    return F.coalesce(F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.$", ""), F.lit(""))


def segments_of(url: Column) -> Column:
    """Path segments without empty ones."""
    return F.filter(F.split(F.coalesce(F.regexp_extract(url, PATH, 1), F.lit("")), "/"), lambda s: s != "")


def validity(entries: DataFrame) -> DataFrame:
    """``list, kind, value, since, until`` of ``date, action, list, kind, value``; ``until`` is null while held."""
    key = ["list", "kind", "value"]
    daily = entries.dropna(subset=[*key, "date", "action"]).groupBy(*key, "date").agg(F.max("action").alias("action"))
    turns = Window.partitionBy(*key).orderBy("date")
    changes = daily.withColumn("before", F.lag("action", 1, "remove").over(turns)).filter("action != before")
    until = F.lead("date").over(turns)
    return changes.select(*key, "action", F.col("date").alias("since"), until.alias("until")).filter("action = 'add'").drop("action")


def _keys(url: Column, labels: list[int], segments: list[int]) -> Column:
    """All (kind, value) pairs under which an entry could hold the URL; the lists are the sizes that entries have."""
    host, parts = host_of(url), segments_of(url)
    names = F.split(host, r"\.")

    def pairs(kind: str, sizes: list[int], most: Column, value: Callable[[Column], Column]) -> Column:
        if not sizes:
            return F.array().cast("array<struct<kind:string,value:string>>")
        fitting = F.filter(F.array(*map(F.lit, sizes)), lambda n: n <= most)
        return F.transform(fitting, lambda n: F.struct(F.lit(kind).alias("kind"), value(n).alias("value")))

    return F.when(host != "", F.concat(
        F.array(F.struct(F.lit("host").alias("kind"), host.alias("value"))),
        pairs("domain", labels, F.size(names), lambda n: F.array_join(F.slice(names, F.size(names) - n + 1, n), ".")),
        pairs("prefix", segments, F.size(parts), lambda n: F.concat_ws("/", host, F.array_join(F.slice(parts, F.lit(1), n), "/"))),
    ))


def _sizes(held: DataFrame, kind: str, size: Column) -> list[int]:
    """Distinct sizes of the entries of a kind, of which a list has a handful: a name has 127 labels at most, and no list reaches paths of many segments."""
    return sorted(r[0] for r in held.filter(F.col("kind") == kind).select(size).distinct().collect())


def judge(captures: DataFrame, entries: DataFrame, key: str = "page_id", url: str = "url", fetched: str = "fetched") -> DataFrame:
    """``page_id, url, fetched, n_entries, lists, blocked``: lists active at fetch time, comma-joined in order of name."""
    held = validity(entries)
    labels, segments = _sizes(held, "domain", F.size(F.split("value", r"\."))), _sizes(held, "prefix", F.size(F.split("value", "/")) - 1)
    keyed = captures.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(fetched).alias("fetched")
    ).select("*", F.explode_outer(_keys(F.col("url"), labels, segments)).alias("k")).select("row", "page_id", "url", "fetched", "k.*")
    active = (
        (keyed["kind"] == held["kind"]) & (keyed["value"] == held["value"])
        & (held["since"] <= keyed["fetched"]) & (held["until"].isNull() | (keyed["fetched"] < held["until"]))
    )
    found = keyed.join(held, active, "left").select(
        "row", "page_id", "url", "fetched", "list", F.col("list").isNotNull().cast("bigint").alias("hit")
    )
    # Row numbers are unique, so the other columns only ride along.
    return found.groupBy("row", "page_id", "url", "fetched").agg(
        F.sum("hit").alias("n_entries"), F.array_join(F.sort_array(F.collect_set("list")), ",").alias("lists")
    ).select("page_id", "url", "fetched", "n_entries", "lists", (F.col("n_entries") > 0).alias("blocked"))
