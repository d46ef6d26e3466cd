"""Secret scan over a ledger of content-addressed blobs.

Every version of a path is addressed by the SHA-256 of its text. The ledger holds one row for each blob and scan, with
the rule versions it was scanned by and the spans found. A scan looks only at (blob, rule version) pairs that the ledger
does not hold, each blob once however many paths carry it; findings are then joined back to all paths. Raising a rule's
version makes all blobs unseen for that rule alone. A pair that two scans at once have written twice counts once.

Positions come from Spark's own regular expressions: the gaps between matches and the matches themselves are unfolded
to rows, and a running sum over their lengths gives the start, so cost stays linear in the number of matches.

Defined cases: a null text counts as empty; a null path keeps its row; repeated rows each get the findings; texts
without a finding have zero counts and empty strings; an empty table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from jobgrain.session import materialise


class Rule(NamedTuple):
    """A pattern; ``probe`` must occur wherever a match passes; ``group`` must have ``least`` characters to pass."""

    kind: str
    version: int
    pattern: str
    probe: str
    group: int
    least: int

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The base rules in the order that breaks ties, as the definition of the scan states them.
BASE_RULES = [
    Rule(
        "assign", 1,
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{12}", 2, 12,
    ),
    # A run that is too short holds no longer match, so these two may ask for the length at once.
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}", r"AKIA[A-Z0-9]{14}", 0, 18),
    Rule("hex", 1, r"[0-9a-f]{16,}", r"[0-9a-f]{16}", 0, 16),
]
#: Further rules of this library; they add spans and leave the base ones alone.
MORE_RULES = [
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", r"eyJ[A-Za-z0-9_-]+\.eyJ", 0, 1),
]
RULES = BASE_RULES + MORE_RULES

LEDGER_SCHEMA = "blob string, rules array<string>, spans array<struct<start:int,ord:int,kind:string,rule:string,end:int>>"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger so far; empty before the first scan."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def _matches(text: Column, rule: Rule, order: int, wanted: Column) -> Column:
    """One item per match in order: the gap before it, its length and whether it passes; null without a candidate."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    zipped = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), whole.alias("whole"), value.alias("value"))
    items = F.transform(
        zipped,
        lambda x, i: F.struct(
            F.lit(order).alias("ord"), F.lit(rule.kind).alias("kind"), F.lit(rule.name).alias("rule"), i.alias("turn"),
            F.length(x["gap"]).alias("gap"), F.coalesce(F.length(x["whole"]), F.lit(0)).alias("width"),
            F.coalesce(F.length(x["value"]) >= rule.least, F.lit(False)).alias("passes"),
        ),
    )
    return F.when(wanted & text.rlike(rule.probe), items)


def _scan(blobs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Ledger rows of ``blob, todo, content``; ``content`` is unique by ``blob``."""
    item = "struct<ord:int,kind:string,rule:string,turn:int,gap:int,width:int,passes:boolean>"
    lists = [
        F.coalesce(
            _matches(F.col("content"), rule, order, F.array_contains("todo", rule.name)).cast(f"array<{item}>"),
            F.array().cast(f"array<{item}>"),
        )
        for order, rule in enumerate(rules)
    ]
    turns = Window.partitionBy("blob", "m.rule").orderBy("m.turn")
    end = F.sum(F.col("m.gap") + F.col("m.width")).over(turns.rowsBetween(Window.unboundedPreceding, 0)).cast("int")
    spans = (
        blobs.select("blob", "todo", F.explode_outer(F.concat(*lists)).alias("m"))
        .withColumn("end", end)
        .groupBy("blob", "todo")
        .agg(F.collect_list(F.when(F.col("m.passes"), F.struct(
            (F.col("end") - F.col("m.width")).alias("start"), F.col("m.ord").alias("ord"), F.col("m.kind").alias("kind"),
            F.col("m.rule").alias("rule"), F.col("end").alias("end"),
        ))).alias("spans"))
    )
    return spans.select("blob", F.col("todo").alias("rules"), "spans")


def addressed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``path, blob, content`` of every row."""
    content = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("path"), F.sha2(content.cast("binary"), 256).alias("blob"), content.alias("content"))


def _seen(spark: SparkSession, ledger: str) -> DataFrame:
    return read_ledger(spark, ledger).groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))


def open_rules(blobs: DataFrame, ledger: str, rules: list[Rule] = RULES) -> list[Rule]:
    """The rules by which some blob of ``blob`` has not been scanned."""
    names = F.array(*[F.lit(rule.name) for rule in rules])
    seen = blobs.select("blob").distinct().join(_seen(blobs.sparkSession, ledger), "blob", "left")
    left = seen.select(F.explode(F.array_except(names, F.coalesce("seen", F.array().cast("array<string>")))).alias("rule")).distinct()
    missing = {r["rule"] for r in left.collect()}
    return [rule for rule in rules if rule.name in missing]


def scan_new(versions: DataFrame, ledger: str, rules: list[Rule] = RULES) -> None:
    """Scan the unseen (blob, rule version) pairs of ``path, blob, content`` and append them to the ledger.

    Rules that all blobs have been scanned by are not looked at again. A text travels to the one task that scans it only
    where a rule's probe finds something; the others are recorded as scanned by their address alone.
    """
    unseen = open_rules(versions, ledger, rules)
    if not unseen:
        return
    names = F.array(*[F.lit(rule.name) for rule in unseen])
    hit = F.lit(False)
    for rule in unseen:
        hit = hit | F.col("content").rlike(rule.probe)
    blobs = (
        versions.select("blob", F.when(hit, F.col("content")).alias("content"))
        .groupBy("blob").agg(F.first("content").alias("content"))
        .join(_seen(versions.sparkSession, ledger), "blob", "left")
        .withColumn("todo", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>"))))
        .filter(F.size("todo") > 0)
    )
    _scan(blobs, unseen).write.mode("append").parquet(ledger)


def scan_versions(
    docs: DataFrame, ledger: str, key: str = "doc_id", text: str = "text", rules: list[Rule] = RULES
) -> DataFrame:
    """``path, blob, spans`` for every row, after the ledger has been brought up to date.

    ``spans`` is ordered by start, then by the order of the rules; ends are exclusive and positions count code points.
    """
    versions = addressed(docs, key, text)
    scan_new(versions, ledger, rules)
    return findings(versions, ledger, rules)


def findings(versions: DataFrame, ledger: str, rules: list[Rule] = RULES) -> DataFrame:
    """``path, blob, spans`` of ``path, blob``, from the ledger. A pair that was written twice counts once."""
    names = [rule.name for rule in rules]
    order = F.array(*map(F.lit, names))

    def ordered(s: Column) -> Column:
        place = (F.array_position(order, s["rule"]) - 1).cast("int")  # by the rules asked for, not by those of the scan
        return F.struct(s["start"].alias("start"), place.alias("ord"), s["kind"].alias("kind"), s["rule"].alias("rule"), s["end"].alias("end"))

    found = materialise(
        read_ledger(versions.sparkSession, ledger).filter(F.size("spans") > 0).groupBy("blob")
        .agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"))
        .select("blob", F.transform(F.filter("spans", lambda s: s["rule"].isin(names)), ordered).alias("spans")),
        "findings",  # written, so that the join below may split a blob with very many paths
    )
    empty = F.array().cast("array<struct<start:int,ord:int,kind:string,rule:string,end:int>>")
    return versions.select("path", "blob").join(found, "blob", "left").select(
        "path", "blob", F.sort_array(F.coalesce("spans", empty)).alias("spans")
    )


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
