"""Exact quantiles whose memory does not grow with the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobgrain.session import cut_lineage

_BINS = 4096
#: Values that one task may order for a quantile.
_REST = 50_000
#: The sketch misses a rank by at most a share of 1 / ``_ACCURACY``; a bracket reaches twice as far to either side.
_ACCURACY = 10_000
_STATE = ["_p", "_pos", "_rank", "_below", "_lo", "_hi", "_after"]


def exact_quantiles(
    df: DataFrame, value: str, probabilities: list[float], by: list[str] | None = None, rest: int = _REST,
    accuracy: int = _ACCURACY,
) -> DataFrame:
    """Linearly interpolated quantiles: one row (*by, probability, quantile) per group and probability.

    Spark's own ``percentile`` keeps every distinct value of a group in one buffer. Here a first pass builds a sketch
    per group, which brackets each wanted rank. A second pass keeps equal values inside a bracket as weights and folds
    everything between two brackets into one row, so what is shuffled and written is a small share of the values. Ranks
    are exact counts: a bracket that missed its rank widens to the whole group, and one that still holds more than
    ``rest`` values is narrowed by histograms between its least and greatest value, which leaves out at least one bin a
    round. Only the rest is ordered, so outliers and large groups cost rounds, not memory.
    """
    by = by or []
    for key in [value, *by]:
        df = df.filter(F.col(key).isNotNull())
    rows = df.select(*by, F.col(value).cast("double").alias("_v"))
    brackets = cut_lineage(_brackets(rows, probabilities, by, accuracy))
    weighted = cut_lineage(_folded(rows, brackets, by))
    wanted = cut_lineage(_located(weighted, brackets, by))
    missed, left = wanted.agg(F.bool_or("_missed"), F.max("_left")).first()
    if missed:
        # Every round reads this table; written once, it spares the passes over the source.
        weighted = cut_lineage(rows.groupBy(*by, "_v").agg(F.count("*").alias("_w")))
        wide = brackets.withColumns({"_lo": F.col("_min"), "_hi": F.col("_max")})
        wanted = cut_lineage(_located(weighted, wide, by))
        left = wanted.agg(F.max("_left")).first()[0]
    wanted = wanted.select(*by, *_STATE)
    while (left or 0) > rest:
        wanted = cut_lineage(_narrow(weighted, wanted, by))
        left = _largest(weighted, wanted, by)
    ordered = Window.partitionBy(*by, "_p").orderBy("_v")
    found = (
        _inside(weighted, wanted, by)
        .withColumn("_upto", F.col("_below") + F.sum("_w").over(ordered))
        .withColumn("_next", F.coalesce(F.lead("_v").over(ordered), "_after", "_v"))
        .filter((F.col("_upto") > F.col("_rank")) & (F.col("_upto") - F.col("_w") <= F.col("_rank")))
    )
    upper = F.when(F.col("_rank") + 1 < F.col("_upto"), F.col("_v")).otherwise(F.col("_next"))
    share = F.col("_pos") - F.col("_rank")
    return found.select(
        *by,
        F.col("_p").alias("probability"),
        (F.col("_v") + share * (upper - F.col("_v"))).alias("quantile"),
    )


def _brackets(rows: DataFrame, probabilities: list[float], by: list[str], accuracy: int) -> DataFrame:
    """(*by, _p, _pos, _rank, _lo, _hi, _min, _max) from one pass; the ends of a group stand for ranks beyond it."""
    probabilities, reach = [float(p) for p in probabilities], 2 / accuracy
    lows, highs = ([min(max(p + s * reach, 0.0), 1.0) for p in probabilities] for s in (-1, 1))
    sketch = rows.groupBy(*by).agg(
        F.count("*").alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
        F.percentile_approx("_v", [*lows, *highs], accuracy).alias("_at"),
    )
    each = F.array(
        *[F.struct(F.lit(p).alias("_p"), F.lit(k + 1).alias("_k")) for k, p in enumerate(probabilities)]
    )
    low = F.when(F.col("_p") > reach, F.element_at("_at", F.col("_k"))).otherwise(F.col("_min"))
    high = F.when(F.col("_p") < 1 - reach, F.element_at("_at", F.col("_k") + len(probabilities))).otherwise(F.col("_max"))
    return (
        sketch.filter("_n > 0")
        .select(*by, "_n", "_min", "_max", "_at", F.inline(each))
        .withColumn("_pos", F.col("_p") * (F.col("_n") - 1))
        .select(*by, "_p", "_pos", F.floor("_pos").alias("_rank"), low.alias("_lo"), high.alias("_hi"), "_min", "_max")
    )


def _with_array(rows: DataFrame, states: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """The rows with the states of their group as an array ``_s``."""
    gathered = F.collect_list(F.struct(*columns)).alias("_s")
    if by:
        return rows.join(states.groupBy(*by).agg(gathered), by)
    return rows.withColumn("_s", states.agg(gathered).scalar())


def _folded(rows: DataFrame, brackets: DataFrame, by: list[str]) -> DataFrame:
    """(*by, _v, _w): values inside a bracket with their weights, and one row for all values of a gap between brackets.

    The row of a gap stands at its least value, which lies in no bracket and is the first one after the bracket below.
    """
    v: Column = F.col("_v")
    return (
        _with_array(rows, brackets, by, ["_lo", "_hi"])
        .select(
            *by, "_v",
            F.when(F.exists("_s", lambda s: v.between(s["_lo"], s["_hi"])), v).alias("_inside"),
            F.size(F.filter("_s", lambda s: s["_lo"] > v)).alias("_gap"),
        )
        .groupBy(*by, "_inside", "_gap")
        .agg(F.min("_v").alias("_v"), F.count("*").alias("_w"))
        .select(*by, "_v", "_w")
    )


def _located(weighted: DataFrame, brackets: DataFrame, by: list[str]) -> DataFrame:
    """The state of each wanted quantile, and whether its bracket missed its rank."""
    v, keys = F.col("_v"), [*by, "_p"]
    state = ["_p", "_pos", "_rank", "_lo", "_hi"]
    return (
        _with_array(weighted, brackets, by, state)
        .select(*by, "_v", "_w", F.inline("_s"))
        .groupBy(*keys)
        .agg(
            *[F.first(c).alias(c) for c in state[1:]],
            F.coalesce(F.sum(F.when(v < F.col("_lo"), F.col("_w"))), F.lit(0)).alias("_below"),
            F.coalesce(F.sum(F.when(v <= F.col("_hi"), F.col("_w"))), F.lit(0)).alias("_upto"),
            F.min(F.when(v > F.col("_hi"), v)).alias("_after"),
            F.count_if(v.between(F.col("_lo"), F.col("_hi"))).alias("_left"),
        )
        .withColumn("_missed", (F.col("_rank") < F.col("_below")) | (F.col("_rank") >= F.col("_upto")))
    )


def _largest(weighted: DataFrame, wanted: DataFrame, by: list[str]) -> int:
    """Most values left for one quantile."""
    left = _inside(weighted, wanted, by).groupBy(*by, "_p").agg(F.count("*").alias("n"))
    return left.agg(F.max("n")).first()[0] or 0


def _inside(weighted: DataFrame, wanted: DataFrame, by: list[str]) -> DataFrame:
    """Weighted values within the range of each wanted quantile."""
    if by:
        joined = weighted.join(wanted, by)
    else:
        # One row per probability, handed over as a scalar array.
        states = wanted.agg(F.collect_list(F.struct(*_STATE))).scalar()
        joined = weighted.withColumn("_s", F.explode(states)).select("_v", "_w", "_s.*")
    return joined.filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))


def _narrow(weighted: DataFrame, wanted: DataFrame, by: list[str]) -> DataFrame:
    """Shrink each range to the bin that holds the wanted rank."""
    width = F.col("_hi") - F.col("_lo")
    step = F.when(width > 0, (F.col("_v") - F.col("_lo")) / width * _BINS).otherwise(F.lit(0.0))
    keys = [*by, "_p"]
    bins = (
        _inside(weighted, wanted, by)
        .withColumn("_bin", F.least(F.floor(step), F.lit(_BINS - 1)))
        .groupBy(*keys, "_bin")
        .agg(
            F.sum("_w").alias("_w"),
            F.min("_v").alias("_bin_lo"),
            F.max("_v").alias("_bin_hi"),
            *[F.first(c).alias(c) for c in ("_pos", "_rank", "_below", "_after")],
        )
    )
    ordered = Window.partitionBy(*keys).orderBy("_bin")  # at most 4096 rows each
    return (
        bins.withColumn("_upto", F.col("_below") + F.sum("_w").over(ordered))
        .withColumn("_after", F.coalesce(F.lead("_bin_lo").over(ordered), "_after"))
        .filter((F.col("_upto") > F.col("_rank")) & (F.col("_upto") - F.col("_w") <= F.col("_rank")))
        .select(
            *keys, "_pos", "_rank",
            (F.col("_upto") - F.col("_w")).alias("_below"),
            F.col("_bin_lo").alias("_lo"), F.col("_bin_hi").alias("_hi"), "_after",
        )
    )
