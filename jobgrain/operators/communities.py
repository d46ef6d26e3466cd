"""Communities of the skill graph by modularity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from jobgrain.functions.rowids import with_row_number
from jobgrain.operators.graph import adjacency
from jobgrain.session import cut_lineage, sized

#: Linked pairs of one task of a merge.
ROWS = 500_000


def _singletons(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Community links (ci, cj, e) as shares of all weight in both directions, and labels (skill, community)."""
    links = adjacency(edges)
    total = links.agg(F.sum("weight")).scalar()
    shares = links.select(
        F.col("src").alias("ci"), F.col("dst").alias("cj"), (F.col("weight") / total).alias("e")
    )
    labels = links.select(F.col("src").alias("skill"), F.col("src").alias("community")).distinct()
    return cut_lineage(shares), labels


def _gains(links: DataFrame, nodes: int) -> DataFrame:
    """Modularity gain of joining each linked pair ci < cj: 2 (e_ij - a_i a_j)."""
    ends = sized(links.groupBy("ci").agg(F.sum("e").alias("a")), nodes)
    return (
        links.filter(F.col("ci") < F.col("cj"))
        .join(ends, "ci")
        .join(sized(ends.select(F.col("ci").alias("cj"), F.col("a").alias("b")), nodes), "cj")
        .select("ci", "cj", (2 * (F.col("e") - F.col("a") * F.col("b"))).alias("gain"))
    )


def _numbered(labels: DataFrame) -> DataFrame:
    """(skill, cluster): clusters numbered from 0 by size, ties by smallest member."""
    sizes = labels.groupBy("community").agg(F.count("*").alias("n"), F.min("skill").alias("least"))
    numbered = with_row_number(sizes, "number", [F.desc("n"), F.col("least")])
    return labels.join(numbered, "community").select("skill", (F.col("number") - 1).cast("int").alias("cluster"))


def _merged(pairs: DataFrame, keep: str, gone: str, share: float) -> DataFrame:
    """The pairs after ``gone`` has joined ``keep``: only rows that touch one of the two are summed and given new shares."""
    both = F.array(F.lit(keep), F.lit(gone))
    touched = F.array_contains(both, F.col("ci")) | F.array_contains(both, F.col("cj"))
    inner = F.array_contains(both, F.col("ci")) & F.array_contains(both, F.col("cj"))
    other = F.when(F.array_contains(both, F.col("ci")), F.struct(F.col("cj").alias("c"), F.col("b").alias("a"))).otherwise(
        F.struct(F.col("ci").alias("c"), F.col("a").alias("a"))
    )
    own = F.struct(F.lit(keep).alias("c"), F.lit(share).alias("a"))
    sums = pairs.filter(touched & ~inner).select(other.alias("o"), "e").groupBy("o").agg(F.sum("e").alias("e"))
    low, high = (F.when((F.col("o.c") < keep) == first, F.col("o")).otherwise(own) for first in (True, False))
    changed = sums.select(low.alias("x"), high.alias("y"), "e").select(
        F.col("x.c").alias("ci"), F.col("y.c").alias("cj"), "e", F.col("x.a").alias("a"), F.col("y.a").alias("b")
    )
    return pairs.filter(~touched).unionByName(changed)


def greedy_clusters(edges: DataFrame) -> DataFrame:
    """Merge the linked pair with the largest gain until no gain is left; ties by smallest pair of names.

    One merge a round, as the definition demands. The state is a table of linked pairs that carries both communities'
    shares, so a gain needs its own row only; a merge recomputes the rows of the merged pair and passes all others on.
    Each round is one action: the write of the next table, which observes the best pair on its way. Names of merged
    communities are kept on the driver, one for each round. ``parallel_clusters`` needs few rounds on large graphs.
    """
    links, labels = _singletons(edges)
    ends = links.groupBy("ci").agg(F.sum("e").alias("a"))
    pairs = (
        links.filter(F.col("ci") < F.col("cj")).join(ends, "ci")
        .join(ends.select(F.col("ci").alias("cj"), F.col("a").alias("b")), "cj").select("ci", "cj", "e", "a", "b")
    )
    gain = 2 * (F.col("e") - F.col("a") * F.col("b"))
    renames: dict[str, str] = {}
    while True:
        seen = Observation()
        best = F.min(F.when(gain >= 0, F.struct((-gain).alias("gain"), "ci", "cj", "a", "b"))).alias("best")
        pairs = cut_lineage(pairs.observe(seen, best, F.count("*").alias("rows")))
        found = seen.get["best"]
        if found is None:
            break
        renames[found["cj"]] = found["ci"]
        parts = 1 + seen.get["rows"] // ROWS
        pairs = _merged(pairs, found["ci"], found["cj"], found["a"] + found["b"]).coalesce(parts)

    def last(name: str) -> str:
        while name in renames:
            name = renames[name]
        return name

    if renames:
        table = edges.sparkSession.createDataFrame([(gone, last(gone)) for gone in renames], "community string, kept string")
        labels = labels.join(sized(table, len(renames)), "community", "left").select("skill", F.coalesce("kept", "community").alias("community"))
    return _numbered(labels)


def parallel_clusters(edges: DataFrame) -> DataFrame:
    """Merge all mutually best pairs of a round at once.

    Pairs have one total order (gain, then names), so the best pair overall is always mutual and every round makes
    progress. The partition may differ from the one-at-a-time merge.
    """
    links, labels = _singletons(edges)
    nodes = labels.count()
    while True:
        pairs = _gains(links, nodes).filter(F.col("gain") >= 0)
        choice = F.struct((-F.col("gain")).alias("g"), F.col("ci").alias("x"), F.col("cj").alias("y"))
        ends = F.array(
            F.struct(F.col("ci").alias("community"), choice.alias("pair")),
            F.struct(F.col("cj").alias("community"), choice.alias("pair")),
        )
        best = pairs.select(F.inline(ends)).groupBy("community").agg(F.min("pair").alias("pair"))
        mutual = (
            best.groupBy(F.col("pair.x").alias("x"), F.col("pair.y").alias("y"))
            .agg(F.count("*").alias("votes"))
            .filter("votes = 2")
        )
        renames = cut_lineage(mutual.select(F.col("y").alias("gone"), F.col("x").alias("keep")))
        if renames.isEmpty():
            return _numbered(labels)

        def relabel(df: DataFrame, column: str, renames: DataFrame = renames) -> DataFrame:
            joined = df.join(sized(renames, nodes), F.col(column) == F.col("gone"), "left")
            return joined.withColumn(column, F.coalesce("keep", column)).drop("gone", "keep")

        links = cut_lineage(
            relabel(relabel(links, "ci"), "cj").groupBy("ci", "cj").agg(F.sum("e").alias("e"))
        )
        labels = cut_lineage(relabel(labels, "community"))


def modularity(edges: DataFrame, clusters: DataFrame) -> DataFrame:
    """One row: modularity of a partition."""
    links = adjacency(edges)
    total = links.agg(F.sum("weight")).scalar()
    named = links.join(clusters.select(F.col("skill").alias("src"), F.col("cluster").alias("a")), "src").join(
        clusters.select(F.col("skill").alias("dst"), F.col("cluster").alias("b")), "dst"
    )
    per_cluster = named.groupBy("a").agg(
        (F.sum(F.when(F.col("a") == F.col("b"), F.col("weight")).otherwise(0.0)) / total).alias("inner"),
        (F.sum("weight") / total).alias("share"),
    )
    return per_cluster.agg(F.sum(F.col("inner") - F.col("share") * F.col("share")).alias("modularity"))
