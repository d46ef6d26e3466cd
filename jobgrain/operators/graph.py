"""Skill graph: edges and nodes, centralities, induced subgraphs.

Shortest paths, betweenness and PageRank run level by level as joins on checkpointed frames, so their plans stay the
same size however many rounds are needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobgrain.operators.cooccurrence import TOP_ASSOCIATIONS, by_lift
from jobgrain.session import cut_lineage, shared_path, sized

# PageRank damping, tolerance per node and the most rounds.
DAMPING = 0.85
TOLERANCE = 1e-6
MAX_ROUNDS = 100

_BATCH = 5


def keyed(df: DataFrame, key: str) -> DataFrame:
    """The frame as a written table of buckets by ``key``, one for each shuffle partition, each sorted.

    The files lie in the shared folder; the session's catalog forgets the table when the session ends.
    """
    spark = df.sparkSession
    path = shared_path(spark, "keyed")
    name = path.rpartition("/")[2].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return spark.table(name)


def network_edges(associations: DataFrame, top_n: int = TOP_ASSOCIATIONS) -> DataFrame:
    """The strongest associations as edges with weight, lift, support and the better confidence."""
    return by_lift(associations).limit(top_n).select(
        "skill1",
        "skill2",
        F.col("cooccurrence_count").alias("weight"),
        "lift",
        "support",
        F.greatest("confidence_1_to_2", "confidence_2_to_1").alias("confidence"),
    )


def network_nodes(associations: DataFrame, top_n: int = TOP_ASSOCIATIONS) -> DataFrame:
    """(skill, count) for both ends of the strongest associations."""
    top = by_lift(associations).limit(top_n)
    ends = F.array(
        F.struct(F.col("skill1").alias("skill"), F.col("skill1_count").alias("count")),
        F.struct(F.col("skill2").alias("skill"), F.col("skill2_count").alias("count")),
    )
    return top.select(F.inline(ends)).groupBy("skill").agg(F.max("count").alias("count"))


def adjacency(edges: DataFrame) -> DataFrame:
    """(src, dst, weight) in both directions."""
    weight = F.col("weight").cast("double")
    ends = F.array(
        F.struct(F.col("skill1").alias("src"), F.col("skill2").alias("dst"), weight.alias("weight")),
        F.struct(F.col("skill2").alias("src"), F.col("skill1").alias("dst"), weight.alias("weight")),
    )
    return edges.select(F.inline(ends))


def degree_centrality(edges: DataFrame) -> DataFrame:
    """(skill, degree, degree_centrality): neighbours, and their share of the other nodes."""
    degrees = adjacency(edges).groupBy(F.col("src").alias("skill")).agg(F.count("*").alias("degree"))
    n = degrees.agg(F.count("*")).scalar()
    return degrees.withColumn(
        "degree_centrality", F.when(n > 1, F.try_divide(F.col("degree"), n - 1)).otherwise(F.lit(1.0))
    )


def _size(edges: DataFrame) -> Column:
    return adjacency(edges).agg(F.count_distinct("src")).scalar()


def shortest_paths(edges: DataFrame, sources: int | None = None) -> list[DataFrame]:
    """Breadth-first levels from every node at once: level d holds (src, node, sigma) at distance d.

    ``sigma`` counts the shortest paths. A new node can only repeat one of the two levels before it, so only those
    are looked at. With ``sources`` only so many nodes start, those of least hash, and the state is (sources x nodes) instead
    of the square of the nodes; the measures below then scale their sums up (Brandes and Pich).
    """
    links = cut_lineage(adjacency(edges).select("src", "dst"))
    links = sized(links, links.count())
    start = links.select(F.col("src").alias("node")).distinct()
    if sources is not None:
        start = start.orderBy(F.xxhash64("node"), "node").limit(sources)
    levels = [cut_lineage(start.select(F.col("node").alias("src"), "node", F.lit(1.0).alias("sigma")))]
    largest = levels[0].count()
    while True:
        reached = (
            levels[-1]
            .alias("f")
            .join(links.alias("l"), F.col("f.node") == F.col("l.src"))
            .groupBy(F.col("f.src").alias("src"), F.col("l.dst").alias("node"))
            .agg(F.sum("f.sigma").alias("sigma"))
        )
        for seen in levels[-2:]:
            known = seen.select("src", "node")
            reached = reached.join(sized(known, largest), ["src", "node"], "left_anti")
        reached = cut_lineage(reached)
        rows = reached.count()
        if rows == 0:
            return levels
        largest = max(largest, rows)
        levels.append(reached)


def closeness(edges: DataFrame, levels: list[DataFrame] | None = None, sources: int | None = None) -> DataFrame:
    """(skill, closeness): reachable nodes per total distance, scaled by the share of the graph reached.

    With ``sources``, nodes reached and distances are those to the sources times (nodes / sources); a node that no
    source reaches has closeness 0.
    """
    levels = levels or shortest_paths(edges, sources)
    n = _size(edges)
    distances = levels[0].select("node", F.lit(0).alias("dist"))
    for dist, level in enumerate(levels[1:], start=1):
        distances = distances.unionByName(level.select("node", F.lit(dist).alias("dist")))
    sums = distances.groupBy(F.col("node").alias("skill")).agg(F.sum("dist").alias("s"), F.count("*").alias("r"))
    if sources is not None:
        up = n / levels[0].agg(F.count("*")).scalar()
        every = adjacency(edges).select(F.col("src").alias("skill")).distinct()
        sums = every.join(sums, "skill", "left").select("skill", (F.col("s") * up).alias("s"), F.coalesce(F.col("r") * up, F.lit(1.0)).alias("r"))
    others = (F.col("r") - 1).cast("double")
    value = F.try_divide(others, F.col("s")) * F.try_divide(others, n - 1)
    return sums.select("skill", F.coalesce(value, F.lit(0.0)).alias("closeness"))


def betweenness(edges: DataFrame, levels: list[DataFrame] | None = None, sources: int | None = None) -> DataFrame:
    """(skill, betweenness): normalised share of shortest paths through a node, dependencies summed backwards.

    With ``sources``, the sums over the sources are scaled by (nodes / sources).
    """
    levels = levels or shortest_paths(edges, sources)
    links = cut_lineage(adjacency(edges).select(F.col("src").alias("node"), F.col("dst").alias("near")))
    links = sized(links, links.count())
    below = levels[-1].withColumn("delta", F.lit(0.0))
    passed = below.select("src", "node", "delta")
    for level in reversed(levels[:-1]):
        share = (
            below.join(links, "node")
            .select("src", F.col("near").alias("node"), ((1 + F.col("delta")) / F.col("sigma")).alias("part"))
            .join(level, ["src", "node"])
            .groupBy("src", "node")
            .agg(F.sum("part").alias("part"))
        )
        below = level.join(share, ["src", "node"], "left").select(
            "src", "node", "sigma", F.coalesce(F.col("sigma") * F.col("part"), F.lit(0.0)).alias("delta")
        )
        below = cut_lineage(below)
        passed = passed.unionByName(below.select("src", "node", "delta"))
    n = _size(edges)
    scale = F.when(n > 2, (n - 1) * (n - 2)).otherwise(F.lit(1)).cast("double")
    inner = F.sum(F.when(F.col("src") != F.col("node"), F.col("delta")).otherwise(0.0))
    sums = passed.groupBy(F.col("node").alias("skill")).agg(inner.alias("d"))
    if sources is not None:
        up = n / levels[0].agg(F.count("*")).scalar()
        every = adjacency(edges).select(F.col("src").alias("skill")).distinct()
        sums = every.join(sums, "skill", "left").select("skill", (F.coalesce("d", F.lit(0.0)) * up).alias("d"))
    return sums.select("skill", (F.col("d") / scale).alias("betweenness"))


def pagerank(edges: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE,
             max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """(skill, pagerank) with co-occurrence counts as weights; 0.0 everywhere when it does not settle.

    Rounds run in batches. A self link carries a node's earlier ranks through the same aggregate, so a batch is one
    chain of joins and the first round below the tolerance can be picked from the history. Links are bucketed by their
    source with one bucket per shuffle partition, and a round's ranks come out of their aggregate partitioned by node, so
    joins beyond the broadcast limit shuffle neither the links nor the ranks of an earlier round of the batch.
    """
    weighted = adjacency(edges)
    out = weighted.groupBy("src").agg(F.sum("weight").alias("_out"))
    shares = weighted.join(out, "src").select("src", "dst", (F.col("weight") / F.col("_out")).alias("share"))
    own = out.select("src", F.col("src").alias("dst"), F.lit(None).cast("double").alias("share"))
    links = keyed(shares.unionByName(own), "src")
    n = out.count()
    state = out.select(F.col("src").alias("node"), F.array(F.lit(1.0 / max(n, 1))).alias("ranks"))
    done = 0
    while done < max_rounds:
        batch = min(_BATCH, max_rounds - done)
        for _ in range(batch):
            last = F.element_at("ranks", -1)
            state = (
                links.join(sized(state, n), links["src"] == F.col("node"))
                .groupBy(F.col("dst").alias("node"))
                .agg(
                    F.sum(F.col("share") * last).alias("_in"),
                    F.max(F.when(F.col("share").isNull(), F.col("ranks"))).alias("ranks"),
                )
                .select("node", F.array_append("ranks", F.lit((1 - damping) / n) + damping * F.col("_in")).alias("ranks"))
            )
        state = cut_lineage(state)
        done += batch
        steps = [
            F.sum(F.abs(F.element_at("ranks", k + 1) - F.element_at("ranks", k))).alias(f"e{k}")
            for k in range(1, batch + 1)
        ]
        errors = state.agg(*steps).first()
        settled = [k for k in range(1, batch + 1) if errors[f"e{k}"] is not None and errors[f"e{k}"] < n * tolerance]
        if settled or n == 0:
            at = settled[0] + 1 if settled else 1
            return state.select(F.col("node").alias("skill"), F.element_at("ranks", at).alias("pagerank"))
        state = state.select("node", F.array(F.element_at("ranks", -1)).alias("ranks"))
    return state.select(F.col("node").alias("skill"), F.lit(0.0).alias("pagerank"))


def network_metrics(edges: DataFrame, nodes: DataFrame, sources: int | None = None) -> DataFrame:
    """All node measures, best connected first; path measures from so many ``sources`` on large graphs."""
    edges = cut_lineage(edges)
    levels = shortest_paths(edges, sources)
    return (
        degree_centrality(edges)
        .join(betweenness(edges, levels, sources).withColumnRenamed("betweenness", "betweenness_centrality"), "skill")
        .join(closeness(edges, levels, sources).withColumnRenamed("closeness", "closeness_centrality"), "skill")
        .join(pagerank(edges), "skill")
        .join(nodes, "skill", "left")
        .withColumn("count", F.coalesce("count", F.lit(0)))
        .orderBy(F.desc("degree"), "skill")
    )


def top_subgraph(edges: DataFrame, top_n: int = 15) -> DataFrame:
    """Edges among the ``top_n`` best connected nodes."""
    top = degree_centrality(edges).orderBy(F.desc("degree"), "skill").limit(top_n).select("skill")
    kept = edges
    for end in ("skill1", "skill2"):
        kept = kept.join(top.withColumnRenamed("skill", end), end, "left_semi")
    return kept
