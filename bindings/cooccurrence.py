"""Pairs, associations and the skill graph over orders and part brands."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.views import baskets, rounded, sql
from jobgrain.operators import communities, cooccurrence as co, graph
from jobgrain.session import cut_lineage, materialise, shared_path
from jobgrain.sources.sinks import write_table

ASSOC_ROUND = ["support", "confidence_1_to_2", "confidence_2_to_1", "lift"]
_ASSOC_SQL = (
    "SELECT skill1, skill2, cooccurrence_count, round(support, 6) AS support, "
    "round(confidence_1_to_2, 6) AS confidence_1_to_2, round(confidence_2_to_1, 6) AS confidence_2_to_1, "
    "round(lift, 6) AS lift, skill1_count, skill2_count FROM "
)
SKILL = "Brand#7"


def _assoc(spark, sf, min_support=None):
    return co.association_metrics(materialise(baskets(spark, sf), "baskets"), min_support)


def assoc_filtered(spark, sf):
    """Associations with enough support, by lift: the flagship query."""
    return rounded(co.by_lift(_assoc(spark, sf, co.MIN_SUPPORT)), ASSOC_ROUND)


def _edges(spark, sf):
    return cut_lineage(graph.network_edges(_assoc(spark, sf, co.MIN_SUPPORT)))


def _skill_network(spark, sf):
    path = shared_path(spark, "edges")
    write_table(graph.network_edges(_assoc(spark, sf, co.MIN_SUPPORT)), path)
    return rounded(spark.read.parquet(path), ["lift", "support", "confidence"])


def _network_metrics(spark, sf):
    assoc = cut_lineage(_assoc(spark, sf, co.MIN_SUPPORT))
    metrics = graph.network_metrics(graph.network_edges(assoc), graph.network_nodes(assoc))
    return rounded(
        metrics, ["degree_centrality", "betweenness_centrality", "closeness_centrality", "pagerank"]
    )


_EDGES_SQL = sql(
    "edges",
    "SELECT skill1, skill2, weight, round(lift, 6) AS lift, round(support, 6) AS support, "
    "round(confidence, 6) AS confidence FROM edges",
)

# All hundred rounds, then the first whose change is below the tolerance; zero when there is none.
_PAGERANK_SQL = (
    sql(
        "adj", "@",
        outw="SELECT src, sum(weight) AS o FROM adj GROUP BY src",
        nn="SELECT count(*) AS n FROM outw",
        ranks="SELECT src AS node, 1.0::DOUBLE / n AS r, 0 AS k FROM outw, nn UNION ALL "
        "SELECT dst, (0.15 / any_value(n) + 0.85 * sum(ranks.r * adj.weight / o))::DOUBLE, k + 1 FROM ranks "
        "JOIN adj ON adj.src = ranks.node JOIN outw ON outw.src = ranks.node, nn WHERE k < 100 GROUP BY dst, k",
        change="SELECT a.k, sum(abs(a.r - b.r)) AS err FROM ranks a JOIN ranks b ON a.node = b.node AND a.k = b.k + 1 GROUP BY a.k",
        stop="SELECT min(k) AS k FROM change, nn WHERE err < n * 1e-6",
    )
    .replace("WITH ", "WITH RECURSIVE ", 1)
    .replace("@", "SELECT node AS skill, round(CASE WHEN stop.k IS NULL THEN 0 ELSE r END, 6) AS pagerank FROM ranks, stop "
             "WHERE ranks.k = coalesce(stop.k, 100)")
)

# Breadth-first walks from every node, then path counts along the distances.
_WALKS = {
    "nodes": "SELECT DISTINCT src FROM adj",
    "size": "SELECT count(*)::DOUBLE AS n FROM nodes",
    "walk": "SELECT src, src AS node, 0 AS d FROM nodes UNION SELECT w.src, a.dst, w.d + 1 FROM walk w JOIN adj a ON a.src = w.node, size WHERE w.d + 1 < n",
    "dist": "SELECT src, node, min(d) AS d FROM walk GROUP BY src, node",
    "sig": "SELECT src, src AS node, 0 AS d, 1.0::DOUBLE AS s FROM nodes UNION ALL SELECT g.src, a.dst, g.d + 1, sum(g.s)::DOUBLE FROM sig g "
    "JOIN adj a ON a.src = g.node JOIN dist t ON t.src = g.src AND t.node = a.dst AND t.d = g.d + 1 GROUP BY g.src, a.dst, g.d",
    "close": "SELECT src AS skill, coalesce((count(*) - 1) / nullif(sum(d), 0)::DOUBLE * (count(*) - 1) / nullif(any_value(n) - 1, 0), 0) AS closeness "
    "FROM dist, size GROUP BY src",
    "between": "SELECT src AS skill, coalesce((SELECT sum(x.s * y.s / t.s) FROM sig x JOIN sig y ON y.src = x.node JOIN sig t ON t.src = x.src AND t.node = y.node "
    "WHERE x.node = nodes.src AND x.src <> x.node AND y.node <> y.src AND x.d + y.d = t.d), 0) / CASE WHEN n > 2 THEN (n - 1) * (n - 2) ELSE 1 END "
    "AS betweenness FROM nodes, size",
}


def _walk_sql(query: str) -> str:
    return sql("adj", query, **_WALKS).replace("WITH ", "WITH RECURSIVE ", 1)


def _metrics_sql() -> str:
    return _walk_sql(
        "SELECT skill, degree, degree_centrality, round(betweenness, 6) AS betweenness_centrality, round(closeness, 6) AS closeness_centrality, "
        f"pagerank, coalesce(c, 0) AS count FROM ({ORACLE['degree_centrality']}) a JOIN between USING (skill) JOIN close USING (skill) "
        f"JOIN ({_PAGERANK_SQL}) b USING (skill) LEFT JOIN ({ORACLE['network_nodes'].replace(' AS count FROM edges UNION', ' AS c FROM edges UNION')}) e USING (skill)"
    )


_GAINS_SQL = (
    "l AS (SELECT unnest(labels) AS x), e AS (SELECT a.x.c AS ci, b.x.c AS cj, sum(weight) / any_value(m) AS e "
    "FROM adj JOIN l a ON a.x.s = src JOIN l b ON b.x.s = dst, total GROUP BY 1, 2), ends AS (SELECT ci, sum(e) AS a FROM e GROUP BY ci), "
    "gains AS (SELECT e.ci, e.cj, 2 * (e - p.a * q.a) AS gain FROM e JOIN ends p ON p.ci = e.ci JOIN ends q ON q.ci = e.cj "
    "WHERE e.ci < e.cj AND 2 * (e - p.a * q.a) >= 0)"
)


def _rounds_sql(best: str, renamed: str) -> str:
    """Clusters by rounds. One row a round: the labels so far, renamed by the pairs that join, until none is left."""
    return sql(
        "adj", "@",
        total="SELECT sum(weight)::DOUBLE AS m FROM adj",
        merges="SELECT 0 AS k, (SELECT list({'s': src, 'c': src} ORDER BY src) FROM (SELECT DISTINCT src FROM adj) q) AS labels UNION ALL "
        f"SELECT k + 1, list_transform(labels, lambda x: {{'s': x.s, 'c': {renamed}}}) "
        f"FROM (SELECT k, labels, (WITH {_GAINS_SQL} {best}) AS best FROM merges) r WHERE best IS NOT NULL",
        final="SELECT unnest(arg_max(labels, k)) AS x FROM merges",
        named="SELECT x.s AS skill, count(*) OVER (PARTITION BY x.c) AS n, min(x.s) OVER (PARTITION BY x.c) AS least FROM final",
    ).replace("WITH ", "WITH RECURSIVE ", 1).replace(
        "@", "SELECT skill, CAST(dense_rank() OVER (ORDER BY n DESC, least) - 1 AS INTEGER) AS cluster FROM named"
    )


# The best pair of communities joins.
_CLUSTERS_SQL = _rounds_sql(
    "SELECT {'keep': ci, 'gone': cj} FROM gains ORDER BY gain DESC, ci, cj LIMIT 1", "CASE WHEN x.c = best.gone THEN best.keep ELSE x.c END"
)
# All pairs join that are the best one of both their communities.
_PARALLEL_SQL = _rounds_sql(
    ", sides AS (SELECT ci AS c, * FROM gains UNION ALL SELECT cj, * FROM gains), "
    "first AS (SELECT * FROM sides QUALIFY row_number() OVER (PARTITION BY c ORDER BY gain DESC, ci, cj) = 1), "
    "mutual AS (SELECT ci, cj FROM first GROUP BY ci, cj HAVING count(*) = 2) SELECT map_from_entries(list((cj, ci))) FROM mutual",
    "coalesce(best[x.c], x.c)",
)

QUERIES = {
    "baskets": lambda s, d: baskets(s, d).select(
        "job_id", F.array_join("skills", ";").alias("skills"), F.size("skills").cast("bigint").alias("n")
    ),
    "skill_counts": lambda s, d: co.skill_counts(baskets(s, d)),
    "pair_counts": lambda s, d: co.pair_counts(baskets(s, d)),
    "cooc_matrix": lambda s, d: co.dense_matrix(materialise(baskets(s, d), "baskets")),
    "assoc_metrics": lambda s, d: rounded(_assoc(s, d), ASSOC_ROUND),
    "assoc_filtered": assoc_filtered,
    "assoc_confident": lambda s, d: rounded(co.confident(_assoc(s, d, co.MIN_SUPPORT), 0.15), ASSOC_ROUND),
    "network_edges": lambda s, d: rounded(
        graph.network_edges(_assoc(s, d, co.MIN_SUPPORT)), ["lift", "support", "confidence"]
    ),
    "network_nodes": lambda s, d: graph.network_nodes(_assoc(s, d, co.MIN_SUPPORT)),
    "degree_centrality": lambda s, d: rounded(graph.degree_centrality(_edges(s, d)), ["degree_centrality"]),
    "betweenness": lambda s, d: rounded(graph.betweenness(_edges(s, d)), ["betweenness"]),
    "closeness": lambda s, d: rounded(graph.closeness(_edges(s, d)), ["closeness"]),
    "pagerank": lambda s, d: rounded(graph.pagerank(_edges(s, d)), ["pagerank"]),
    "network_metrics": _network_metrics,
    "skill_clusters": lambda s, d: communities.greedy_clusters(_edges(s, d)),
    "skill_clusters_parallel": lambda s, d: communities.parallel_clusters(_edges(s, d)),
    "skill_network": _skill_network,
    "top_subgraph": lambda s, d: graph.top_subgraph(_edges(s, d)).select("skill1", "skill2", "weight"),
    "cooc_heatmap": lambda s, d: co.heatmap(co.pair_counts(baskets(s, d)), 250),
    "cooc_for_skill": lambda s, d: co.partners(co.pair_counts(baskets(s, d)), SKILL),
}

ORACLE = {
    "baskets": sql(
        "mentions",
        "SELECT o_orderkey AS job_id, coalesce(string_agg(skill, ';' ORDER BY skill), '') AS skills, count(skill) AS n "
        "FROM orders LEFT JOIN mentions ON job_id = o_orderkey GROUP BY o_orderkey",
    ),
    "skill_counts": sql("counts", "SELECT skill, c AS skill_count FROM counts"),
    "pair_counts": sql("pairs", "SELECT skill1, skill2, n12 AS cooccurrence_count FROM pairs"),
    "cooc_matrix": sql(
        "counts pairs",
        "SELECT a.skill AS skill1, b.skill AS skill2, coalesce(n12, 0) AS count FROM counts a CROSS JOIN counts b "
        "LEFT JOIN pairs ON skill1 = least(a.skill, b.skill) AND skill2 = greatest(a.skill, b.skill)",
    ),
    "assoc_metrics": sql("assoc", _ASSOC_SQL + "assoc"),
    "assoc_filtered": sql("assoc_f", _ASSOC_SQL + "assoc_f"),
    "assoc_confident": sql(
        "assoc_f", _ASSOC_SQL + "assoc_f WHERE greatest(confidence_1_to_2, confidence_2_to_1) >= 0.15"
    ),
    "network_edges": _EDGES_SQL,
    "skill_network": _EDGES_SQL,
    "network_nodes": sql(
        "edges",
        "SELECT skill1 AS skill, skill1_count AS count FROM edges UNION SELECT skill2, skill2_count FROM edges",
    ),
    "degree_centrality": sql(
        "adj",
        "SELECT src AS skill, count(*) AS degree, "
        "round(count(*)::DOUBLE / ((SELECT count(DISTINCT src) FROM adj) - 1), 6) AS degree_centrality FROM adj GROUP BY src",
    ),
    "pagerank": _PAGERANK_SQL,
    "top_subgraph": sql(
        "edges adj",
        "SELECT skill1, skill2, weight FROM edges WHERE skill1 IN (SELECT src FROM top) AND skill2 IN (SELECT src FROM top)",
        top="SELECT src FROM adj GROUP BY src ORDER BY count(*) DESC, src LIMIT 15",
    ),
    "cooc_heatmap": sql("pairs", "SELECT skill1, skill2, n12 AS cooccurrence_count FROM pairs WHERE n12 >= 250"),
    "cooc_for_skill": sql(
        "pairs",
        f"SELECT CASE WHEN skill1 = '{SKILL}' THEN skill2 ELSE skill1 END AS partner, n12 AS count FROM pairs "
        f"WHERE '{SKILL}' IN (skill1, skill2)",
    ),
}
ORACLE |= {
    "closeness": _walk_sql("SELECT skill, round(closeness, 6) AS closeness FROM close"),
    "betweenness": _walk_sql("SELECT skill, round(betweenness, 6) AS betweenness FROM between"),
    "network_metrics": _metrics_sql(),
    "skill_clusters": _CLUSTERS_SQL,
    "skill_clusters_parallel": _PARALLEL_SQL,
}
