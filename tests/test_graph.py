import itertools

import pytest
from helpers import rows

from jobgrain.operators import communities, graph

SCHEMA = "skill1 string, skill2 string, weight bigint"

# a - b - c - d with a triangle c - d - e: worked out by hand.
KITE = [("a", "b", 1), ("b", "c", 1), ("c", "d", 1), ("c", "e", 1), ("d", "e", 1)]


def values(df):
    return {r[0]: r[1] for r in df.collect()}


@pytest.fixture(scope="module")
def kite(spark):
    return spark.createDataFrame(KITE, SCHEMA)


def test_degree(kite):
    found = {r["skill"]: (r["degree"], r["degree_centrality"]) for r in graph.degree_centrality(kite).collect()}
    assert found == {"a": (1, 0.25), "b": (2, 0.5), "c": (3, 0.75), "d": (2, 0.5), "e": (2, 0.5)}


def test_betweenness(kite):
    # Pairs through b: a-c, a-d, a-e; through c: a-d, a-e, b-d, b-e; of 6 pairs each.
    assert values(graph.betweenness(kite)) == pytest.approx({"a": 0, "b": 3 / 6, "c": 4 / 6, "d": 0, "e": 0})


def test_betweenness_shares_equal_paths(spark):
    square = spark.createDataFrame([("a", "b", 1), ("b", "c", 1), ("c", "d", 1), ("a", "d", 1)], SCHEMA)
    assert values(graph.betweenness(square)) == pytest.approx(dict.fromkeys("abcd", 0.5 / 3))


def test_closeness(kite, spark):
    assert values(graph.closeness(kite)) == pytest.approx({"a": 4 / 9, "b": 4 / 6, "c": 4 / 5, "d": 4 / 7, "e": 4 / 7})
    parts = spark.createDataFrame([("a", "b", 1), ("c", "d", 1), ("d", "e", 1)], SCHEMA)
    assert values(graph.closeness(parts)) == pytest.approx(
        {"a": 1 * 1 / 4, "b": 1 * 1 / 4, "c": 2 / 3 * 2 / 4, "d": 2 / 2 * 2 / 4, "e": 2 / 3 * 2 / 4}
    )


def power_iteration(edges, rounds=200):
    weights = {}
    for a, b, w in edges:
        weights.setdefault(a, {})[b] = w
        weights.setdefault(b, {})[a] = w
    n = len(weights)
    rank = dict.fromkeys(weights, 1 / n)
    for _ in range(rounds):
        nxt = {v: 0.15 / n for v in weights}
        for v, near in weights.items():
            for u, w in near.items():
                nxt[u] += 0.85 * rank[v] * w / sum(near.values())
        rank = nxt
    return rank


def test_pagerank(spark):
    edges = [(a, b, w + 1) for w, (a, b, _) in enumerate(KITE)]
    found = values(graph.pagerank(spark.createDataFrame(edges, SCHEMA)))
    assert sum(found.values()) == pytest.approx(1)
    assert found == pytest.approx(power_iteration(edges), abs=1e-5)


def test_pagerank_that_does_not_settle_is_zero(kite):
    assert set(values(graph.pagerank(kite, tolerance=0.0, max_rounds=3)).values()) == {0.0}


def test_network_tables(spark):
    assoc = spark.createDataFrame(
        [("a", "b", 5, 2.0, 0.1, 0.5, 0.4, 9, 8), ("b", "c", 4, 3.0, 0.1, 0.2, 0.6, 8, 7), ("c", "d", 4, 1.0, 0.1, 0.2, 0.3, 7, 6)],
        "skill1 string, skill2 string, cooccurrence_count bigint, lift double, support double, confidence_1_to_2 double, "
        "confidence_2_to_1 double, skill1_count bigint, skill2_count bigint",
    )
    edges, nodes = graph.network_edges(assoc, 2), graph.network_nodes(assoc, 2)
    assert rows(edges, "skill1", "skill2", "weight", "confidence") == [("a", "b", 5, 0.5), ("b", "c", 4, 0.6)]
    assert rows(nodes) == [("a", 9), ("b", 8), ("c", 7)]
    metrics = graph.network_metrics(edges, nodes)
    assert [r["skill"] for r in metrics.collect()] == ["b", "a", "c"]
    assert {"degree", "degree_centrality", "betweenness_centrality", "closeness_centrality", "pagerank", "count"} < set(metrics.columns)
    assert rows(graph.top_subgraph(edges, 2).select("skill1", "skill2")) == [("a", "b")]


def cliques():
    pairs = [*itertools.combinations("abcd", 2), *itertools.combinations("vwxyz", 2), ("d", "v")]
    return [(a, b, 1) for a, b in pairs]


@pytest.mark.parametrize("method", [communities.greedy_clusters, communities.parallel_clusters])
def test_two_cliques(spark, method):
    edges = spark.createDataFrame(cliques(), SCHEMA)
    found = values(method(edges))
    assert found == {**dict.fromkeys("vwxyz", 0), **dict.fromkeys("abcd", 1)}
    alone = communities.modularity(edges, method(edges)).first()[0]
    assert alone == pytest.approx((12 / 34 - (13 / 34) ** 2) + (20 / 34 - (21 / 34) ** 2))


def test_greedy_against_plain_merging(spark):
    edges = KITE + [("a", "f", 3), ("f", "g", 2), ("g", "a", 1), ("e", "h", 4)]
    total = 2 * sum(w for _, _, w in edges)
    e = {}
    for a, b, w in edges:
        e[a, b] = e.get((a, b), 0) + w / total
        e[b, a] = e.get((b, a), 0) + w / total
    member = {v: v for pair in e for v in pair}
    while True:
        a = {c: sum(w for (x, _), w in e.items() if x == c) for c in set(member.values())}
        gains = [(-2 * (w - a[x] * a[y]), x, y) for (x, y), w in e.items() if x < y]
        if not gains or min(gains)[0] > 0:
            break
        _, keep, gone = min(gains)
        merged = {}
        for (x, y), w in e.items():
            key = (keep if x == gone else x, keep if y == gone else y)
            merged[key] = merged.get(key, 0) + w
        e, member = merged, {v: keep if c == gone else c for v, c in member.items()}
    found = values(communities.greedy_clusters(spark.createDataFrame(edges, SCHEMA)))
    same = lambda m: {frozenset(v for v in m if m[v] == c) for c in m.values()}
    assert same(found) == same(member)


def mesh(n=48):
    """A ring with chords, so that paths differ in length and number."""
    return [(f"n{min(i, j):02}", f"n{max(i, j):02}", 1) for i in range(n) for j in ((i + 1) % n, (i * 7 + 3) % n) if i != j]


def test_sampled_sources(spark):
    edges = spark.createDataFrame(sorted(set(mesh())), SCHEMA)
    exact = values(graph.closeness(edges)), values(graph.betweenness(edges))
    for k, close, between in ((48, 1e-9, 1e-9), (500, 1e-9, 1e-9), (12, 0.15, 0.06)):
        levels = graph.shortest_paths(edges, k)
        assert levels[0].count() == min(k, 48)
        near, passed = values(graph.closeness(edges, levels, k)), values(graph.betweenness(edges, levels, k))
        assert max(abs(near[x] - exact[0][x]) for x in exact[0]) < close
        assert max(abs(passed[x] - exact[1][x]) for x in exact[1]) < between
        assert set(near) == set(passed) == set(exact[0])


def test_rank_rounds_shuffle_no_links(spark, monkeypatch):
    edges = spark.createDataFrame(sorted(set(mesh())), SCHEMA)
    expected, plans = values(graph.pagerank(edges)), []
    monkeypatch.setattr(graph, "sized", lambda df, rows: df)
    cut = graph.cut_lineage

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    monkeypatch.setattr(graph, "cut_lineage", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert values(graph.pagerank(edges)) == pytest.approx(expected)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    rounds = [p for p in plans if "SortMergeJoin" in p and "Bucketed: true" in p]
    # Five joins a batch: the ranks are dealt once before the first and once by each aggregate, the links never.
    assert rounds and all(p.count("Exchange") == 6 and p.count("Exchange hashpartitioning(dst") == 5 for p in rounds)


def test_a_merge_is_one_action(spark, monkeypatch):
    writes, cut = [], communities.cut_lineage
    monkeypatch.setattr(communities, "cut_lineage", lambda df: writes.append(df) or cut(df))
    edges = spark.createDataFrame(sorted(set(mesh(12))), SCHEMA)
    clusters = communities.greedy_clusters(edges).select("cluster").distinct().count()
    assert len(writes) == 1 + 12 - clusters + 1  # the shares, one a merge, and the round that finds no gain
