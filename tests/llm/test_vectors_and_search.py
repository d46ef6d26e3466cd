import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jobgrain.llm import lexical, pivot_index, vectors, whitening
from jobgrain.llm.simhash import components

VECTORS = "vec_id long, embedding array<double>, label int, digest string, gid long, n long, x long, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "d", 2, 3, 4, "c") for i, v in rows], VECTORS)


def near(rng, base, cosine):
    other = rng.standard_normal(len(base))
    base = base / np.linalg.norm(base)
    other -= other @ base * base
    return cosine * base + math.sqrt(1 - cosine**2) * other / np.linalg.norm(other)


@pytest.fixture(scope="module")
def planted():
    """Groups of several sizes and spreads among single vectors, copies, a scaled copy and a chain."""
    rng = np.random.default_rng(5)
    rows = [rng.standard_normal(48) for _ in range(900)]
    for size, cosine in ((2, 0.93), (3, 0.97), (40, 0.96), (700, 0.99)):
        base = rng.standard_normal(48)
        rows += [near(rng, base, cosine) for _ in range(size)]
    rows += [rows[0]] * 30 + [rows[1] * 3, rows[2] * 1e-200, rows[2] * 1e200]
    step = rng.standard_normal(48)
    for _ in range(6):
        rows.append(step)
        step = near(rng, step, 0.94)
    order = rng.permutation(len(rows))
    return [(int(i), rows[i].tolist()) for i in order]


def brute_links(rows):
    """Links and component of every row, the rows numbered as given."""
    good = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    where = [k for k, g in enumerate(good) if g]
    links = {k: set() for k in range(len(rows))}
    for length in {len(rows[k][1]) for k in where}:
        own = [k for k in where if len(rows[k][1]) == length]
        units = vectors.unit(np.array([rows[k][1] for k in own], dtype=float))
        for a, b in zip(*np.nonzero(units @ units.T >= 0.9)):
            if a != b:
                links[own[a]].add(own[b])
    out = {}
    for k, (i, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for x in links[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        ids = [rows[x][0] for x in seen if rows[x][0] is not None]
        least = min(ids) if ids else None
        out.setdefault((i, len(links[k]), least, i == least), []).append(k)
    return Counter({key: len(v) for key, v in out.items()})


def found_links(df):
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    return Counter(tuple(r) for r in df.collect())


def test_links_against_all_pairs(spark, planted):
    found, true = found_links(pivot_index.similar_vectors(frame(spark, planted))), brute_links(planted)
    count = lambda x: sum(k[1] * n for k, n in x.items())
    assert count(found) <= count(true)
    assert count(found) >= 0.99 * count(true)
    assert sum(found.values()) == len(planted)
    assert sum((found & true).values()) >= 0.97 * len(planted)


def test_whole_lists_are_read_in_blocks(spark, planted, monkeypatch):
    monkeypatch.setattr(pivot_index, "BLOCK", 16)
    small = [r for r in planted if 860 <= r[0] < 1200]
    assert found_links(pivot_index.similar_vectors(frame(spark, small))) == brute_links(small)


def test_a_pair_has_one_owner():
    rng = np.random.default_rng(0)
    pivots = vectors.unit(rng.standard_normal((256, 16)))
    rows = vectors.unit(np.repeat(rng.standard_normal((30, 16)), 2, axis=0) + 0.05 * rng.standard_normal((60, 16)))
    order = pivot_index.nearest(rows, pivots)
    first = np.sort(order[:, :8], axis=1)
    words = pivot_index.bit_words(order).view(np.int64)
    places = {}
    for r in range(60):
        for a in range(8):
            for b in range(a + 1, 8):
                for c in range(b + 1, 8):
                    places.setdefault((16 << 24) + (int(first[r, a]) << 16) + (int(first[r, b]) << 8) + int(first[r, c]), []).append(r)
    flat = [(k, r) for k in sorted(places) for r in places[k]]
    at = [r for _, r in flat]
    table = pa.table({
        "key": [k for k, _ in flat], "lo": [0] * len(flat), "hi": [0] * len(flat), "block": [0] * len(flat),
        "near": np.ascontiguousarray(first.astype(np.uint8)).view("<i8")[at, 0], **{f"w{j}": words[at, j] for j in range(4)},
    })
    pairs = Counter((min(at[a], at[b]), max(at[a], at[b])) for i, j in pivot_index.owned_pairs(table, 14) for a, b in zip(i, j))
    shared = {
        (a, b) for a in range(60) for b in range(a + 1, 60)
        if len({*first[a]} & {*first[b]}) >= 3 and len({*order[a]} & {*order[b]}) >= 14
    }
    assert set(pairs) == shared and set(pairs.values()) == {1}
    assert {(2 * k, 2 * k + 1) for k in range(30)} <= shared


def test_recall_of_the_description():
    rng = np.random.default_rng(1)
    pivots = pivot_index.choose_pivots(rng.standard_normal((2048, 64)))
    for cosine, least in ((0.9, 0.95), (0.95, 0.99)):
        a = vectors.unit(rng.standard_normal((1500, 64)))
        b = np.array([near(rng, x, cosine) for x in a])
        x, y = pivot_index.nearest(a, pivots), pivot_index.nearest(b, pivots)
        met = [len({*p[:8]} & {*q[:8]}) >= 3 and len({*p} & {*q}) >= 14 for p, q in zip(x.tolist(), y.tolist())]
        assert np.mean(met) >= least


def test_pivots_stay_apart_and_fill_up():
    rng = np.random.default_rng(2)
    crowd = np.array([near(rng, np.ones(32), 0.99) for _ in range(500)] + [rng.standard_normal(32) for _ in range(20)])
    pivots = pivot_index.choose_pivots(crowd, 64)
    assert pivots.shape == (64, 32) and np.allclose((pivots**2).sum(axis=1), 1)
    assert (np.triu(pivots[:21] @ pivots[:21].T, 1) < pivot_index.APART).all()


ODD = [
    (1, [1, 0, 0]), (1, [1, 0, 0]), (2, [1, 0.1, 0]), (None, [1, 0.1, 0]), (None, [0, 1, 0]), (3, None), (4, []), (5, [0, 0, 0]),
    (6, [1, None, 0]), (7, [math.nan, 1, 0]), (8, [math.inf, 1, 0]), (9, [1, 0]), (10, [2, 0.0]), (11, [-0.0, 0, -1]), (0, [0.0, 0, -5]), (None, None),
]


def test_links_of_odd_rows(spark):
    assert found_links(pivot_index.similar_vectors(frame(spark, ODD))) == brute_links(ODD)
    assert pivot_index.similar_vectors(frame(spark, [])).count() == 0
    assert found_links(pivot_index.similar_vectors(frame(spark, [(1, None), (2, [0, 0])]))) == Counter({(1, 0, 1, True): 1, (2, 0, 2, True): 1})


def expected_whitening(rows, count):
    lengths = Counter(len(v) for v in {tuple(whole(v)) for _, v in rows if usable(v)})
    width = max(lengths, key=lambda k: (lengths[k], k))
    kept = [(i, whole(v)) for i, v in rows if usable(v) and len(v) == width]
    x = np.array([v for _, v in kept])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    y = fit - s / n
    spread = y.T @ y / n
    values, vecs = np.linalg.eigh(spread)
    values, vecs = values[::-1][:count], vecs[:, ::-1][:, :count]
    deviation = [int(sum((n * int(a) - int(b)) ** 2 for a, b in zip(v, s))) for v in x]
    return [i for i, _ in kept], n, deviation, (x - s / n) @ (vecs / np.sqrt(values)), values / np.trace(spread)


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


def whole(v):
    return [math.floor(64 * x) + 1_000_000 for x in v]


def check_whitening(df, rows, count):
    ids, n, deviation, white, explained = expected_whitening(rows, count)
    got = df.orderBy("component").collect()
    assert len(got) == len(ids) * count and all(r["n"] == n and r["identity_error"] <= 1e-9 for r in got)
    for c in range(count):
        part = [r for r in got if r["component"] == c + 1]
        assert np.allclose([r["explained"] for r in part], explained[c], rtol=1e-9)
        a = sorted((str(r["vec_id"]), r["deviation"], r["whitened"]) for r in part)
        sides = [sorted((str(i), d, s * w) for i, d, w in zip(ids, deviation, white[:, c])) for s in (1, -1)]
        assert [x[:2] for x in a] == [x[:2] for x in sides[0]]
        assert min(np.abs(np.array([x[2] for x in a]) - [x[2] for x in s]).max() for s in sides) < 1e-7


def test_whitening_against_a_dense_solver(spark):
    rng = np.random.default_rng(3)
    scale = np.linspace(3, 0.5, 24)
    rows = [(k, (rng.standard_normal(24) * scale).tolist()) for k in range(600)]
    rows += [(1000 + k, rows[0][1]) for k in range(300)] + [(None, rows[1][1]), (5, [None] * 24), (6, [math.inf] * 24), (7, None), (8, []), (9, [1.0] * 7)]
    check_whitening(whitening.whiten(frame(spark, rows)), rows, 16)


def test_whitening_of_few_dimensions_and_equal_eigenvalues(spark):
    rng = np.random.default_rng(4)
    rows = [(k, rng.standard_normal(3).tolist()) for k in range(50)]
    check_whitening(whitening.whiten(frame(spark, rows)), rows, 3)
    cross = [(k, [s * (j == i) * 1.0 for j in range(20)]) for k, (i, s) in enumerate((i, s) for i in range(20) for s in (1, -1))]
    got = whitening.whiten(frame(spark, cross)).collect()
    assert len(got) == 40 * 16 and max(r["identity_error"] for r in got) < 1e-9
    assert np.allclose([r["explained"] for r in got], 1 / 20)


def test_whitening_of_odd_rows(spark):
    for rows in ([], [(1, None), (2, []), (3, [math.nan])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.001, 2.0])]):
        assert whitening.whiten(frame(spark, rows)).count() == 0
    rank_one = whitening.whiten(frame(spark, [(k, [k * 1.0, k * 2.0, 5.0]) for k in range(9)]))
    assert {r["component"] for r in rank_one.collect()} == {1}
    huge = whitening.whiten(frame(spark, [(k, [10.0 ** (300 if k == 0 else 1), k * 1.0]) for k in range(9)])).collect()
    assert {r["deviation"] for r in huge if r["vec_id"] == 0} == {None}


def test_inertia_counts():
    rng = np.random.default_rng(6)
    for d in (1, 2, 7, 40):
        a = rng.standard_normal((d, d))
        for m in (a + a.T, a @ a.T, np.diag(np.arange(d) % 3 - 1.0), np.fliplr(np.eye(d))):
            values = np.linalg.eigvalsh(m)
            for shift in np.append(rng.uniform(values[0] - 1, values[-1] + 1, 9), 0.31):
                assert whitening.count_above(m, shift) == (values > shift).sum()


def test_a_missed_component_fails():
    with pytest.raises(RuntimeError, match="the inertia counts 3"):
        whitening.contour(np.diag([1.0, 2.0, 3.0, 9.0]), 1.5, 4.0, 3)


def test_slices_hold_the_wanted_eigenvalues():
    rng = np.random.default_rng(8)
    a = rng.standard_normal((80, 200))
    values = np.linalg.eigvalsh(a @ a.T)[::-1]
    parts = whitening.slices(a @ a.T, 16)
    assert sum(n for *_, n in parts) == 16 and max(n for *_, n in parts) <= whitening.SLICE
    assert [n for lo, hi, n in parts] == [int(((values > lo) & (values <= hi)).sum()) for lo, hi, _ in parts]


DOCS = "doc_id long, text string, n long, q long, score long, terms string, rank int, item_id string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3, "t", 4, "i") for i, t in rows], DOCS)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "item_id long, text string, doc_id long, q long")


def plain_terms(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute_ranks(docs, items, top=50):
    held = [(i, Counter(plain_terms(t))) for i, t in docs]
    n_docs, length = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in held:
            n, score = sum(c.values()), 0
            for t in set(plain_terms(text)) & set(c):
                m = 50 + (50 * n * n_docs) // length
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, i is None, i))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(found[:top])]
    return Counter(out)


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(7)
    words = np.array([f"w{k}" if k % 3 else f"Größe{k}" for k in range(400)])
    chance = 1 / np.arange(1, 401)
    make = lambda n: " ".join(rng.choice(words, n, p=chance / chance.sum()))
    docs = [(int(i), make(int(rng.integers(1, 120)))) for i in rng.permutation(700)]
    docs += [(800 + k, docs[3][1]) for k in range(60)] + [(900, make(20_000)), (901, None), (902, ""), (903, "¡!"), (None, docs[3][1]), (3, "w1 w2"), (3, "w1 w2")]
    items = [(k, make(int(rng.integers(1, 40)))) for k in range(25)] + [(25, None), (26, "?!"), (27, "nowhere"), (3, "w1 W2, w1"), (None, "w4")]
    return docs, items


def test_ranks_against_full_evaluation(spark, corpus):
    docs, items = corpus
    got = lexical.rank(docs_of(spark, docs), items_of(spark, items))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(r) for r in got.collect()) == brute_ranks(docs, items)


def test_small_shards_small_blocks_and_plain_bounds(spark, corpus):
    docs, items = corpus
    got = lexical.rank(docs_of(spark, docs), items_of(spark, items), top=7, postings=500, vocabulary=600, paired=False)
    assert Counter(tuple(r) for r in got.collect()) == brute_ranks(docs, items, 7)
    got = lexical.rank(docs_of(spark, docs), items_of(spark, items), top=7, postings=500, vocabulary=600)
    assert Counter(tuple(r) for r in got.collect()) == brute_ranks(docs, items, 7)


def test_empty_tables(spark, corpus):
    docs, items = corpus
    assert lexical.rank(docs_of(spark, []), items_of(spark, items)).count() == 0
    assert lexical.rank(docs_of(spark, docs), items_of(spark, [])).count() == 0
    assert lexical.rank(docs_of(spark, [(1, None), (2, "?")]), items_of(spark, items)).count() == 0


def _shard(rng, documents=3000, terms=30):
    held, tfs, sizes = [], [], []
    for _ in range(documents):
        own = np.flatnonzero(rng.random(terms) < 1.2 / np.arange(1, terms + 1) ** 0.7)
        held.append(own)
        tfs.append(rng.geometric(0.5, len(own)))
        sizes.append(len(own))
    flat = np.concatenate(held).astype(np.int32)
    df = np.bincount(flat, minlength=terms)
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df])
    pairs = np.array([(a, b) for a in range(8) for b in range(a + 1, 8)])
    n = rng.integers(20, 400, documents)
    total = documents, int(n.sum())
    return lexical.invert(pa.array(rng.permutation(documents)), n, np.array(sizes), flat, np.concatenate(tfs), weights, total, pairs)


def test_pair_bounds_hold_and_skip_more():
    rng = np.random.default_rng(9)
    lists = _shard(rng)
    dense = np.zeros((len(lists.ids), 30), np.int64)
    for k, t in enumerate(lists.terms):
        part = slice(lists.ends[k], lists.ends[k + 1])
        dense[lists.docs[part], t] = lists.impacts[part]
    assert all((dense[:, a] + dense[:, b]).max() == joint for (a, b), joint in lists.joint.items())
    read = Counter()
    for _ in range(60):
        terms = sorted(rng.choice(30, int(rng.integers(1, 16)), replace=False).tolist())
        order = sorted(terms, key=lambda t: -lists.greatest[t])
        greatest = [int(lists.greatest[t]) for t in order]
        tight, loose = lexical.remaining(order, greatest, lists.joint), lexical.remaining(order, greatest, {})
        for k in range(len(order) + 1):
            assert dense[:, order[k:]].sum(axis=1).max(initial=0) <= tight[k] <= loose[k]
        whole = dense[:, terms].sum(axis=1)
        full = sorted(((-s, d) for d, s in enumerate(whole.tolist()) if s > 0))[:10]
        for paired in (True, False):
            docs, scores, n = lexical.best_of(lists, terms, 10, paired=paired)
            assert [(-s, d) for d, s in zip(docs.tolist(), scores.tolist())] == full
            read[paired] += n
    assert read[True] < read[False]


def test_terms_are_bytes_of_the_pattern():
    text = "Ünï×Code_A1-b\x7fZ ¡x! 中文 y\x00K"
    assert [t.decode() for t in lexical.terms_of(text)] == plain_terms(text)
    assert lexical.terms_of(None) == []


def test_components_take_ordered_structs(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (7, 8)], "a long, b long").select(F.struct("a").alias("a"), F.struct(F.col("b").alias("a")).alias("b"))
    assert {(r.node.a, r.root.a) for r in components(edges).collect()} >= {(2, 1), (3, 1), (8, 7)}
