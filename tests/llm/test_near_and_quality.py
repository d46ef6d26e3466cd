import hashlib
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
import corpus_pipeline
from jobgrain.llm import bpe, decontaminate, exact, quality, simhash

DATA = Path("/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not DATA.exists(), reason="driver tables are not here")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
BLANK_WORD, WORD = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_fingerprint(text):
    words = BLANK_WORD.findall((text or "").translate(LOWER))
    pieces = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots_of(nodes, near):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in nodes:
        for b in nodes:
            if near(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_fingerprints_and_components(odd_docs, odd_rows, no_docs):
    prints = [plain_fingerprint(t) for _, t in odd_rows]
    roots = roots_of(set(prints), lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for (i, _), p in zip(odd_rows, prints):
        if i is not None:
            least[roots[p]] = min(least.get(roots[p], i), i)
    expected = Counter((i, f"{p:016x}", least.get(roots[p])) for (i, _), p in zip(odd_rows, prints))
    for hot in (512, 0):
        assert Counter(tuple(r) for r in simhash.near_duplicates(odd_docs, hot=hot).collect()) == expected
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert Counter(roots[plain_fingerprint(r.text)] for r in kept.collect()) == Counter(set(roots.values()))
    assert simhash.near_duplicates(no_docs).count() == simhash.keep_one(no_docs).count() == 0


def test_dense_groups_lose_no_link(spark):
    rng = np.random.default_rng(2)
    centres, values = rng.integers(0, 2**63, 3), set()
    for k in range(150):
        value = int(centres[k % 3])
        for b in rng.integers(0, 64, rng.integers(0, 4)):
            value ^= 1 << int(b)
        values.add(simhash._signed(value & (2**64 - 1)))
    values |= {int(x) for x in rng.integers(-(2**63), 2**63 - 1, 40)}
    expected = roots_of(values, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 4)
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    for hot in (512, 5):
        assert {r.fp: r.root for r in simhash.classes(frame, hot=hot).collect()} == expected


def test_plans_keep_the_pigeonhole_sum():
    for total in (0, 1000, 10**6, 10**10):
        both = np.full((64, 64), total / 4) + np.eye(64) * total / 4
        groups = simhash.plan(total, both)
        assert sum(g.threshold + 1 for g in groups) == simhash.DISTANCE + 1
        assert sum(g.mask for g in groups) == 2**64 - 1


def plain_passages(docs, items):
    windows = {}
    for k, t in items:
        w = WORD.findall((t or "").translate(LOWER))
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[i : i + 13]), set()).add("" if k is None else str(k))
    sizes, found = {len(w) for w in windows}, []
    for i, t in docs:
        w = WORD.findall((t or "").translate(LOWER))
        hit, names = [False] * len(w), set()
        for size in sizes:
            for at in range(len(w) - size + 1):
                if tuple(w[at : at + size]) in windows:
                    names |= windows[tuple(w[at : at + size])]
                    hit[at : at + size] = [True] * size
        found.append((i, len(w), sum(hit), tuple(sorted(names)), sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return found


@pytest.mark.parametrize("block", [10**6, 40])
def test_passages_against_plain_python(spark, block):
    rng = random.Random(1)
    letters = "a b c D é 1 x-y".split()
    items = [(i or None, " ".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 3, 5, 13, 14, 20])))) for i in range(30)] + [(3, None), (4, "...")]
    docs = [(i, " ".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 4, 30, 80])))) for i in range(60)] + [(None, None), (7, "")]
    docs += [(100 + i, "zz " * rng.randint(0, 30) + (items[rng.randrange(30)][1] + " ") * rng.randint(1, 2) + "q") for i in range(30)]
    table = spark.createDataFrame([(*d, 1, "x", b"y") for d in docs], "doc_id long, text string, n_hit int, items string, hits binary")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_passages(table, benchmark, block=block).collect()
    expected = plain_passages(docs, items)
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in got) == Counter(expected)
    clean = decontaminate.drop_contaminated(table, benchmark, block=block)
    assert clean.columns == table.columns and clean.count() == sum(not e[-1] for e in expected)


@pytest.mark.parametrize("block", [decontaminate.BLOCK, 40])
def test_windows_of_long_and_short_items(spark, block):
    items = [(1, " ".join(f"w{i}é," for i in range(200))), (2, "one Two"), (3, None), (4, " ".join(f"v{i}" for i in range(40))), (None, "a-b")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    expected = Counter()
    for k, t in items:
        w = WORD.findall((t or "").translate(LOWER))
        expected.update(("" if k is None else str(k), " ".join(w[i : i + 13])) for i in range(max(1, len(w) - 12) if w else 0))
    got = decontaminate.windows_of(benchmark, block=block).collect()
    assert Counter((r.item, r.win) for r in got) == expected
    assert all(r.n == len(r.win.split()) and len(r.codes) == r.n - min(r.n, 3) + 1 for r in got)


def test_bits_lose_no_shingle(spark, monkeypatch):
    codes = np.random.default_rng(3).integers(-(2**63), 2**63 - 1, 5000)
    frame = spark.createDataFrame([(int(c),) for c in codes], "code long")
    others = np.random.default_rng(4).integers(-(2**63), 2**63 - 1, 100_000).view(np.uint64)
    bits = decontaminate.bits_of(frame, 5000)
    assert len(bits.held(codes.view(np.uint64))) == 5000 and len(bits.held(others)) < 200
    monkeypatch.setattr(decontaminate, "MOST_BITS", 16)
    small = decontaminate.bits_of(frame, 5000)
    assert len(small.words) == 1 << 10 and len(small.held(codes.view(np.uint64))) == 5000


def test_a_full_array_of_bits_changes_no_result(spark, monkeypatch):
    """Every shingle passes an array that is too small; long and hot texts come back whole, in several batches."""
    monkeypatch.setattr(decontaminate, "MOST_BITS", 16)
    monkeypatch.setattr(decontaminate, "BITS_PER_KEY", 0)
    monkeypatch.setattr(decontaminate, "PLACES", 50)
    monkeypatch.setattr(decontaminate.Bits, "held", lambda self, codes: np.arange(len(codes)))
    rng = random.Random(8)
    prose = [" ".join(rng.choice("red blue one two six".split()) for _ in range(30)) for _ in range(8)]
    items = [(k, t) for k, t in enumerate(prose)] + [(50, prose[0]), (51, "red"), (52, "blue one")]
    docs = [(i, prose[0]) for i in range(40)] + [(100, " x ".join(prose * 3)), (101, "six " * 500), (102, prose[1][:40])]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_passages(table, benchmark).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in got) == Counter(plain_passages(docs, items))


def test_passages_of_empty_tables(spark, odd_docs, no_docs):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_passages(odd_docs, nothing).filter("n_hit > 0 or contaminated").count() == 0
    assert decontaminate.find_passages(no_docs, nothing).count() == 0


def test_quality_gradients_are_right():
    rng = np.random.default_rng(0)
    texts = [bytes(rng.integers(97, 105, n).astype(np.uint8)) for n in (0, 2, 5, 130, 300, 700)]
    labels = np.array([0, 1, 1, 0, 1, 0], np.float64)
    net = quality.Network(
        rng.normal(0, 0.3, (quality.WIDTH, 256, quality.FILTERS)), np.full(quality.FILTERS, 0.5), rng.normal(0, 0.3, quality.FILTERS), rng.normal(0, 0.3, quality.FILTERS), 0.1
    )

    def loss(weights):
        p = quality.probabilities(weights, texts)
        return -np.mean(np.where(labels == 1, np.log(p), np.log(1 - p)))

    gradients = quality._gradients(net, texts, labels)
    for k, name in enumerate(("filters", "bias", "mean", "largest")):
        at = np.unravel_index(np.abs(gradients[k]).argmax(), gradients[k].shape)
        up, down = getattr(net, name).copy(), getattr(net, name).copy()
        up[at] += 1e-3
        down[at] -= 1e-3
        assert gradients[k][at] == pytest.approx((loss(net._replace(**{name: up})) - loss(net._replace(**{name: down}))) / 2e-3, rel=5e-2)


def test_scores_cover_the_whole_text_and_do_not_depend_on_the_batch():
    rng = np.random.default_rng(5)
    net = quality.fit([b"good words here " * 30, b"*** !!! *** " * 30] * 20, np.array([1, 0] * 20, np.float32), epochs=4)
    texts = [b"", b"a", b"good words here " * 30, b"*** !!! *** " * 30, bytes(rng.integers(32, 127, 700_000).astype(np.uint8))]
    alone = [quality.probabilities(net, [t])[0] for t in texts]
    assert quality.probabilities(net, texts) == pytest.approx(alone, abs=1e-6)
    assert alone[2] > 0.7 > 0.3 > alone[3]
    long = b"good words here " * 5000
    assert quality.probabilities(net, [long + b"*** !!! *** " * 2000])[0] < quality.probabilities(net, [long])[0]


def test_scores_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(18)] + [(3, 0), (4, None), (None, 1), (999, 1)], "doc_id long, quality int")
    got = quality.score(odd_docs, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in odd_rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    assert quality.keep_good(odd_docs, labels).columns == odd_docs.columns
    assert quality.score(no_docs, labels.limit(0)).count() == 0
    assert {r.score for r in quality.score(odd_docs, labels.limit(0)).collect()} == {0.5}


@needs_data
def test_held_out_accuracy():
    folder = DATA.parent / "sf0.1"
    rows = duckdb.sql(f"SELECT doc_id, text, quality FROM '{folder}/documents.parquet' JOIN '{folder}/labels.parquet' USING (doc_id) ORDER BY doc_id").fetchall()
    held = [zlib.crc32(str(r[0]).encode()) % 4 == 2 for r in rows]
    taught = [r for r, h in zip(rows, held) if not h][: quality.SAMPLE]
    net = quality.fit([r[1].encode() for r in taught], np.array([r[2] for r in taught], np.float32))
    rest = [r for r, h in zip(rows, held) if h]
    scores, truth = quality.probabilities(net, [r[1].encode() for r in rest]), np.array([r[2] for r in rest])
    assert ((scores >= 0.7) == truth).mean() > 0.97


@needs_data
def test_pipeline_against_its_stages_in_plain_python(spark, word_path, word_tokenizer):
    read = lambda name: duckdb.sql(f"SELECT * FROM '{DATA}/{name}.parquet'").fetchall()
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    good = {r.doc_id for r in quality.score(docs, labels).filter("predicted = 1").collect()}
    rows = [(r[0], r[1]) for r in read("documents") if r[0] in good]
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i, t))
    rows = [min(g)[1:] for g in groups.values()]
    prints = {i: plain_fingerprint(t) for i, t in rows}
    roots = roots_of(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for i, _ in rows:
        least[roots[prints[i]]] = min(least.get(roots[prints[i]], i), i)
    rows = [(i, t) for i, t in rows if least[roots[prints[i]]] == i]
    passages = {e[0]: e[-1] for e in plain_passages(rows, [(r[0], r[1]) for r in read("benchmark")])}
    expected = set()
    for i, t in rows:
        if not passages[i]:
            ids = word_tokenizer.encode(t or "", add_special_tokens=False).ids
            expected.add((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()))
    got = {(r.doc_id, r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, str(DATA)).collect()}
    assert got == expected and 0 < len(got) < docs.count()


def test_stages_call_the_operators():
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality classifier" and len(corpus_pipeline.STAGES) == 5
    assert {f"op{n}" for n in range(1, 11)} <= {q.split("_")[0] for q in entry.queries()}
    assert "pipeline" in entry.queries() and all(m for m in (bpe, exact))


def test_a_crowded_value_costs_in_proportion(spark, monkeypatch):
    """Many fingerprints share one group value; rows out of the join stay few, so the work cannot be that of all pairs."""
    rng = random.Random(8)
    seen = {}
    crowd = [(rng.getrandbits(40) << 24) - (1 << 63) + 5 for _ in range(3000)]
    fps = spark.createDataFrame([(x,) for x in {*crowd, *(c ^ 0b11 << 50 for c in crowd[:40])}], "fp long")
    low = tuple(range(24))
    groups = [simhash.Group((1 << 24) - 1, low, 0), *(simhash.Group(sum(1 << b for b in range(a, a + 10)), tuple(range(a, a + 10)), 0) for a in (24, 34, 44, 54))]
    for hot in (5, 512, 10**6):
        pairs = simhash.links(fps, groups, 4, hot)
        seen[hot] = {tuple(sorted((r.node, r.root))) for r in simhash.components(pairs).collect()}
    assert seen[5] == seen[512] == seen[10**6] and len(seen[5]) >= 40
    joined = simhash.links(fps, groups, 4, 512)._jdf.queryExecution().optimizedPlan().toString()
    assert "NOT dense" in joined
