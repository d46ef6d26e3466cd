import random
import re

import numpy as np
import pytest
from helpers import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from jobgrain.functions import text
from jobgrain.functions.membership import KeyFilter
from jobgrain.operators import embedding, extraction
from jobgrain.sources.lexicon import lexicon_phrases, phrase_keys


def extract(spark, lexicon, texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "job_id int, description_clean string")
    found = extraction.extract_phrases(df, lexicon, **options)
    return [r["skills"] for r in found.orderBy("job_id").collect()]


TEXTS = [
    "We need PYTHON and sql, plus Py",
    "Looking for ML expert in machine   learning",
    "SQL Server and C++ (cpp), CI/CD",
    "nothing here",
    "",
    None,
    "Python " * 1000,
    "machine-learning is not machine learning; team work is not teamwork",
]
EXPECTED = [
    ["python", "sql"], ["machine learning"], ["c++", "ci/cd", "sql", "sql server"], [], [], [], ["python"],
    ["machine learning", "teamwork"],
]


def test_phrases(spark, small_lexicon):
    assert extract(spark, small_lexicon, TEXTS) == EXPECTED


def test_large_lexicon_takes_the_join(spark, small_lexicon):
    assert extract(spark, small_lexicon, TEXTS, inline_phrases=2) == EXPECTED


def test_no_shuffle_with_inlined_lexicon(spark, small_lexicon):
    df = spark.createDataFrame([(1, "python")], "job_id int, description_clean string")
    plan = extraction.extract_phrases(df, small_lexicon)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_missing_column(spark, small_lexicon):
    df = spark.createDataFrame([(1, "x")], "job_id int, other string")
    with pytest.raises(AnalysisException):
        extraction.extract_phrases(df, small_lexicon).count()


def test_lexicon_phrases(spark, small_lexicon):
    found = rows(lexicon_phrases(small_lexicon).filter("skill LIKE 'machine%' OR skill = 'teamwork'"), "skill", "phrase")
    assert found == [("machine learning", "machine learning"), ("machine learning", "ml"), ("teamwork", "teamwork")]
    assert rows(phrase_keys(small_lexicon).filter("skill = 'ci/cd'"), "phrase_key", "n_tokens") == [
        ("ci / cd", 3), ("continuous integration", 2),
    ]


@pytest.mark.parametrize("inline", [2000, 3])
def test_offsets_against_plain_search(spark, small_lexicon, inline):
    random.seed(3)
    words = ["python", "SQL", "server", "ML", "machine", "learning", "of", "C++", "ci", "cd", "teamwork", "é"]
    texts = ["".join(random.choice(words) + random.choice([" ", "  ", ", ", "/", "\n"]) for _ in range(n)) for n in (1, 7, 200, 900)]
    texts += ["SQL Server", " python", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "job_id int, t string")
    found = set(rows(extraction.phrase_offsets(df, small_lexicon, "t", "job_id", inline), "job_id", "start", "end", "skill", "surface"))
    token = re.compile(r"[^\W_]+(?:\.[^\W_]+)*[+#]*|[^\s\w]|_")
    keys = [(r["skill"], r["phrase_key"].split(" ")) for r in phrase_keys(small_lexicon).collect()]
    expected = set()
    for i, t in enumerate(texts):
        spans = [(m.start(), m.end(), m.group().lower()) for m in token.finditer(t)]
        for skill, key in keys:
            for at in range(len(spans) - len(key) + 1):
                if [s[2] for s in spans[at : at + len(key)]] == key:
                    start, end = spans[at][0], spans[at + len(key) - 1][1]
                    expected.add((i, start, end, skill, t[start:end]))
    assert found == expected and len(expected) > 300
    matched = extraction.match_phrases(df, small_lexicon, "t", "job_id")
    assert matched.count() == len(expected)


def test_skill_columns_flags_and_statistics(spark):
    df = spark.createDataFrame(
        [(1, ["sql", "c++"]), (2, ["sql"]), (3, []), (4, ["ci/cd", "sql", "a b-c"])], "job_id int, skills array<string>"
    )
    wide = extraction.add_skill_flags(extraction.add_skill_columns(df), top_n=3)
    assert wide.columns[-3:] == ["has_sql", "has_a_b_c", "has_c++"]
    assert rows(wide, "job_id", "extracted_skills", "num_skills", "has_sql") == [
        (1, "c++;sql", 2, True), (2, "sql", 1, True), (3, "", 0, False), (4, "a b-c;ci/cd;sql", 3, True),
    ]
    stats = extraction.skill_statistics(df).first().asDict()
    assert stats == {
        "total_jobs": 4, "jobs_with_skills": 3, "avg_skills_per_job": 1.5, "median_skills_per_job": 1.5,
        "max_skills_per_job": 3, "total_unique_skills": 4,
    }


def test_categories(spark, small_lexicon):
    df = spark.createDataFrame([(1, ["sql", "python"]), (2, ["sql", "teamwork"])], "job_id int, skills array<string>")
    found = rows(extraction.skills_by_category(df, small_lexicon))
    assert (None, None, 4, 3) in found and ("Technical", None, 3, 2) in found and ("Technical", "Database", 2, 1) in found


def vectors(spark, n, seed, prefix=""):
    generator = np.random.default_rng(seed)
    data = [(f"{prefix}{i:03d}", [float(x) for x in generator.normal(size=8)]) for i in range(n)]
    return data, spark.createDataFrame(data, ("skill" if prefix else "job_id") + " string, vector array<float>")


def test_closest_skills_both_ways(spark):
    text_data, texts = vectors(spark, 60, 1)
    skill_data, skills = vectors(spark, 300, 2, "s")
    texts = texts.unionByName(spark.createDataFrame([("zero", [0.0] * 8), ("null", None)], "job_id string, vector array<float>"))
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    scores = unit(np.array([v for _, v in text_data])) @ unit(np.array([v for _, v in skill_data])).T
    expected = set()
    for i, (name, _) in enumerate(text_data):
        for rank, j in enumerate(np.argsort(-scores[i], kind="stable")[:4], start=1):
            if scores[i, j] >= 0.6:
                expected.add((name, skill_data[j][0], rank))
    for limit in (1 << 20, 0):
        near = embedding.closest_skills(texts, skills, top_k=4, threshold=0.6, broadcast_bytes=limit)
        assert set(rows(near, "job_id", "skill", "rank")) == expected
    loose = embedding.closest_skills(texts, skills, threshold=0.3).count()
    assert loose >= embedding.closest_skills(texts, skills, threshold=0.6).count() > 0


def test_union_and_attach(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b")], "job_id int, skill string")
    right = spark.createDataFrame([(1, "a"), (2, "c")], "job_id int, skill string")
    both = extraction.union_skills(left, right)
    assert rows(both) == [(1, "a"), (1, "b"), (2, "c")]
    postings = spark.createDataFrame([(1,), (2,), (3,)], "job_id int")
    assert rows(extraction.attach_skills(postings, both).select("job_id", F.array_join("skills", ";").alias("s"))) == [
        (1, "a;b"), (2, "c"), (3, ""),
    ]


def test_places_that_begin_no_phrase_stay_out_of_the_join(spark):
    lexicon = spark.createDataFrame(
        [("the art of war", "c", None, None), ("spark", "c", None, "apache spark"), ("r", "c", None, None)],
        "skill_name string, category string, subcategory string, aliases string",
    )
    texts = [(1, "the cat and the dog, the end " * 200 + "the art of war"), (2, "the art of peace"), (3, "apache spark the"), (4, None), (5, "")]
    df = spark.createDataFrame(texts, "job_id int, t string")
    keys = phrase_keys(lexicon).withColumn("prefix", F.substring_index("phrase_key", " ", 2))
    probes = rows(extraction.phrase_probes(df, keys, "t", "job_id"), "job_id", "position", "prefix")
    words = {i: (t or "").replace(",", " ,").split() for i, t in texts}
    wanted = [(i, at, p) for i, w in words.items() for at in range(len(w)) for p in (w[at], " ".join(w[at : at + 2]))
              if p in {"the art", "spark", "apache spark", "r"}]
    assert set(wanted) <= set(probes) and len(probes) <= len(wanted) + 10
    assert rows(extraction.match_phrases(df, lexicon, "t", "job_id"), "job_id", "phrase_key") == [
        (1, "the art of war"), (3, "apache spark"), (3, "spark"),
    ]


def test_places_are_unfolded_alone(spark):
    """What follows a token is read after the filter, not copied beside every token."""
    lexicon = spark.createDataFrame([("a b c", "c", None, None), ("d", "c", None, None)], "skill_name string, category string, subcategory string, aliases string")
    df = spark.createDataFrame([(1, "x a b c d a b"), (2, "a b"), (3, "a"), (4, None), (5, "c d")], "job_id int, t string")
    keys = phrase_keys(lexicon).withColumn("prefix", F.substring_index("phrase_key", " ", 2))
    probes = extraction.phrase_probes(df, keys, "t", "job_id")
    plan = probes._jdf.queryExecution().optimizedPlan().toString()
    assert "arrays_zip" not in plan and "posexplode(_words" in plan
    assert rows(probes, "job_id", "position", "prefix", "following") == [
        (1, 1, "a b", ["a", "b", "c"]), (1, 4, "d", ["d", "a", "b"]), (1, 5, "a b", ["a", "b"]), (2, 0, "a b", ["a", "b"]), (5, 1, "d", ["d"]),
    ]
    assert rows(extraction.match_phrases(df, lexicon, "t", "job_id"), "job_id", "position", "skill") == [(1, 1, "a b c"), (1, 4, "d"), (5, 1, "d")]


@pytest.mark.parametrize("most", [1 << 24, 64])
def test_key_filter_loses_no_key(spark, most):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k")).unionByName(spark.createDataFrame([(None,)], "k string"))
    held = KeyFilter(keys, "k", most)
    assert held.bits <= most
    probes = spark.range(9000).select(F.concat(F.lit("k"), "id").alias("p"), "id")
    passed = {r["id"] for r in probes.filter(held.may_hold(F.col("p"))).collect()}
    assert set(range(3000)) <= passed
    assert most == 64 or len(passed) < 3100
    nothing = KeyFilter(keys.limit(0), "k")
    assert probes.filter(nothing.may_hold(F.col("p"))).count() == 0


def test_offsets_far_into_long_texts(spark, small_lexicon):
    text = "filler, words  " * 9_000 + "SQL  Server" + " x" * 70 + " python"
    df = spark.createDataFrame([(1, text), (2, "sql")], "job_id int, t string")
    found = rows(extraction.phrase_offsets(df, small_lexicon, "t", "job_id"), "job_id", "start", "end", "skill")
    at = text.index("SQL")
    assert found == sorted([(1, at, at + 3, "sql"), (1, at, at + 11, "sql server"), (1, len(text) - 6, len(text), "python"), (2, 0, 3, "sql")],
                           key=lambda r: tuple((v is None, str(v)) for v in r))


def test_blocks_and_matrix_agree_on_ties(spark, monkeypatch):
    monkeypatch.setattr(embedding, "BLOCK_ROWS", 7)
    rng = np.random.default_rng(5)
    distinct = rng.normal(size=(6, 16))
    skills = spark.createDataFrame([(f"s{i:02d}", [float(x) for x in distinct[i % 6]]) for i in range(50)], "skill string, vector array<double>")
    texts = spark.createDataFrame(
        [(i, [float(x) for x in distinct[i % 6] + 0.1 * rng.normal(size=16)]) for i in range(90)], "job_id int, vector array<double>"
    ).repartition(5)
    both = [rows(embedding.closest_skills(texts, skills, 4, 0.3, broadcast_bytes=b), "job_id", "skill", "rank") for b in (1 << 20, 0)]
    assert both[0] == both[1] and len(both[0]) == 360
    packed = embedding.pack_vectors(texts.withColumn("n", F.col("job_id").cast("bigint")), "n", "vector", 7)
    assert packed.count() <= 90 / 7 + 5 and packed.agg(F.sum(F.size("numbers"))).first()[0] == 90
    nothing = embedding.closest_skills(texts, skills.limit(0), 4, 0.3, broadcast_bytes=-1)
    assert nothing.count() == 0


def test_only_places_where_a_phrase_may_begin_are_compared(spark):
    """A long text without a candidate is one piece, so what follows the pass over the text does not grow with its tokens."""
    keys = ["c ++", "c++", "i̇t", "mit license", "k", "οδος"]
    texts = [("plain words, no end " * 400, 1), (" C++ mitigates the MIT  LICENSE", 3), ("İt K ΟΔΟΣ", 3), ("", 0), (" ", 1), (None, None)]
    df = spark.createDataFrame(texts, "t string, n int").withColumn("p", text.pieces(F.col("t"), keys))
    for t, n, found in df.collect():
        assert t is None and found is None or (len(found) == n and "".join(found) == t)


def test_lists_and_rows_of_offsets_agree(spark, small_lexicon):
    texts = [(1, "İ C++ and sql  Server,SQL"), (1, "CI/CD. Machine\nlearning ML"), (None, "python " * 200), (4, None), (5, ""), (6, "a.b.c" * 3000 + " py")]
    df = spark.createDataFrame(texts, "job_id int, t string")
    for inline in (extraction.INLINE_PHRASES, 0):
        lists = extraction.phrase_lists(df, small_lexicon, "t", "found", inline)
        assert lists.columns == ["job_id", "t", "found"] and lists.count() == 6
        apart = rows(lists.select("job_id", F.inline_outer("found")).filter("start IS NOT NULL"))
        assert apart == rows(extraction.phrase_offsets(df, small_lexicon, "t", "job_id", inline))
        assert all(t[s:e] == part for _, t, found in lists.collect() for s, e, _, part in found)
        assert len(apart) == 4 + 1 + 1 + 2 + 200 + 1 - 1
