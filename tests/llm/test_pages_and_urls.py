from html.parser import HTMLParser

from pathlib import Path

import duckdb
import numpy as np
import pytest

import check_oracle
import __spark_entry__ as entry
from jobgrain.llm import html_text, url_lists

DATA = Path("/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not DATA.exists(), reason="driver tables are not here")
PAGE = (
    "<html><head><title>T</title><script>var t='</p>';</script></head><body><nav><ul><li><a href='/a'>Menu one</a><li>two</ul></nav>"
    "<!-- x --><div class=\"ad\">Buy</div><article><h1>Head &amp; more</h1><p><b>First\n  text.<br>second&nbsp;x<p title='a>b'>Third.</article>"
    "<div class='comments'><p>I agree.</p></div><form><label>Mail</label></form><footer>&copy; all</footer>"
)
TEXT = "Head & more First text. second x Third."


def test_leaves_and_rule():
    blocks = html_text.leaves(PAGE)
    assert [b.text for b in blocks] == ["T", "Menu one", "two", "Buy", "Head & more", "First text.", "second x", "Third.", "I agree.", "Mail", "© all"]
    assert " ".join(b.text for b in blocks if html_text.rule_label(b)) == TEXT
    assert blocks[1].linked == len("Menu one")


@pytest.mark.parametrize("page", ["", "<", "<p", "<a<a<a", "a < b", "<script>x", "<!-- x", "<p title='x>y", "<div>" * 3000 + "x", "</p></x>", "\x00&#xD800;"])
def test_broken_markup(page):
    html_text.leaves(page)


@pytest.mark.parametrize(("page", "texts"), [
    ('<p class=intro">First.</p><p>Second.</p><p class=x">Third.', ["First.", "Second.", "Third."]),
    ("<p data-name=O'Brien>One.</p><p>Two.</p><p>Three isn't here.", ["One.", "Two.", "Three isn't here."]),
    ("<p title = 'a>b' class=\"c>d\">One.</p>", ["One."]), ("<p title=a=\"b>c\">One.</p>", ["One."]),
    ("<p title='x>One. <b>two</b></p><p>Three.", ["One. two", "Three."]), ("<p x=>One.</p><p x= >Two.", ["One.", "Two."]),
    ("<p \"quoted\" 'words'>One.</p>", ["One."]), ("<a href=x?a='1'>One</a> <p>Two.", ["One", "Two."]),
])
def test_quotes_open_values_after_equals_signs_only(page, texts):
    assert [b.text for b in html_text.leaves(page)] == texts


class Blocks(HTMLParser):
    """Texts between block tags by the standard library's parser."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.texts, self.parts, self.skipped = [], [], 0
        self.feed(page)
        self.close()
        self.flush()

    def flush(self):
        text = " ".join("".join(self.parts).split())
        self.texts += [text] * bool(text)
        self.parts = []

    def handle_starttag(self, tag, attrs):
        self.skipped += tag in html_text.RAW | html_text.HIDDEN
        if tag in html_text.BLOCK and not self.skipped:
            self.flush()

    def handle_endtag(self, tag):
        self.skipped -= tag in html_text.RAW | html_text.HIDDEN
        if tag in html_text.BLOCK and not self.skipped:
            self.flush()

    def handle_data(self, data):
        if not self.skipped:
            self.parts.append(data)


@needs_data
def test_leaves_against_the_standard_parser(spark):
    for row in spark.read.parquet(f"{DATA}/pages.parquet").select("html").collect():
        assert [b.text for b in html_text.leaves(row.html or "")] == Blocks(row.html or "").texts


def test_whole_words_are_hashed():
    one, two = (html_text.features(html_text.leaves("<p>" + "x" * 40 + end)) for end in "ab")
    assert (one != two).any()


@pytest.fixture(scope="module")
def labellers():
    """The markup rule, and a network fitted on it."""
    return None, html_text.fit([html_text.leaves(PAGE.replace("First", f"First{i}")) for i in range(12)])


@pytest.mark.parametrize("depth", [1, 30, 300])
@pytest.mark.parametrize("wrap", ["<div>", "<b>", "<div class='row c{0}' id='e-{0}'>"])
def test_containers_far_above_their_text(labellers, depth, wrap):
    deep = "".join(wrap.format(i) for i in range(depth))
    pages = [PAGE.replace("<article>", f"<article>{deep}"), PAGE.replace("</article>", f"<div class='comments'>{deep}<p>I agree.</p></article>")]
    for net in labellers:
        assert html_text.main_text(net, pages) == [TEXT, TEXT]


@pytest.mark.parametrize("told", ["id='sidebar'", "role=banner", "class='{0} comments'"])
def test_all_words_of_a_tag_count(labellers, told):
    grid = "col-xs-12 col-sm-4 col-md-4 col-lg-4"
    tag = f"<div {told.format(grid)}>" if "{0}" in told else f"<div class='{grid}' {told}>"
    page = PAGE.replace("</article>", f"{tag}<p>I agree.</div></article>")
    for net in labellers:
        assert html_text.main_text(net, [page]) == [TEXT]
    article = PAGE.replace("<article>", f"<div class='{grid}' role='article'>").replace("</article>", "</div>")
    assert html_text.main_text(None, [article]) == [TEXT]


@pytest.mark.parametrize(
    "inner, want",
    [
        ("<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.", "So x=2 holds."), ("<object data='a'>No player.</object>", "No player."),
        ("<canvas>A chart.</canvas><noscript><p>A picture.</noscript>", "A chart. A picture."), ("<p>a<math>b</p><p>c", "ab c"),
        ("<p>E<svg><title>Icon</title><text>no</text></svg>mc.<template><p>not<div>this</div></template>", "Emc."),
        ("<div><svg><path></div><p>Next.", "Next."), ("<div><template><p>no</div><p>Next.", "Next."), ("<svg><svg></svg>no</svg>yes", "yes"),
        ("<svg><style></svg></style><p>no</p></svg>yes", "yes"), ("<iframe><p>no</iframe>yes<script>no", "yes"),
    ],
)
def test_only_what_is_not_shown_is_skipped(inner, want):
    assert html_text.main_text(None, [f"<html><body><nav>Menu</nav><article>{inner}</article>"]) == [want]


def test_gradients_are_right():
    pages = [html_text.leaves(PAGE), html_text.leaves(PAGE)[:5]]
    told = [(p, [html_text.rule_label(x) for x in p]) for p in pages]
    rng, u = np.random.default_rng(1), html_text.UNITS
    net = html_text.Labeller(
        rng.normal(0, 0.2, (2, html_text.INPUTS, 4 * u)), rng.normal(0, 0.2, (2, u, 4 * u)), rng.normal(0, 0.2, (2, 4 * u)), rng.normal(0, 0.3, 2 * u), np.zeros(1)
    )

    def loss(weights):
        found = zip(html_text.scores(html_text.Labeller(*weights), pages), told)
        return -np.concatenate([np.where(y, np.log(s), np.log(1 - s)) for s, (_, y) in found]).mean()

    gradients = html_text._gradients(net, told)
    for k in range(5):
        at = np.unravel_index(np.abs(gradients[k]).argmax(), gradients[k].shape)
        up, down = [p.copy() for p in net], [p.copy() for p in net]
        up[k][at] += 1e-2
        down[k][at] -= 1e-2
        assert gradients[k][at] == pytest.approx((loss(up) - loss(down)) / 2e-2, rel=2e-2)


def test_extract_odd_pages(spark):
    rows = [(i, "u", PAGE.replace("First", f"First{i}")) for i in range(12)] + [(20, None, None), (21, "u", ""), (None, "u", "<p>"), (3, "u", PAGE.replace("First", "First3"))]
    pages = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, n_chars int, text string")
    got = html_text.extract(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_chars == len(r.text)
        assert r.text == (TEXT.replace("First", f"First{r.page_id}") if r.page_id is not None and r.page_id < 12 else "")
    assert html_text.extract(pages.limit(0)).count() == 0


@needs_data
def test_held_out_pages_agree_with_the_markup():
    rows = [r[0] for r in duckdb.sql(f"SELECT html FROM '{DATA}/pages.parquet' ORDER BY page_id").fetchall()]
    net = html_text.fit([html_text.leaves(x) for x in rows[::2]])
    by_rule = html_text.main_text(None, rows[1::2])
    assert np.mean([a == b for a, b in zip(html_text.main_text(net, rows[1::2]), by_rule)]) >= 0.99
    renamed = [x.replace("<article>", "<div class='content'>").replace("</article>", "</div>") for x in rows[1::2]]
    assert np.mean([a == b for a, b in zip(html_text.main_text(net, renamed), by_rule)]) >= 0.9


def test_lists_hold_when_they_hold(spark):
    entries = spark.createDataFrame(
        [
            ("2024-01-10", "add", "spam", "host", "a.com"), ("2024-01-12", "add", "spam", "host", "a.com"), ("2024-01-20", "remove", "spam", "host", "a.com"),
            ("2024-01-25", "add", "spam", "host", "a.com"), ("2024-01-25", "remove", "spam", "host", "a.com"),
            ("2024-01-05", "add", "adult", "domain", "b.org"), ("2024-01-05", "add", "ads", "prefix", "c.net/x/y"),
            (None, "add", "spam", "host", "z"), ("2024-01-01", "add", None, "host", "z"),
        ],
        "date string, action string, list string, kind string, value string",
    ).selectExpr("cast(date as date) date", "action", "list", "kind", "value")
    rows = [
        (1, "http://a.com/p", "2024-01-09", ""), (2, "http://u@A.com.:80/p", "2024-01-10", "spam"), (3, "http://a.com", "2024-01-20", ""),
        (4, "http://a.com", "2024-02-01", ""), (5, "https://sub.b.org/q?x", "2024-01-05", "adult"), (6, "http://xb.org/", "2024-01-06", ""),
        (7, "http://c.net//x/y/z", "2024-01-06", "ads"), (8, "http://c.net/x/yz", "2024-01-06", ""), (9, None, "2024-01-06", ""),
        (10, "no url", "2024-01-06", ""), (11, "http://a.com", None, ""), (None, "http://a.com", "2024-01-15", "spam"), (None, "http://a.com", "2024-01-15", "spam"),
        (12, "http://" + "a." * 50_000 + "b.org/", "2024-01-06", "adult"), (13, "http://h/" + "s/" * 50_000, "2024-01-06", ""),
    ]
    captures = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, fetched string, want string, list string").selectExpr(
        "page_id", "url", "cast(fetched as date) fetched", "want", "list"
    )
    got = sorted(((r.page_id, r.url, r.lists, r.blocked) for r in url_lists.judge(captures, entries).collect()), key=str)
    assert got == sorted(((i, u, w, w != "") for i, u, _, w in rows), key=str)
    assert url_lists.judge(captures.limit(0), entries).count() == 0
    assert url_lists.judge(captures, entries.limit(0)).filter("blocked").count() == 0


@needs_data
@pytest.mark.parametrize("name", ["op3_url_lists", "op9_secret_scan", "op10_exact_dedup"])
def test_queries_against_sql(spark, name):
    connection = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    good, note = check_oracle.compare(spark, connection, str(DATA), name, entry.oracle_sql())
    assert good, note
