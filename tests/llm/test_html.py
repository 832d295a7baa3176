"""HTML extraction: the tree, the trees, the decoder, and pages whose main text is known."""

import html.parser
import itertools
import random

import duckdb
import numpy as np
import pytest

from ledgerline.llm.boosting import Trees
from ledgerline.llm.dom import NAMES, Page, tokens
from ledgerline.llm.html_extract import Extractor, Forest, decode, extract, features
from ledgerline.llm.layouts import layouts

FOLDER = "/root/testdata/sf0.001"


def all_of(source):
    page = Page(source)
    return page.prose(np.ones(len(page.name), bool)).split("\n\n")


@pytest.mark.parametrize(
    ("source", "blocks"),
    [
        ("<p>a <b>b</b>c <span class=x>d</span> e<p>f", ["a bc d e", "f"]),
        ("<ul><li>a<li>b<ul><li>c</ul>d</ul>e", ["a", "b", "c", "d", "e"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("x<!-- a <p> --->y<!doctype z><?php q ?>z<script>if (a<b) '</p>'</script>w", ["xyzw"]),
        ("<title>t</title><textarea><p>a</textarea><button>b</button>&eacute;&#233;&amp;&nbsp; &lt;p&gt;", ["éé& <p>"]),
        ("<head><meta charset=x><title>t</title><body>a<br>b<hr>c", ["a b", "c"]),
        ('<div title="a > b" class=\'c\'>d</div><a href=">">e</a>', ["d", "e"]),
        ("a < b <3 <p", ["a < b <3 <p"]),
        ("<p>a</div></b>b</p></p>c", ["a", "b", "c"]),
        ("<!-- never ends <p>a", [""]),
        ("<script>never ends <p>a", [""]),
        ("<select><option>a<option>b</select>c<svg><text>d</text></svg>e", ["c", "e"]),
        ("", [""]),
    ],
)
def test_blocks(source, blocks):
    assert all_of(source) == blocks


def test_tree_and_tokens():
    page = Page("<div class='sideBar-left x2'><p>a<p>b</div><div>c")
    assert [NAMES[k] for k in page.name] == ["#page", "div", "p", "#text", "p", "#text", "div", "#text"]
    assert page.end == [8, 6, 4, 4, 6, 6, 8, 8]
    assert tokens(page.attributes[1]) == ["side", "bar", "left", "x"]


def test_depth_and_length():
    assert all_of("<div>" * 20_000 + "a") == ["a"]
    assert all_of("<p>" + "word " * 400_000) == [" ".join(["word"] * 400_000)]
    assert len(all_of("<p class=\"" * 3000 + "<b>" * 30_000 + "x" + "</i>" * 30_000)) == 1


def test_trees_learn_what_one_split_cannot():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((4000, 6)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = Trees(rounds=40).fit(x[:3000], y[:3000])
    assert ((trees.log_odds(x[3000:]) > 0) == (y[3000:] > 0)).mean() > 0.97


def best_choice(forest, odds):
    """All choices of a small tree, one by one."""
    n = len(odds)
    worth = [any(forest.leaf[j] for j in range(k, forest.end[k])) for k in range(n)]
    found = None
    for choice in itertools.product([False, True], repeat=n):
        if any(choice[k] and not worth[k] for k in range(n)) or any(choice[k] and k and not choice[forest.parent[k]] for k in range(n)):
            continue
        if any(choice[k] and not forest.leaf[k] and not any(choice[j] for j in range(n) if forest.parent[j] == k) for k in range(n)):
            continue
        value = -sum(np.logaddexp(0, -odds[k] if choice[k] else odds[k]) for k in range(n) if worth[k])
        if found is None or value > found[0]:
            found = (value, choice)
    return found[1]


def test_decoder_finds_the_likeliest_consistent_choice():
    rng = np.random.default_rng(5)
    for source in ("<div><p>a<p>b</div><div><p>c<ul><li>d</ul></div>", "<div><div>a</div>b</div><p></p>", "a<div>b<div>c<div>d</div></div></div>", ""):
        for _ in range(12):
            forest = Forest([Page(source)])
            odds = rng.standard_normal(len(forest.name)) * 3
            assert tuple(decode(forest, odds)) == best_choice(forest, odds)


@pytest.fixture(scope="module")
def given():
    return duckdb.sql(f"select page_id, html from '{FOLDER}/pages.parquet' order by page_id").fetchall()


@pytest.fixture(scope="module")
def model(given):
    return Extractor([h for _, h in given[:30]], 1500)


def test_layouts_that_were_not_taught(model):
    rng = random.Random(1)
    words = ["".join(rng.choices("etaoinshr", k=rng.randint(2, 9))) for _ in range(500)]
    pages = layouts([" ".join(rng.choices(words, k=rng.randint(5, 90))).capitalize() + "." for _ in range(60)], 200, 99)
    forest = Forest([Page(p) for p in pages])
    kept = decode(forest, model.trees.log_odds(features(forest, model.leaning)))
    leaf = forest.leaf
    assert kept[leaf & forest.main].mean() > 0.97 and kept[leaf & ~forest.main].mean() < 0.02


TEXT = "The river rises in the northern hills and runs through three valleys before it meets the sea. Its banks were settled early."
BY_HAND = [
    (f'<body><div id="cookie-banner"><p>We use cookies to make this site better for you, please agree.</p><button>OK</button></div><div class="navbar"><a href="/">Home</a> <a href="/n">News</a></div><div class="post-content"><h1>The river</h1><p>{TEXT}</p><div class="ad-slot">Buy two pairs of shoes today</div><p>{TEXT}</p></div><div class="sidebar"><h3>Popular</h3><ul><li><a href=/1>One thing</a><li><a href=/2>Another</a></ul></div><div id="footer">&copy; The Daily</div>', ["The river", TEXT, TEXT]),
    (f'<body><header><a href="/">Site</a><nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav></header><main><article><h1>Hills</h1><p>{TEXT}<ul><li>north of the lake<li>south of it</ul></article><section class="comments"><h2>Comments</h2><div class="comment"><b>Ann</b><p>{TEXT} I was there last year and it was all quite different.</div></section></main><aside><p>Sign up for our letter, every week in your box.</p></aside><footer><p>All rights reserved by the owners of this site.</p></footer>', ["Hills", TEXT, "north of the lake", "south of it"]),
    (f"<p>{TEXT}</p><p>{TEXT}</p>", [TEXT, TEXT]),
    (f'<body><div><div><ul><li><a href=/a>One</a><li><a href=/b>Two</a><li><a href=/c>Three</a></ul></div><div><h1>The river</h1><p>{TEXT}</p><p>It is long.</p><p>{TEXT}</p></div><div><h3>More</h3><ul><li><a href=/d>Four</a><li><a href=/e>Five</a></ul></div></div></body>', ["The river", TEXT, "It is long.", TEXT]),
    (f'<body><div class="navbar"><a href=/>Home</a></div><div class="post"><h1>Hills</h1><div class="post-body"><h2>North</h2><p>{TEXT}<p>{TEXT}</div><div class="share"><a href=/f>F</a><a href=/t>T</a></div><div class="comment-list"><div class="comment"><b>Ann</b><p>{TEXT} So it was.</div></div></div><div class="footer"><p>{TEXT} All rights reserved.</div></body>', ["Hills", "North", TEXT, TEXT]),
]


@pytest.mark.parametrize("k", range(len(BY_HAND)))
def test_pages_by_hand(model, k):
    source, want = BY_HAND[k]
    assert model.texts([source])[0].split("\n\n") == want


class Article(html.parser.HTMLParser):
    """What stands in <article>, block by block."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.blocks = False, []

    def handle_starttag(self, tag, attrs):
        self.open |= tag == "article"
        if tag in ("h1", "p"):
            self.blocks.append("")
        elif tag == "br" and self.blocks:
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.open &= tag != "article"

    def handle_data(self, data):
        if self.open:
            self.blocks[-1] += data


def test_given_pages(spark, given):
    got = {r["page_id"]: r for r in extract(spark.read.parquet(f"{FOLDER}/pages.parquet"), drawn=400).collect()}
    assert len(got) == len(given)
    for k, source in given:
        parser = Article()
        parser.feed(source)
        want = "\n\n".join(filter(None, (" ".join(b.split()) for b in parser.blocks)))
        assert got[k]["text"] == want and got[k]["n_chars"] == len(want)


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars int, doc_id int"
    data = [(1, "u", None, "x", 1, 1), (2, None, "", "x", 1, 1), (None, "v", BY_HAND[2][0], None, None, None), (3, "w", "<html></html>", "", 0, 0), (4, "w", "<p>" + (TEXT + " ") * 12_000, "", 0, 0)] + [(5, "r", BY_HAND[0][0], "", 0, 0)] * 2
    got = sorted(extract(spark.createDataFrame(data, schema).repartition(2), drawn=300).collect(), key=str)
    assert all(r["n_chars"] == len(r["text"]) for r in got) and len(got) == 7
    by = {r["page_id"]: r["text"] for r in got}
    assert by[1] == by[2] == by[3] == "" and by[None] == f"{TEXT}\n\n{TEXT}" and by[4] == " ".join([TEXT] * 12_000)
    assert extract(spark.createDataFrame([], schema), drawn=100).collect() == []
