"""Main text of pages: boosted trees over a page's nodes, decoded along the tree.

Every element and every leaf of text is a node with features: how dense its subtree
is in text, links, tags and punctuation, what its attribute words and its tag are
elsewhere, its depth, its place among siblings, and the same of its ancestors.  Trees
give each node the odds that main text is under it.  A decoder then picks the likeliest choice
for the whole page in which nothing is kept under a dropped node, and no node is
kept without something kept under it.

The model learns at every run, on the driver, from a bounded sample: at most
`sample` of the given pages of at most `most_bytes`, whose paragraphs are
dealt into `drawn` layouts with known main text, and which teach themselves where one
<article> or <main> says what is main.  The tables' rows are all extracted, whole.

Defined results: a null or empty page, or one without main text, gives an empty text
and 0; white space, no-break spaces included, becomes one space; a block is what
block elements' tags part, so a cell or an item is one, and <br> is a space; comments,
scripts, styles, buttons, choices and titles never count; a missing end tag ends
with its parent; repeated rows and extra columns pass row by row; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import Trees
from .common import least_hashes
from .dom import NAMES, OTHER, Page, tokens
from .layouts import MARK, layouts

#: Bytes of pages whose nodes are scored together.
SLICE = 1 << 20
INLINE = np.array([n in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "blockquote", "pre") for n in NAMES] + [False])
PARAGRAPH, ITEM, FIELD = NAMES.index("p"), NAMES.index("li"), np.array([n in ("form", "label", "fieldset", "legend") for n in NAMES] + [False])
HEADING = np.array([len(n) == 2 and n[0] == "h" and n[1].isdigit() for n in NAMES] + [False])


class Forest:
    """Pages of one batch: their nodes one after the other."""

    def __init__(self, pages: list[Page]):
        sizes = np.array([len(p.name) for p in pages])
        start = np.cumsum(sizes) - sizes
        self.pages, self.start, self.page = pages, start, np.repeat(np.arange(len(pages)), sizes)
        shift = np.repeat(start, sizes)
        flat = lambda field: np.array([v for p in pages for v in getattr(p, field)], np.int64)
        self.name, self.depth = flat("name"), flat("depth")
        self.parent = np.where((parent := flat("parent")) < 0, -1, parent + shift)
        self.end = flat("end") + shift
        self.attributes = [v for p in pages for v in p.attributes]
        n = len(self.name)
        self.leaf = self.name == 0
        measures = np.zeros((7, n))
        self.main = np.zeros(n, bool)
        for page, lo in zip(pages, start, strict=True):
            for k, text in page.text.items():
                plain = text.strip()
                if MARK in plain:
                    self.main[lo + k] = True
                    plain = plain.replace(MARK, "")
                size = len(plain)
                stops = plain.count(".") + plain.count("!") + plain.count("?")
                measures[:, lo + k] = size, page.linked[k], plain.count(" ") + 1, stops + plain.count(","), plain[-1:] in (".", "!", "?"), size and plain[0].isupper(), plain.count("|") + plain.count("»") + plain.count("©") + plain.count("&copy;") + plain.count("&middot;")
        self.measures = measures

    def under(self, values: np.ndarray) -> np.ndarray:
        """Sums over each node's subtree, itself included."""
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[self.end] - sums[np.arange(len(self.name))]

    def below(self, start: np.ndarray, merge: np.ufunc) -> np.ndarray:
        """Each node's value merged with those of all its ancestors."""
        out = start.copy()
        order = np.argsort(self.depth, kind="stable")
        edges = np.searchsorted(self.depth[order], np.arange(1, self.depth.max(initial=0) + 2))
        for lo, hi in zip(edges, edges[1:], strict=False):
            at = order[lo:hi]
            out[at] = merge(out[at], out[self.parent[at]])
        return out


class Leaning:
    """How often main text stands under nodes with an attribute word or a tag: smoothed log odds."""

    def __init__(self, forest: Forest, main: np.ndarray, rows: np.ndarray):
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for k in np.flatnonzero(rows):
            words = set(tokens(forest.attributes[k])) if forest.attributes[k] else set()
            # the first letters stand in for words that are met later for the first time
            seen[int(main[k])].update({f"<{forest.name[k]}", *words, *{w[:4] + "*" for w in words}})
        self.odds = {w: float(np.log((seen[1][w] + 0.5) / (seen[0][w] + 0.5))) for w in seen[0].keys() | seen[1].keys() if seen[0][w] + seen[1][w] > 2}
        self.tags = np.array([self.odds.get(f"<{k}", 0.0) for k in range(OTHER + 1)])
        self.known: dict[str, tuple[float, float, float]] = {"": (0.0, 0.0, 0.0)}

    def words(self, attributes: str) -> tuple[float, float, float]:
        got = self.known.get(attributes)
        if got is None:
            odds = [v for w in tokens(attributes) if (v := self.odds.get(w, self.odds.get(w[:4] + "*"))) is not None]
            got = (sum(odds) / len(odds), min(odds), max(odds)) if odds else (0.0, 0.0, 0.0)
            if len(self.known) < 50_000:
                self.known[attributes] = got
        return got


def features(forest: Forest, leaning: Leaning) -> np.ndarray:
    """One row of measures for each node."""
    n, parent, name, page = len(forest.name), np.maximum(forest.parent, 0), forest.name, forest.page
    top = forest.parent < 0
    parent = np.where(top, np.arange(n), parent)
    chars, linked, words, marks, ended, upper, odd = (forest.under(m) for m in forest.measures)
    leaves, elements = forest.under(forest.leaf.astype(float)), forest.under((~forest.leaf).astype(float))
    paragraphs, items, fields, headings = (forest.under(v.astype(float)) for v in (name == PARAGRAPH, name == ITEM, FIELD[name], HEADING[name]))
    whole = chars[forest.start][page]
    before = np.concatenate([[0], np.cumsum(forest.measures[0])])[:-1]
    before = before - before[forest.start][page]
    # siblings stand next to each other when nodes are sorted by parent
    order = np.lexsort((np.arange(n), parent))
    order = order[~top[order]]
    fresh = np.r_[True, parent[order][1:] != parent[order][:-1]] if len(order) else np.zeros(0, bool)
    group = np.cumsum(fresh) - 1
    first = np.flatnonzero(fresh)
    many = np.diff(np.r_[first, len(order)])
    place, count, prior, later, most, alike = (np.zeros(n) for _ in range(6))
    if len(order):
        place[order] = np.arange(len(order)) - first[group]
        count[order] = many[group]
        own = chars[order]
        prior[order] = np.where(fresh, 0, np.r_[0, own[:-1]])
        later[order] = np.where(np.r_[fresh[1:], True], 0, np.r_[own[1:], 0])
        most[order] = np.maximum.reduceat(own, first)[group]
        _, which, times = np.unique(parent[order] * (OTHER + 1) + name[order], return_inverse=True, return_counts=True)
        alike[order] = times[which] / many[group]
    tag = leaning.tags[name]
    tag[forest.leaf] = 0.0
    own_words = np.array([leaning.words(a) for a in forest.attributes]).reshape(n, 3)
    least_word, most_word = forest.below(own_words[:, 1], np.minimum), forest.below(own_words[:, 2], np.maximum)
    least_tag, most_tag = forest.below(tag, np.minimum), forest.below(tag, np.maximum)
    link_share, stop_share = linked / (chars + 1), marks / (chars + 1)
    log = np.log1p
    columns = [
        log(chars), chars / (whole + 1), link_share, log(elements) - log(chars), log(leaves), log(chars / np.maximum(leaves, 1)), stop_share, log(words), ended / np.maximum(leaves, 1), upper / np.maximum(leaves, 1), odd,
        forest.depth, place, count, place / np.maximum(count, 1), chars / (chars[parent] + 1), before / (whole + 1), (before + chars) / (whole + 1), log(prior), log(later), log(most) - log(chars), alike,
        link_share[parent], log(chars[parent]), log(chars[parent] / np.maximum(leaves[parent], 1)), stop_share[parent], own_words[:, 0], own_words[:, 1], least_word, most_word, tag, tag[parent], tag[parent[parent]],
        least_tag, most_tag, own_words[parent, 0], forest.leaf, log(paragraphs), log(items), fields, log(headings), log(paragraphs[parent]), log(items[parent]), fields[parent], log(whole), INLINE[name],
    ]
    return np.column_stack(columns).astype(np.float32)


def decode(forest: Forest, odds: np.ndarray) -> np.ndarray:
    """Which nodes are kept: the likeliest choice without contradiction between ancestors and descendants."""
    n = len(odds)
    yes = -np.logaddexp(0, -odds)
    no = -np.logaddexp(0, odds)
    worth = forest.under(forest.leaf.astype(float)) > 0  # nodes without text don't count
    drop = np.where(worth, no, 0.0)
    drop = forest.under(drop)
    keep = np.where(forest.leaf, yes, -np.inf)
    parent, lead = forest.parent, np.where(worth, yes, 0.0)
    gained, best = np.zeros(n), np.full(n, -np.inf)  # over a node's children: what the better choices gain over dropping all, and the best child's gain
    for k in range(n - 1, -1, -1):
        if not worth[k]:
            continue
        if not forest.leaf[k]:
            # all children dropped, and what keeping some gains; at least one must be kept
            keep[k] = lead[k] + (drop[k] - no[k]) + (gained[k] if best[k] > 0 else best[k])
        p = parent[k]
        if p >= 0:
            gain = keep[k] - drop[k]
            if gain > 0:
                gained[p] += gain
            if gain > best[p]:
                best[p] = gain
    gain = keep - drop
    kept = np.zeros(n, bool)
    for k in range(n):
        if not worth[k]:
            continue
        p = parent[k]
        kept[k] = gain[k] > 0 if p < 0 else kept[p] and (gain[k] > 0 or best[p] <= 0 and gain[k] == best[p])
    return kept


class Extractor:
    """The learned model; sent to the tasks as it is."""

    def __init__(self, pages: list[str], drawn: int, seed: int = 7):
        own = [Page(p) for p in pages if p]
        paragraphs = [" ".join(t.split()) for p in own for t in p.text.values() if len(t) > 40]
        taught = [Page(p) for p in layouts(paragraphs, drawn, seed)]
        forest = Forest(taught + [p for p in own if _marked_by_tags(p)])
        main = forest.under(forest.main.astype(float)) > 0
        rows = forest.under(forest.leaf.astype(float)) > 0
        # what words and tags lean to is learned on the other half, as it will be met
        half = forest.page % 2 == 0
        x = np.zeros((len(main), 0))
        for side in (half, ~half):
            part = features(forest, Leaning(forest, main, rows & ~side))
            x = np.where(side[:, None], part, x) if x.size else part * side[:, None]
        self.leaning = Leaning(forest, main, rows)
        self.trees = Trees().fit(x[rows], main[rows].astype(float))

    def texts(self, pages: list[str]) -> list[str]:
        forest = Forest([Page(p) for p in pages])
        if not len(forest.name):
            return []
        kept = decode(forest, self.trees.log_odds(features(forest, self.leaning)))
        return [page.prose(kept[lo : lo + len(page.name)]) for page, lo in zip(forest.pages, forest.start, strict=True)]


def _marked_by_tags(page: Page) -> bool:
    """Marks the main text of a page that has exactly one <article> or <main>; whether it has."""
    for name in ("article", "main"):
        at = [k for k, v in enumerate(page.name) if v == NAMES.index(name)]
        if len(at) == 1:
            for k in range(at[0], page.end[at[0]]):
                if k in page.text:
                    page.text[k] = MARK + page.text[k]
            return True
    return False


def extract(pages: DataFrame, sample: int = 300, drawn: int = 1500, most_bytes: int = 1 << 16) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages."""
    whole = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    teach = whole.where(F.octet_length("html") <= most_bytes).select(F.col("page_id").alias("doc_id"), "html")
    shared = pages.sparkSession.sparkContext.broadcast(Extractor(sorted(r["html"] for r in least_hashes(teach, sample, "html").collect()), drawn))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            source, texts, some, size = batch.column("html"), [], [], 0
            for k in range(len(source)):
                some.append(source[k].as_py())
                size += len(some[-1])
                if size > SLICE or k + 1 == len(source):
                    texts += model.texts(some)
                    some, size = [], 0
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return whole.mapInArrow(run, "page_id long, url string, text string, n_chars long")
