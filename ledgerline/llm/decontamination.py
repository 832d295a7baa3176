"""Benchmark decontamination: a BM25 index of test items, searched by block maxima.

Test items are indexed, training passages are the queries.  Term weights are
BM25 impacts divided by the item's score for its own text, so 1 means that all of
an item's weight is in the passage.  Items lie in blocks; each term has its
greatest weight in each block.  A passage whose sum of block maxima is under the
threshold can't hold an item of that block (the bound of block-max WAND), and
only the other blocks are scored; every item at or above the threshold is kept.
A block is looked at only if it has an essential term of the passage: with the
passage's terms in order of their greatest weight anywhere, those after the longest
prefix that can't reach the threshold alone.  All passages of a batch go at once.

A candidate counts when the item's question and its answer both overlap the
passage.  A part's overlap is the share of its weight (each word weighs its idf) that
stands in order in a stretch of the passage at most a quarter longer than the
part, and two words.  Either both parts have `overlap`, where from `FORGIVE` words on
a part may lack one word of any weight; or both have half, and together they
have `overlap` of the item's weight.  So an edit costs the words it touches, and several
may fall into one part.  The answer is an item's last sentence, or the second half of its words if it has one
sentence.  ASCII punctuation at a word's ends is no part of the word.

Equal texts are one item of the index.  A pass over the documents holds at most
about `pass_items` items and `pass_words` words, which bounds what is broadcast;
more take more passes.  Passages are as long as the longest item of a pass asks, so
items over `item_words` words are searched apart from others, by powers of two of
their length.

Defined results: null and empty texts and items match nothing; only space and
0x09-0x0D part words; an item id that repeats counts as several texts of one item; a null item id is an id of its own;
extra columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import documents, written

SCHEMA = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
FOUND = SCHEMA.replace("item_id", "text_key")
BLOCK = 8
FORGIVE = 4
HALF = 0.5
K1, B = 1.2, 0.75


def split_item(text: str) -> tuple[list[bytes], list[bytes]]:
    """Lower-cased words of the question and of the answer."""
    sentences = [s for s in re.split(r"(?<=[.?!])[\x20\x09-\x0D]+", text.strip(" \t\n\v\f\r")) if s]
    parts = [" ".join(sentences[:-1]).encode().lower().split(), sentences[-1].encode().lower().split()] if len(sentences) > 1 else []
    if len(parts) == 2 and min(map(len, parts)) >= 3:
        return parts[0], parts[1]
    words = text.encode().lower().split()
    half = (len(words) + 1) // 2
    return words[:half], words[half:]


def word_hashes(words: list[bytes]) -> np.ndarray:
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    return K.span_hashes(np.frombuffer(b"".join(words), np.uint8), np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends, ends)


def stripped(words: list[bytes]) -> list[bytes]:
    """The words without punctuation at their ends; those of punctuation only are left out."""
    return [w for w in (w.strip(_PUNCTUATION) for w in words) if w]


def strip_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for spans of a buffer."""
    starts, ends = starts.copy(), ends.copy()
    for edge, shift, step in ((starts, 0, 1), (ends, -1, -1)):
        at = np.arange(len(starts))
        while len(at):
            at = at[starts[at] < ends[at]]
            at = at[_IS_PUNCTUATION[buf[edge[at] + shift]]]
            edge[at] += step
    live = starts < ends
    return starts[live], ends[live], rows[live]


def stretch(n: int) -> int:
    """Words of a passage in which a part of n words is looked for."""
    return n + n // 4 + 2


def in_order(part: np.ndarray, weights: np.ndarray, words: np.ndarray, least: float) -> float:
    """Greatest weight of the part's words that stand in order in one stretch of `words`; 0 if under `least`.

    Stretches are tried by the weight of all their words that the part has, a
    bound, until no bound left exceeds what was found.
    """
    size = stretch(len(part))
    of = dict(zip(part.tolist(), weights.tolist(), strict=True))
    own = np.array([of.get(w, 0.0) for w in words.tolist()])
    starts = np.flatnonzero(own)
    total = np.concatenate([[0.0], np.cumsum(own)])
    bounds = np.minimum(total[np.minimum(starts + size, len(words))] - total[starts], weights.sum())
    best = 0.0
    for k in np.argsort(-bounds, kind="stable"):
        if bounds[k] <= best or bounds[k] < least - 1e-9:
            break
        piece = words[starts[k] : starts[k] + size]
        piece = piece[own[starts[k] : starts[k] + size] > 0]
        row = np.zeros(len(piece) + 1)
        for word, weight in zip(part, weights, strict=True):
            row[1:] = np.maximum(row[1:], np.where(piece == word, row[:-1] + weight, 0.0))
            np.maximum.accumulate(row, out=row)
        best = max(best, float(row[-1]))
    return best if best >= least - 1e-9 else 0.0


_PUNCTUATION = string.punctuation.encode()
_IS_PUNCTUATION = np.isin(np.arange(256), list(_PUNCTUATION))


class Index:
    """Impacts of one pass's items, with block maxima."""

    def __init__(self, items: list[tuple[int, list[bytes], list[bytes]]], n: int, mean: float, frequency: dict[bytes, int]):
        self.ids = [i for i, _, _ in items]
        self.longest = max(len(q) + len(a) for _, q, a in items)
        terms = sorted({w for _, q, a in items for w in q + a})
        hashes = word_hashes(terms)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        place = {terms[o]: i for i, o in enumerate(order)}
        idf = {w: float(np.log(1 + (n - frequency[w] + 0.5) / (frequency[w] + 0.5))) for w in terms}
        rows, cols, values = [], [], []
        for k, (_, q, a) in enumerate(items):
            words = q + a
            counts = {w: words.count(w) for w in words}
            impact = {}
            for w, tf in counts.items():
                impact[w] = idf[w] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean))
            total = sum(impact.values())
            rows += [place[w] for w in impact]
            cols += [k] * len(impact)
            values += [v / total for v in impact.values()]
        self.terms, self.items, self.weights = np.array(rows), np.array(cols), np.array(values, np.float32)
        blocks = (len(items) + BLOCK - 1) // BLOCK
        self.edges = np.searchsorted(self.items // BLOCK, np.arange(blocks + 1))
        # postings: for each term its blocks, in order, with the greatest weight in each
        self.cells, at = np.unique(self.terms.astype(np.int64) * blocks + self.items // BLOCK, return_inverse=True)
        self.most = np.zeros(len(self.cells), np.float32)
        np.maximum.at(self.most, at, self.weights)
        self.blocks, self.first = blocks, np.searchsorted(self.cells, np.arange(len(terms) + 1) * blocks)
        self.anywhere = np.maximum.reduceat(self.most, self.first[:-1])
        self.parts = [tuple((word_hashes(p), np.array([idf[w] for w in p])) for p in (q, a)) for _, q, a in items]

    def shares(self, item: int, words: np.ndarray, overlap: float) -> list[float] | None:
        """Shares of the question's and the answer's weight in order in the words; None if too little of either or of both."""
        out, sums, strict = [], [], True
        for part, weights in self.parts[item]:
            total = float(weights.sum())
            forgiven = total - float(weights.max()) if len(part) >= FORGIVE else total
            found = in_order(part, weights, words, min(HALF * total, overlap * total, forgiven)) if len(part) else 0.0
            if len(part) and not found:
                return None
            strict &= found >= min(overlap * total, forgiven) - 1e-9
            out.append(min(1.0, found / total) if total else 1.0)
            sums.append((found, total))
        together = sum(f for f, _ in sums) >= overlap * sum(t for _, t in sums) - 1e-9
        return out if strict or together else None

    def bounds(self, passage: np.ndarray, term: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of passage and block whose block maxima reach the threshold; (passage, term) are distinct and in order."""
        order = np.lexsort((self.anywhere[term], passage))
        p, t = passage[order], term[order]
        so_far = np.cumsum(self.anywhere[t], dtype=np.float64)
        head = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
        size = np.diff(np.append(head, len(p)))
        so_far -= np.repeat(so_far[head] - self.anywhere[t[head]], size)
        low = so_far < threshold - 1e-4  # terms that can't reach the threshold, all together
        rest = np.maximum.reduceat(np.where(low, so_far, 0.0), head)  # what they can add
        of, t_high = np.repeat(np.arange(len(head)), size)[~low], t[~low]
        count = self.first[t_high + 1] - self.first[t_high]
        cell = np.repeat(self.first[t_high] - np.cumsum(count) + count, count) + np.arange(count.sum())
        found, at = np.unique(np.repeat(of, count) * np.int64(self.blocks) + self.cells[cell] % self.blocks, return_inverse=True)
        total = np.bincount(at, weights=self.most[cell], minlength=len(found))
        live = total + rest[found // self.blocks] >= threshold - 1e-4
        found, total = found[live], total[live]
        own, block = found // self.blocks, found % self.blocks
        n_low = np.add.reduceat(low.astype(np.int64), head)[own]  # the low terms come first
        pair = np.repeat(np.arange(len(found)), n_low)
        step = np.arange(len(pair)) - np.repeat(np.cumsum(n_low) - n_low, n_low)
        wanted = t[head[own[pair]] + step] * np.int64(self.blocks) + block[pair]
        place = np.minimum(np.searchsorted(self.cells, wanted), len(self.cells) - 1)
        total += np.bincount(pair, weights=np.where(self.cells[place] == wanted, self.most[place], 0.0), minlength=len(found))
        live = total >= threshold - 1e-4
        return p[head[own[live]]], block[live]

    def search(self, hashes: np.ndarray, rows: np.ndarray, n: int, threshold: float, overlap: float) -> list[tuple[int, int, float, float, float]]:
        """(row, item, score, question overlap, answer overlap) of the passages of n rows of words."""
        out: list[tuple[int, int, float, float, float]] = []
        if not len(hashes):
            return out
        first = np.searchsorted(rows, np.arange(n))
        stride = stretch(self.longest)
        local = np.arange(len(rows)) - first[rows]
        count = np.bincount(rows, minlength=n)
        passages = np.maximum((count + stride - 1) // stride - 1, 1)  # each of two strides, the last may be longer by what is left
        base = np.concatenate([[0], np.cumsum(passages)])
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == hashes)
        step, row, term = local[hit] // stride, rows[hit], at[hit]
        a = base[row] + np.minimum(step, passages[row] - 1)  # the passage that starts with this stride
        b = base[row] + np.maximum(np.minimum(step, passages[row]) - 1, 0)  # the one before
        size = np.int64(len(self.hashes))
        pairs = np.unique(np.concatenate([a, b]) * size + np.concatenate([term, term]))
        passage, term = pairs // size, pairs % size
        if not len(pairs):
            return out
        heads = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
        tails = np.append(heads[1:], len(pairs))
        load = np.cumsum(np.add.reduceat(self.first[term + 1] - self.first[term], heads))
        lo = 0
        while lo < len(heads):
            hi = max(lo + 1, int(np.searchsorted(load, (load[lo - 1] if lo else 0) + (1 << 20), "right")))
            part = slice(heads[lo], tails[hi - 1])
            for p, block in zip(*self.bounds(passage[part], term[part], threshold), strict=True):
                of = lo + int(np.searchsorted(passage[heads[lo:hi]], p))
                own = slice(self.edges[block], self.edges[block + 1])
                present = np.isin(self.terms[own], term[heads[of] : tails[of]])
                scores = np.bincount(self.items[own][present] - block * BLOCK, weights=self.weights[own][present], minlength=BLOCK)
                r = int(np.searchsorted(base, p, "right") - 1)  # every row has a passage at least
                k0 = int(p - base[r])
                end = count[r] if k0 == passages[r] - 1 else min((k0 + 2) * stride, count[r])
                words = hashes[first[r] + k0 * stride : first[r] + end]
                for k in np.flatnonzero(scores >= threshold):
                    item = int(block * BLOCK + k)
                    shares = self.shares(item, words, overlap)
                    if shares:
                        out.append((r, item, float(scores[k]), *shares))
            lo = hi
        return out


PARTS = "text_key long, question array<binary>, answer array<binary>"


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = [tuple(map(stripped, split_item(t))) for t in batch.column("text").to_pylist()]
        columns = [pa.array([x[k] for x in both], pa.list_(pa.binary())) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([batch.column("text_key"), *columns], ["text_key", "question", "answer"])


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.7, overlap: float = 0.8, pass_items: int = 20_000, pass_words: int = 2_000_000, item_words: int = 256) -> DataFrame:
    """One row for each document and test item that it holds, with score and overlaps."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    keyed = items.select("item_id", F.xxhash64("text").alias("text_key"), "text")
    parts = keyed.groupBy("text_key").agg(F.first("text").alias("text")).mapInArrow(_parts, PARTS)
    parts = parts.withColumn("n", F.size("question") + F.size("answer")).where("n > 0")
    parts = written(parts.withColumn("level", F.when(F.col("n") > item_words, F.ceil(F.log2(F.col("n") / item_words))).otherwise(0).cast("int")), "item-parts")
    terms = parts.select("text_key", F.explode(F.array_distinct(F.concat("question", "answer"))).alias("term"))
    frequency = written(terms.groupBy("term").count(), "item-terms")
    n, mean = parts.agg(F.count("*"), F.avg("n")).first()
    found = None
    for level in parts.groupBy("level").agg(F.count("*").alias("items"), F.sum("n").alias("words")).orderBy("level").collect():
        passes = max(-(-level["items"] // pass_items), -(-level["words"] // pass_words))
        for k in range(passes):
            own = parts.where((F.col("level") == level["level"]) & (F.pmod(F.hash("text_key"), F.lit(passes)) == k))
            index = build_index(own, frequency, n, mean)
            if index is not None:
                part = _search(docs, index, threshold, overlap)
                found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    best = [F.max(c).alias(c) for c in ("score", "question_overlap", "answer_overlap")]
    return found.join(keyed.select("item_id", "text_key").distinct(), "text_key").groupBy("doc_id", "item_id").agg(*best)


def build_index(own: DataFrame, frequency: DataFrame, n: int, mean: float) -> Index | None:
    """The index of one pass's items."""
    texts = [(r["text_key"], [bytes(w) for w in r["question"]], [bytes(w) for w in r["answer"]]) for r in own.orderBy("text_key").collect()]
    if not texts:
        return None
    terms = own.select(F.explode(F.array_distinct(F.concat("question", "answer"))).alias("term")).distinct()
    return Index(texts, n, mean, {bytes(r["term"]): r["count"] for r in frequency.join(terms, "term").collect()})


def _search(docs: DataFrame, index: Index, threshold: float, overlap: float) -> DataFrame:
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(index)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            ids, out = batch.column("doc_id"), []
            buf, at = K.text_column(batch.column("text"))
            for lo, hi, b, a in K.slices(buf, at):
                low = K.LOWER[b]
                starts, ends, rows = strip_spans(low, *K.word_spans(low, a))
                for r, item, *numbers in index.search(K.span_hashes(low, starts, ends), rows, hi - lo, threshold, overlap):
                    out.append((ids[lo + r].as_py(), index.ids[item], *numbers))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], FOUND.replace(",", "").split()[::2])

    return documents(docs).mapInArrow(found, FOUND)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no test item, with all their columns."""
    hits = contaminated(docs, benchmark, **options).select(F.col("doc_id").alias("_hit")).distinct()
    return docs.join(hits, F.col("doc_id").cast("long").eqNullSafe(F.col("_hit")), "left_anti")
