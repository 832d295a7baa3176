"""Suffix-array dedup over bytes: a hash-compared suffix sort of what may repeat.

Bytes around grams that occur in different surroundings are sorted.  Equal
surroundings, by two 64-bit hashes, are repeats as they are, once the bytes of the
later place equal those of an earlier one: touching places that repeat touching places
are one stretch, and its earlier bytes travel once.  Suffixes at one offset from
one gram are put in order by a mergesort.  Two suffixes are compared by prefix polynomial
hashes: a binary search finds their common extension, and the next byte decides.
Neighbours that agree over a whole window are compared byte by byte against
collisions; the first by (doc_id, start) stays.

A gram with more than `group_rows` different surroundings isn't sorted in one
task: its windows meet by two 64-bit hashes in a grouped minimum instead, and are
held against the first's bytes in the same way.  So no byte goes by hashes alone.

Defined results: null and empty texts have no bytes; texts under 100 bytes lose
nothing; cuts may fall inside a character, as texts are bytes here; rows that
repeat an id and its text count as one document, different texts of one id are
documents of their own, and those without an id come before all others, by a hash
of their texts; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats as R
from .common import written

UNITS = R.Units("bytes", 100, 24)
CONTEXTS = "gram long, doc_id long, at long, context binary"
RANGES = "doc_id long, first long, last long"


class Suffixes:
    """Order of suffixes of a buffer by their first `window` bytes."""

    def __init__(self, buf: np.ndarray, window: int):
        self.buf, self.window = buf, window
        self.total, self.down = R.prefix(UNITS.values(buf, np.array([0, len(buf)]))[0])

    def extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common prefix of each pair, by binary search over hashes."""
        low, high = np.zeros(len(x), np.int64), np.full(len(x), self.window, np.int64)
        total, fx, fy = self.total, self.down[x], self.down[y]
        tx, ty = total[x], total[y]
        for _ in range(self.window.bit_length()):
            middle = (low + high + 1) >> 1
            same = (total[x + middle] - tx) * fx == (total[y + middle] - ty) * fy
            low = np.where(same, middle, low)
            high = np.where(same, high, middle - 1)
        return low

    def before(self, x: np.ndarray, y: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Whether x stands before y; `ties` says so for equal ones."""
        n = self.extension(x, y)
        full = n >= self.window
        step = np.where(full, 0, n)
        return np.where(full, ties, self.buf[x + step] < self.buf[y + step])

    def sort(self, at: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Stable mergesort of suffixes within segments; segments are consecutive."""
        n = len(at)
        order = np.arange(n)
        head = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]])) if n else order
        size = np.diff(np.append(head, n))
        first, size = np.repeat(head, size), np.repeat(size, size)
        local, slot = np.arange(n) - first, np.arange(n)
        width = 1
        while n and width < size.max():
            run = local // width
            other = (run ^ 1) * width
            low = np.zeros(n, np.int64)
            high = np.clip(size - other, 0, width)
            left = run % 2 == 0
            while len(live := np.flatnonzero(low < high)):
                middle = (low[live] + high[live]) >> 1
                mine, theirs = at[order[live]], at[order[first[live] + other[live] + middle]]
                # on ties a suffix of the left run stands before those of the right run
                past = self.before(theirs, mine, ~left[live])
                low[live] = np.where(past, middle + 1, low[live])
                high[live] = np.where(past, high[live], middle)
            place = first + (run & ~1) * width + (local - run * width) + low
            merged = np.empty_like(order)
            merged[place] = order[slot]
            order = merged
            width *= 2
        return order

    def equal_bytes(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Byte comparison of whole windows."""
        span = np.arange(self.window)
        out = np.empty(len(x), bool)
        for lo in range(0, len(x), 1 << 15):
            a, b = x[lo : lo + (1 << 15)], y[lo : lo + (1 << 15)]
            out[lo : lo + (1 << 15)] = (self.buf[a[:, None] + span] == self.buf[b[:, None] + span]).all(1)
        return out


def later_ranges(gram: np.ndarray, doc: np.ndarray, at: np.ndarray, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(doc, first, last) of windows that stand earlier; rows are in order of (gram, doc, at)."""
    start, left, count = R.unpack(at)
    row = np.repeat(np.arange(len(gram)), count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    offset = left[row] - step  # of the gram in the window
    group = np.cumsum(np.concatenate([[0], gram[1:] != gram[:-1]]))
    key = group[row] * 256 + offset
    order = np.argsort(key, kind="stable")
    key = key[order]
    twin = np.zeros(len(key), bool)
    twin[1:] |= key[1:] == key[:-1]
    twin[:-1] |= key[1:] == key[:-1]
    order, key = order[twin], key[twin]
    row, step = row[order], step[order]
    suffixes = Suffixes(buf, UNITS.window)
    place = offsets[row] + step
    ranked = suffixes.sort(place, key)
    same = np.zeros(len(ranked), bool)
    if len(ranked) > 1:
        x, y = ranked[:-1], ranked[1:]
        maybe = np.flatnonzero((key[x] == key[y]))
        maybe = maybe[suffixes.extension(place[x[maybe]], place[y[maybe]]) >= UNITS.window]
        same[maybe[suffixes.equal_bytes(place[x[maybe]], place[y[maybe]])] + 1] = True
    lead = ranked[np.maximum.accumulate(np.where(same, 0, np.arange(len(ranked))))] if len(ranked) else ranked
    own_doc, own_start = doc[row], start[row] + step
    later = ranked[same & ((own_doc[lead] != own_doc[ranked]) | (own_start[lead] != own_start[ranked]))]
    return R.ranges(own_doc[later], own_start[later], own_start[later])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_numpy()
        for i, text in enumerate(batch.column("text")):
            raw, wanted = (text.as_py() or "").encode(), batch.column("wanted")[i].values
            at = wanted.field("at").to_numpy()
            start, _, count = R.unpack(at & R.LOCAL)
            end = start + count - 1 + UNITS.window
            pieces = [raw[s:e] for s, e in zip(start.tolist(), end.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([wanted.field("gram"), pa.array(np.repeat(ids[i], len(at))), pa.array(at), pa.array(pieces, pa.binary())], ["gram", "doc_id", "at", "context"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows in order of gram: whole groups at a time; the last group waits for its rest."""
    held = None

    def give(rows: pa.RecordBatch) -> pa.RecordBatch:
        buf, offsets = np.frombuffer(rows.column("context").buffers()[2], np.uint8), np.frombuffer(rows.column("context").buffers()[1], np.int32)
        offsets = offsets[rows.column("context").offset :][: rows.num_rows + 1].astype(np.int64)
        columns = later_ranges(*(rows.column(c).to_numpy() for c in ("gram", "doc_id", "at")), buf[offsets[0] : offsets[-1]], offsets - offsets[0])
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "first", "last"])

    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.concat_batches([held, batch])
        gram = batch.column("gram").to_numpy()
        cut = int(np.searchsorted(gram, gram[-1]))
        held = batch.slice(cut)
        for lo in _cuts(gram[:cut], 4000):
            yield give(batch.slice(*lo))
    if held is not None:
        yield give(held)


def _cuts(gram: np.ndarray, rows: int) -> Iterator[tuple[int, int]]:
    """(start, length) of runs of whole groups with about so many rows."""
    lo = 0
    while lo < len(gram):
        hi = min(lo + rows, len(gram))
        hi = int(np.searchsorted(gram, gram[hi - 1], "right"))
        yield lo, hi - lo
        lo = hi


def _digest(text: bytes, gone) -> tuple[int, int, int, str]:
    if gone is None:
        return len(text), 0, 0, hashlib.sha256(text).hexdigest()
    mask = R.removed_units(gone, UNITS.window, len(text))
    spans = int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum())
    return len(text), int(mask.sum()), spans, hashlib.sha256(np.frombuffer(text, np.uint8)[~mask].tobytes()).hexdigest()


def suffix_dedup(docs: DataFrame, group_rows: int = 5000) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document row."""
    texts = R.numbered(docs)
    places = written(R.meet(R.anchor_rows(texts, UNITS)), "places")
    links = R.as_links(places.where(F.col("kind") == R.LATER))
    firsts = places.where(F.col("kind") == R.FIRST).select("gram", "doc_id", "at")
    crowded = written(firsts.groupBy("gram").count().where(F.col("count") > group_rows).select("gram"), "crowded-grams")
    usual = R.surroundings(texts, firsts.join(crowded, "gram", "left_anti"), _contexts, CONTEXTS)
    sorted_ = usual.repartition("gram").sortWithinPartitions("gram", "doc_id", "at").mapInArrow(_compared, RANGES)
    if crowded.limit(1).count():
        windows = R.surroundings(texts, firsts.join(crowded, "gram", "left_semi"), R.window_rows(UNITS), R.WINDOWS)
        single = R.later_windows(windows)
        links = links.unionByName(single.select("doc_id", F.col("start").alias("first"), F.col("start").alias("last"), "lead", F.col("lead_start").alias("lead_first")))
    gone = R.proven(links, texts, UNITS.window).unionByName(sorted_.withColumn("proof", F.lit(None).cast("binary")))
    columns = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return R.rebuilt(texts, gone, _digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", columns, UNITS.window)
