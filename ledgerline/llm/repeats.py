"""Windows of fixed length that stand earlier too, over words or bytes.

A window's anchor is the least hash among its grams, the leftmost one on ties,
so equal windows have equal grams at equal offsets in them.  Each anchor lists
the windows that chose it: about one row for every dozen windows.  Rows meet
by gram in one sorted stream.  Rows with equal surroundings form a class whose
later members lose all their windows at once; only the first members of grams
with several classes need their windows compared one by one.

Before rows are dealt out by gram, each task takes out those that repeat a class it
has met before: its first place is enough for the others to meet.  So a gram that a
third of all documents share sends a row or so for each task.

A row that repeats a class names an earlier place of it instead of gram and
surroundings, so that what the hashes say can be held against the bytes.

Order of occurrence is by (doc_id, variant, position).  Different texts of one id
are its variants, in order of a hash; a document without an id gets one from a hash
of its text, before all others.  `at` packs variant, position, windows to the left
of the anchor and their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .common import documents, only_ids, written

PLACES = "kind int, gram long, around long, doc_id long, at long"
NO_ID = -(1 << 63)
LATER, FIRST, HEAD = 0, 1, 2
VARIANTS = 1 << 15
#: Classes that a task remembers to have met.
REMEMBERED = 1 << 20
LOCAL = (1 << 48) - 1


@dataclass(frozen=True)
class Units:
    """What windows are made of: bytes, or whole words by their hash."""

    name: str
    window: int
    gram: int

    def values(self, buf: np.ndarray, at: np.ndarray, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """A 64-bit value for each unit of a slice, and the row offsets in units."""
        if self.name == "bytes":
            return K._letters(seed)[buf], at
        starts, ends, rows = K.word_spans(buf, at)
        return K.span_hashes(buf, starts, ends, seed), np.searchsorted(rows, np.arange(len(at)))


def pack(at: np.ndarray, left: np.ndarray, count: np.ndarray) -> np.ndarray:
    return (at.astype(np.int64) << 16) | (left.astype(np.int64) << 8) | count.astype(np.int64)


def unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, offset of the anchor from it, number of windows."""
    at, left, count = packed >> 16, (packed >> 8) & 255, packed & 255
    return at - left, left, count


def prefix(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial hash, and the factors that align them."""
    up, down = K.powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    return total, down


def anchors(values: np.ndarray, offsets: np.ndarray, units: Units) -> tuple[np.ndarray, ...]:
    """gram, surroundings, row, position in the row, windows left of it and their number, of each anchor."""
    window, width = units.window, units.window - units.gram + 1
    out = []
    whole = len(values)
    for lo in range(0, max(whole - window + 1, 0), K.SPAN):
        part = values[lo : lo + K.SPAN + window - 1]
        total, down = prefix(part)
        n = len(part) - units.gram + 1
        grams = K.mix((total[units.gram :] - total[:n]) * down[:n])
        place = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
        least = (K.windowed_min(place, width) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        starts = np.arange(len(least)) + lo
        row = np.searchsorted(offsets, starts, "right") - 1
        keep = np.flatnonzero(starts + window <= offsets[row + 1])
        if not len(keep):
            continue
        least, row = least[keep], row[keep]
        head = np.ones(len(keep), bool)
        head[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(head)
        count = np.diff(np.append(first, len(keep)))
        start, least, row = keep[first], least[first], row[first]
        end = start + count - 1 + window
        around = K.mix((total[end] - total[start]) * down[start] + ((least - start) * 256 + count).astype(np.uint64))
        out.append((grams[least], around, row, least + lo - offsets[row], least - start, count))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 4


def numbered(docs: DataFrame) -> DataFrame:
    """own_id, doc_id (never null), variant and text of each row; an id with more than VARIANTS texts is an error."""
    texts = documents(docs).withColumnRenamed("doc_id", "own_id")
    mark = F.xxhash64("text")
    texts = texts.withColumn("doc_id", F.coalesce("own_id", F.lit(NO_ID) + F.shiftrightunsigned(mark, 3)))
    several = texts.groupBy("doc_id").agg(F.min(mark).alias("low"), F.max(mark).alias("high")).where("low <> high").select("doc_id")
    several = written(several, "ids-with-texts")
    if not several.limit(1).count():
        return texts.select("own_id", "doc_id", F.lit(0).cast("long").alias("variant"), "text")
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("mark")) - 1
    known = only_ids(texts, several).select("doc_id", mark.alias("mark")).distinct().withColumn("variant", rank.cast("long"))
    known = written(known.withColumn("variant", F.when(F.col("variant") < VARIANTS, F.col("variant")).otherwise(F.raise_error(F.lit("too many texts of one id")))), "variants")
    return texts.withColumn("mark", mark).join(known, ["doc_id", "mark"], "left").select("own_id", "doc_id", F.coalesce("variant", F.lit(0)).alias("variant"), "text")


class Met:
    """Classes that a task has met more than once, each with a first place."""

    def __init__(self):
        self.key, self.rows = np.zeros(0, np.uint64), [np.zeros(0, np.int64) for _ in range(4)]

    def later(self, gram: np.ndarray, around: np.ndarray, doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which rows have their class's equal before them, in these rows or in those met, and the document and place of that."""
        order = np.lexsort((at, doc, around, gram))
        rows = [c[order] for c in (gram, around, doc, at)]
        fresh = np.concatenate([[True], (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])])
        head = np.flatnonzero(fresh)
        first = head[np.cumsum(fresh) - 1]
        out, lead = np.zeros(len(gram), bool), (np.empty_like(doc), np.empty_like(at))
        out[order] = (rows[2] != rows[2][first]) | (rows[3] != rows[3][first])  # a repeated row is the same place
        for own, c in zip(lead, rows[2:], strict=True):
            own[order] = c[first]
        size = np.diff(np.append(head, len(gram)))
        heads = [c[head] for c in rows]
        key = K.mix(heads[0].view(np.uint64) ^ K.mix(heads[1].view(np.uint64)))
        if len(self.key):
            place = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            old = [c[place] for c in self.rows]
            same = (self.key[place] == key) & (old[0] == heads[0]) & (old[1] == heads[1])
            after = same & ((old[2] < heads[2]) | ((old[2] == heads[2]) & (old[3] < heads[3])))
            out[order[head[after]]] = True
            for own, c in zip(lead, old[2:], strict=True):
                own[order[head[after]]] = c[after]
            for c, new in zip(self.rows[2:], heads[2:], strict=True):
                c[place[same & ~after]] = new[same & ~after]
            size = np.where(same, 1, size)
        add = np.flatnonzero(size > 1)
        if len(add):
            if len(self.key) + len(add) > REMEMBERED:
                self.__init__()
            merged = np.argsort(np.concatenate([self.key, key[add]]), kind="stable")
            self.key = np.concatenate([self.key, key[add]])[merged]
            self.rows = [np.concatenate([c, h[add]])[merged] for c, h in zip(self.rows, heads, strict=True)]
        return out, *lead


def anchor_rows(texts: DataFrame, units: Units) -> DataFrame:
    """PLACES of every whole text of `numbered` rows: LATER where the task has met the class before, else FIRST."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = Met()
        for batch in batches:
            ids, variants = batch.column("doc_id").to_numpy(), batch.column("variant").to_numpy()
            buf, at = K.text_column(batch.column("text"))
            for lo, _, b, a in K.slices(buf, at):
                gram, around, row, place, left, count = anchors(*units.values(b, a), units)
                if not len(gram):
                    continue
                columns = [gram.view(np.int64), around.view(np.int64), ids[lo + row], pack(place + (variants[lo + row] << 32), left, count)]
                later, *lead = met.later(*columns)
                kind = np.where(later, LATER, FIRST).astype(np.int32)
                for c, v in zip(columns[:2], lead, strict=True):  # these rows meet nothing more
                    c[later] = v[later]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (kind, *columns)], ["kind", "gram", "around", "doc_id", "at"])

    return texts.select("doc_id", "variant", "text").mapInArrow(run, PLACES)


def _classes(heads: bool):
    """Over rows in order of (kind, gram, around, doc_id, at): what to remove and what to compare.

    LATER rows repeat a class, those that are so already come first; with `heads` they keep their gram, else they name the class's first place; FIRST rows are first of a class whose gram has
    others; HEAD rows, if asked for, are the first of each class.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # gram, around, doc and at of the open class's first row, and whether it has been given as FIRST
        for batch in batches:
            done = int(np.searchsorted(batch.column("kind").to_numpy(), LATER, "right"))
            if done:
                yield batch.slice(0, done)
            batch = batch.slice(done)
            if not batch.num_rows:
                continue
            gram, around, doc, at = (batch.column(c).to_numpy() for c in ("gram", "around", "doc_id", "at"))
            shift = 0
            if held:
                shift = 1
                gram, around, doc, at = (np.concatenate([[h], x]) for h, x in zip(held[:4], (gram, around, doc, at), strict=True))
            new_gram = np.ones(len(gram), bool)
            new_gram[1:] = gram[1:] != gram[:-1]
            new_class = new_gram.copy()
            new_class[1:] |= around[1:] != around[:-1]
            head = np.flatnonzero(new_class)
            mine = head[np.cumsum(new_class) - 1]
            later = np.flatnonzero((doc != doc[mine]) | (at != at[mine]))
            many = np.zeros(len(head), bool)  # classes with another class of their gram before or after
            same = gram[head[1:]] == gram[head[:-1]]
            many[1:] |= same
            many[:-1] |= same
            if held and held[4]:  # its gram is known to have several classes, and it has been given
                follows = gram[head] == held[0]
                many |= follows
                many[0] = False
            given = bool(many[-1]) or bool(held and held[4] and gram[head[-1]] == held[0])
            last = head[-1]
            held = (gram[last], around[last], doc[last], at[last], given)
            firsts = head[many]
            fresh = head[head >= shift] if heads else head[:0]
            rows = np.concatenate([later, firsts, fresh])
            kind = np.repeat(np.array([LATER, FIRST, HEAD], np.int32), [len(later), len(firsts), len(fresh)])
            columns = [x[rows] for x in (gram, around, doc, at)]
            if not heads:
                columns[0][: len(later)], columns[1][: len(later)] = doc[mine[later]], at[mine[later]]
            yield pa.RecordBatch.from_arrays([pa.array(kind), *map(pa.array, columns)], ["kind", "gram", "around", "doc_id", "at"])

    return run


def meet(rows: DataFrame, heads: bool = False, buckets: int | None = None) -> DataFrame:
    """PLACES of rows that meet by gram; a sorted stream keeps one row in memory, however many share a gram.

    With `buckets`, rows are dealt as Spark deals a table of so many buckets of gram,
    and rows that meet nothing take a gram by their document.
    """
    dealt = F.when(F.col("kind") == LATER, F.xxhash64("doc_id")).otherwise(F.col("gram"))
    dealt_rows = rows.withColumn("gram", dealt).repartition(buckets, "gram") if buckets else rows.repartition(dealt)
    return dealt_rows.sortWithinPartitions("kind", "gram", "around", "doc_id", "at").mapInArrow(_classes(heads), PLACES)


def surroundings(texts: DataFrame, firsts: DataFrame, make, schema: str) -> DataFrame:
    """`make(values, lists)` over the `numbered` rows that `firsts` (gram, doc_id, at) names."""
    own = ["doc_id", "variant"]
    wanted = written(firsts.groupBy("doc_id", F.shiftright("at", 48).alias("variant")).agg(F.collect_list(F.struct("gram", "at")).alias("wanted")), "wanted")
    some = only_ids(texts, written(wanted.select("doc_id").distinct(), "wanted-ids"))
    return some.select(*own, "text").join(wanted, own).mapInArrow(make, schema)


def ranges(docs: np.ndarray, starts: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Joins ranges of window starts of a document that touch."""
    order = np.lexsort((starts, docs))
    docs, starts, last = docs[order], starts[order], last[order]
    if not len(docs):
        return docs, starts, last
    fresh = np.ones(len(docs), bool)
    fresh[1:] = (docs[1:] != docs[:-1]) | (starts[1:] > last[:-1] + 1)
    head = np.flatnonzero(fresh)
    return docs[head], starts[head], np.maximum.reduceat(last, head)


def window_rows(units: Units):
    """Two hashes of each listed window: (hash_a, hash_b, doc_id, start)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, wanted = batch.column("doc_id").to_numpy(), batch.column("wanted")
            buf, at = K.text_column(batch.column("text"))
            for lo, hi, b, a in K.slices(buf, at):
                listed = [wanted[i].values.field("at").to_numpy() for i in range(lo, hi)]
                row = np.repeat(np.arange(hi - lo), [len(x) for x in listed])
                packed = np.concatenate(listed)
                start, _, count = unpack(packed & LOCAL)
                steps = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                row, start, base = np.repeat(row, count), np.repeat(start, count) + steps, np.repeat(packed >> 48 << 32, count)
                hashes = []
                for seed in (1, 2):
                    values, offsets = units.values(b, a, seed)
                    runs = K.run_hashes(values, units.window)
                    place = offsets[row] + start
                    hashes.append(runs[place])
                columns = [*(h.view(np.int64) for h in hashes), ids[lo + row], base + start]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["hash_a", "hash_b", "doc_id", "start"])

    return run


WINDOWS = "hash_a long, hash_b long, doc_id long, start long"


def later_windows(windows: DataFrame) -> DataFrame:
    """(doc_id, start, lead, lead_start) of the windows whose two hashes stand earlier too, and where they stand first.

    First places are minima, summed in part before they meet; the join back to
    them may be split by Spark where one window is very common.
    """
    first = windows.groupBy("hash_a", "hash_b").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.max(F.struct("doc_id", "start")).alias("last"))
    first = first.where("first <> last").drop("last")
    met = windows.join(first, ["hash_a", "hash_b"])
    return met.where(F.struct("doc_id", "start") != F.col("first")).select("doc_id", "start", F.col("first.doc_id").alias("lead"), F.col("first.start").alias("lead_start"))


def as_links(places: DataFrame) -> DataFrame:
    """(doc_id, first, last, lead, lead_first) of LATER places: window starts, and those of the earlier place that each names."""
    start = lambda c: F.shiftright(c, 16) - F.shiftright(c, 8).bitwiseAND(F.lit(255))
    last = start("at") + F.col("at").bitwiseAND(F.lit(255)) - 1
    return places.select("doc_id", start("at").alias("first"), last.alias("last"), F.col("gram").alias("lead"), start("around").alias("lead_first"))


def stretches(links: DataFrame) -> DataFrame:
    """Joins links of a document that touch and whose earlier places touch alike."""
    links = links.withColumn("shift", F.col("lead_first") - F.col("first"))
    order = Window.partitionBy("doc_id", "lead", "shift").orderBy("first", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.coalesce(F.col("first") > reach + 1, F.lit(True)), 1).otherwise(0)
    parts = links.withColumn("fresh", fresh).withColumn("part", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = parts.groupBy("doc_id", "lead", "shift", "part").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return joined.select("doc_id", "first", "last", "lead", (F.col("first") + F.col("shift")).alias("lead_first"))


PIECES = "lead long, lead_first long, size long, proof binary"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, variants = batch.column("doc_id").to_numpy(), batch.column("variant").to_numpy()
        for i, text in enumerate(batch.column("text")):
            raw, wanted = (text.as_py() or "").encode(), batch.column("wanted")[i].values
            first, size = (wanted.field(c).to_numpy() for c in ("first", "size"))
            pieces = [raw[s : s + n] for s, n in zip((first & 0xFFFFFFFF).tolist(), size.tolist(), strict=True)]
            columns = [np.repeat(ids[i], len(first)), (first & 0xFFFFFFFF) + (variants[i] << 32), size]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(pieces, pa.binary())], ["lead", "lead_first", "size", "proof"])


def proven(links: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """(doc_id, first, last, proof): stretches of byte windows with the bytes that the earlier place has.

    A piece of an earlier text that many documents repeat is cut out once.
    """
    asked = written(stretches(links).withColumn("size", F.col("last") - F.col("first") + window), "stretches")
    own = ["doc_id", "variant"]
    wanted = asked.groupBy(F.col("lead").alias("doc_id"), F.shiftright("lead_first", 32).alias("variant")).agg(F.collect_set(F.struct(F.col("lead_first").alias("first"), "size")).alias("wanted"))
    wanted = written(wanted, "wanted-pieces")
    some = only_ids(texts, written(wanted.select("doc_id").distinct(), "wanted-ids"))
    pieces = some.select(*own, "text").join(wanted, own).mapInArrow(_pieces, PIECES)
    # rows that repeat an id and its text cut a piece each
    pieces = pieces.groupBy("lead", "lead_first", "size").agg(F.first("proof").alias("proof"))
    return asked.join(pieces, ["lead", "lead_first", "size"]).select("doc_id", "first", "last", "proof")


def as_ranges(places: DataFrame) -> DataFrame:
    """(doc_id, first, last) window starts of packed places."""
    start = F.shiftright("at", 16) - F.shiftright("at", 8).bitwiseAND(F.lit(255))
    return places.select("doc_id", start.alias("first"), (start + F.col("at").bitwiseAND(F.lit(255)) - 1).alias("last"))


def removed_units(ranges: tuple[np.ndarray, np.ndarray], window: int, n: int) -> np.ndarray:
    """Which of n units lie in a window that starts in one of the ranges (first starts, last starts)."""
    depth = np.zeros(n + 1, np.int32)
    np.add.at(depth, np.clip(ranges[0], 0, n), 1)
    np.add.at(depth, np.clip(ranges[1] + window, 0, n), -1)
    return np.cumsum(depth)[:n] > 0


def rebuilt(texts: DataFrame, gone: DataFrame, digest, schema: str, columns: list[str], window: int = 0) -> DataFrame:
    """`digest(text bytes, ranges or None)` of every `numbered` row.

    Documents that lose nothing get theirs in place; only the others' texts meet
    their ranges.  A range of byte windows that comes with a proof counts if the text has
    just those bytes there.
    """
    proofs = ["proof"] * ("proof" in gone.columns)

    def run(with_ranges: bool):
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if with_ranges:
                    lists = batch.column("gone")
                    edges = lists.offsets.to_numpy()
                    first, last = (lists.values.field(c).to_numpy() & 0xFFFFFFFF for c in ("first", "last"))
                    proof = lists.values.field("proof") if proofs else None
                out = []
                for i, text in enumerate(batch.column("text")):
                    raw = (text.as_py() or "").encode()
                    own = None
                    if with_ranges and edges[i] < edges[i + 1]:
                        own = first[edges[i] : edges[i + 1]], last[edges[i] : edges[i + 1]]
                        if proofs:
                            spans = zip(*(c.tolist() for c in own), proof[edges[i] : edges[i + 1]].to_pylist(), strict=True)
                            sound = np.array([p is None or raw[a : b + window] == p for a, b, p in spans])
                            own = (own[0][sound], own[1][sound]) if sound.any() else None
                    out.append(digest(raw, own))
                values = list(zip(*out, strict=True)) or [[] for _ in columns]
                kinds = [pa.string() if c.endswith("sha256") else pa.int64() for c in columns]
                yield pa.RecordBatch.from_arrays([batch.column("own_id"), *(pa.array(v, k) for v, k in zip(values, kinds, strict=True))], ["doc_id", *columns])

        return each

    own = ["doc_id", "variant"]
    gone = written(gone.groupBy("doc_id", F.shiftright("first", 32).alias("variant")).agg(F.collect_list(F.struct("first", "last", *proofs)).alias("gone")), "ranges")
    ids = written(gone.select("doc_id").distinct(), "range-ids")
    some = only_ids(texts, ids).join(gone, own, "left").mapInArrow(run(True), schema)
    rest = only_ids(texts, ids, "left_anti").mapInArrow(run(False), schema)
    return some.unionByName(rest)
