"""Hard-negative mining by threshold joins on an inverted index of anchors (after L2AP).

Entries become integers, floor(256 * entry); a score is an inner product.  Anchors come
in blocks of a fixed size in bytes.  A block's index has a posting list for each
group of dimensions, in falling order of their variance.  An anchor leaves out of its
postings the last dimensions whose norm, times the greatest row norm, stays under its
threshold.  Rows stream past where they lie: partial scores add up over the
postings, pairs that the norms of the dimensions still to come can't lift to
the threshold are dropped, what is left is scored exactly, and a task hands on at most
the best few of each list.

Thresholds start high and are lowered until lists fill.  For its positives, an
anchor starts at the best score in a sample of rows, goes on to the least one that
fills its list there, and ends without a threshold.  For the negatives of one
positive, a window between two parts of its score, the start is the best sampled
score in the window, then the least that fills it there, and the end is the window's
lower edge.  A list that is full at a threshold is final, so the sample changes the
cost and never the result.

Defined results: rows with a null id, a null label, a null vector, or a null,
non-finite or huge (a norm of 2**28 after scaling) entry take no part; a shorter
vector counts as ended by zeros; repeated rows count once, and a row with its anchor's
id is no partner; rows of one id that differ are rows of their own; anchors without
positives, and positives without negatives, give no rows; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, written
from .vectors import ENTRIES, lengths, parts, scaled

SCALE, BITS = 256.0, 28
#: Dimensions of one posting list, and anchors and rows that are scored at a time.
GROUP, ANCHORS, ROWS = 8, 512, 2048
#: Bytes of a block's anchors: what the driver holds and broadcasts at a time.
BLOCK_BYTES = 8 << 20
#: Rows that set the first thresholds.
SAMPLE = 4096
#: Found pairs that a task holds before it keeps the best of them.
HELD = 1 << 18
#: Lower than any score.
NONE = -(1 << 62)


def _tails(x: np.ndarray, edges: list[int]) -> np.ndarray:
    """Norms of each row's entries from each edge on; 0 from the last."""
    squares = np.add.reduceat(x.astype(float) ** 2, edges[:-1], axis=1) if len(edges) > 1 else np.zeros((len(x), 0))
    return np.sqrt(np.hstack([np.cumsum(squares[:, ::-1], axis=1)[:, ::-1], np.zeros((len(x), 1))]))


class Index:
    """Posting lists of some anchors, one for each group of dimensions."""

    def __init__(self, x: np.ndarray, least: np.ndarray, longest: float):
        """`least` is the score that an anchor's pairs must reach, `longest` the greatest norm of a row."""
        self.x, self.least = x, least.astype(float)
        width = x.shape[1]
        self.edges = [*range(0, width, GROUP), width]
        self.tails = _tails(x, self.edges)
        # from the first list on at which an anchor's other dimensions can't make a pair by themselves, it has no postings
        covered = self.tails * (longest * (1 + 1e-9)) < self.least[:, None]
        self.left_out = np.where(covered.any(1), covered.argmax(1), len(self.edges) - 1)
        self.postings = []
        for k, (lo, hi) in enumerate(zip(self.edges, self.edges[1:], strict=False)):
            ids = np.flatnonzero(self.left_out > k)
            self.postings.append((ids, np.ascontiguousarray(x[ids, lo:hi].T, np.float32)))

    def pairs(self, rows: np.ndarray, fits: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, anchor and exact score of all pairs that reach the anchor's least score, of those that `fits` allows."""
        tails, narrow = _tails(rows, self.edges), rows.astype(np.float32)
        # what sums of 32-bit floats may lose
        loose = tails[:, :1].astype(np.float32) * (self.tails[:, 0] * (rows.shape[1] + 8) * 2.0**-22).astype(np.float32)
        sums = np.zeros(loose.shape, np.float32)
        r = a = None
        for k, (ids, values) in enumerate(self.postings):
            part = narrow[:, self.edges[k] : self.edges[k + 1]]
            if r is None:
                if len(ids) == len(self.x):
                    sums += part @ values
                elif len(ids):
                    sums[:, ids] += part @ values
                if 2 * (k + 1) < len(self.postings):
                    continue
            else:
                place = np.full(len(self.x), -1)
                place[ids] = np.arange(len(ids))
                has = np.flatnonzero(place[a] >= 0)
                partial[has] += np.einsum("ij,ij->i", part[r[has]], values.T[place[a[has]]])
            # dimensions still to come: those of later lists, or those without postings
            rest = np.minimum(k + 1, self.left_out)
            if r is None:
                reach = sums + tails[:, rest] * self.tails[np.arange(len(rest)), rest] + loose
                alive = reach >= self.least if fits is None else (reach >= self.least) & fits
                if np.count_nonzero(alive) * 8 > alive.size and k + 1 < len(self.postings):
                    continue
                r, a = np.nonzero(alive)
                partial = sums[r, a].astype(float)
            else:
                keep = partial + tails[r, rest[a]] * self.tails[a, rest[a]] + loose[r, a] >= self.least[a]
                r, a, partial = r[keep], a[keep], partial[keep]
        if r is None:  # no dimensions: every score is 0
            r, a = np.nonzero(np.broadcast_to(self.least <= 0, loose.shape) if fits is None else (self.least <= 0) & fits)
        step = max(1, ENTRIES // max(rows.shape[1], 1))
        cuts = range(0, len(r), step)
        score = np.concatenate([np.einsum("ij,ij->i", rows[r[c : c + step]], self.x[a[c : c + step]]) for c in cuts] or [np.zeros(0, np.int64)])
        keep = score >= self.least[a]
        return r[keep], a[keep], score[keep]


class Best:
    """The best few different (score, id) of each list, from pairs that come in any order."""

    def __init__(self, lists: int, most: int):
        self.most, self.held = most, 0
        self.full = np.full(lists, NONE)  # the last score of a list that is full
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray) -> bool:
        """Whether lists were cut, so that `full` is new."""
        self.found.append((at, score, ids))
        self.held += len(at)
        if self.held <= HELD:
            return False
        self.cut()
        return True

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, score, ids = (np.concatenate(c) for c in zip(*self.found, strict=True)) if self.found else (np.zeros(0, np.int64),) * 3
        order = np.lexsort((ids, -score, at))
        at, score, ids = at[order], score[order], ids[order]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (at[1:] != at[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
        at, score, ids = at[fresh], score[fresh], ids[fresh]
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, np.int64)
        place = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
        last = place == self.most - 1
        self.full[at[last]] = score[last]
        keep = place < self.most
        self.found, self.held = [(at[keep], score[keep], ids[keep])], 0
        return self.found[0]


class Lists:
    """Open lists of one block of anchors, as tasks get them.

    A list belongs to an anchor and takes pairs with scores from `low` to `high`,
    of the anchor's own label or (`same` false) of others.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, owner: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, most: int):
        self.ids, self.labels, self.x, self.owner, self.low, self.high, self.same, self.most = ids, labels, x, owner, low, high, same, most

    def search(self, chunks: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], longest: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, score and id of the best pairs among chunks of rows (ids, labels, vectors)."""
        best = Best(len(self.owner), self.most)
        least = np.full(len(self.ids), -NONE)
        np.minimum.at(least, self.owner, self.low)
        # the lists of an anchor are neighbours
        first = np.searchsorted(self.owner, np.arange(len(self.ids) + 1))
        groups = [np.flatnonzero(self.labels == v) for v in np.unique(self.labels)] if self.same else [np.arange(len(self.ids))]
        tiles = [g[lo : lo + ANCHORS] for g in groups for lo in range(0, len(g), ANCHORS)]
        indexes = [Index(self.x[t], least[t], longest) for t in tiles]
        for ids, labels, rows in chunks:
            for tile, index in zip(tiles, indexes, strict=True):
                if self.same:
                    mine = np.flatnonzero(labels == self.labels[tile[0]])
                    r, a, score = index.pairs(rows[mine])
                    r = mine[r]
                else:
                    r, a, score = index.pairs(rows, labels[:, None] != self.labels[tile])
                a = tile[a]
                other = ids[r] != self.ids[a]
                r, a, score = r[other], a[other], score[other]
                cut = False
                for slot in range(int(np.diff(first).max(initial=0))):
                    at = first[a] + slot
                    ok = at < first[a + 1]
                    ok[ok] = (score[ok] >= np.maximum(self.low, best.full)[at[ok]]) & (score[ok] <= self.high[at[ok]])
                    cut |= best.add(at[ok], score[ok], ids[r[ok]])
                if cut:  # what can't enter a full list needn't be found
                    least = np.full(len(self.ids), -NONE)
                    np.minimum.at(least, self.owner, np.maximum(self.low, best.full))
                    for t, i in zip(tiles, indexes, strict=True):
                        i.least = least[t].astype(float)
        return best.cut()


def _chunks(batches: Iterator[pa.RecordBatch], order: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and vectors of rows that take part, at most ROWS at a time."""
    for batch in batches:
        for part in parts(batch, len(order)):
            ok, x = scaled(part.column(2), SCALE, len(order), BITS)
            norm = np.sqrt((x.astype(float) ** 2).sum(1))
            fine = norm < 2.0**BITS
            ids, labels = (part.column(k).filter(pa.array(ok)).to_numpy(zero_copy_only=False)[fine] for k in (0, 1))
            x = x[fine][:, order]
            for lo in range(0, len(x), ROWS):
                yield ids[lo : lo + ROWS], labels[lo : lo + ROWS], x[lo : lo + ROWS]


def _measures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, longest, squares = 0, 0.0, np.zeros(0)
    for batch in batches:
        width = int(lengths(batch.column(2)).max(initial=0))
        for _, _, x in _chunks(iter([batch]), np.arange(width)):
            squares = np.pad(squares, (0, max(0, width - len(squares))))
            each = x.astype(float) ** 2
            squares[:width] += each.sum(0)
            n, longest = n + len(x), max(longest, float(np.sqrt(each.sum(1)).max(initial=0)))
    yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([longest]), pa.array([np.r_[0.0, squares]], pa.list_(pa.float64()))], ["n", "longest", "squares"])


def _searched(rows: DataFrame, lists: Lists, order: np.ndarray, longest: float, columns: dict[str, np.ndarray]) -> DataFrame:
    """list, `columns` of the list, and found: its best (minus score, id), over all rows."""
    shared = rows.sparkSession.sparkContext.broadcast((lists, columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_lists, extra = shared.value
        at, score, ids = open_lists.search(_chunks(batches, order), longest)
        yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(v[at]) for v in extra.values()], pa.array(-score), pa.array(ids)], ["list", *extra, "fall", "id"])

    each = rows.mapInArrow(run, "list long, " + "".join(f"{c} long, " for c in columns) + "fall long, id long")
    found = F.slice(F.array_sort(F.collect_set(F.struct("fall", "id"))), 1, lists.most)
    return each.groupBy("list", *columns).agg(found.alias("found"))


def _sampled(x: np.ndarray, ids: np.ndarray, labels: np.ndarray, sample: tuple[np.ndarray, ...]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Scores with the sample, some anchors at a time: first and end anchor, scores, and whether labels agree; own rows are out of both."""
    for lo in range(0, len(x), 256):
        hi = min(lo + 256, len(x))
        scores = x[lo:hi].astype(float) @ sample[2].T.astype(float)
        own = ids[lo:hi, None] == sample[0]
        yield lo, hi, np.where(own, np.nan, scores), labels[lo:hi, None] == sample[1]


def _steps(scores: np.ndarray, fits: np.ndarray, ranks: list[int]) -> np.ndarray:
    """The scores at some ranks (from 1) of each line, of those that fit; -inf where there are fewer."""
    high = np.where(fits & ~np.isnan(scores), scores, -np.inf)
    high = -np.sort(-high, axis=1)
    high = np.pad(high, ((0, 0), (0, max(0, max(ranks) - high.shape[1]))), constant_values=-np.inf)
    return high[:, [r - 1 for r in ranks]]


def _whole(t: np.ndarray, lower: np.ndarray | int) -> np.ndarray:
    """Thresholds as integers, none under `lower`."""
    return np.where(np.isfinite(t), np.floor(np.where(np.isfinite(t), t, 0)), NONE).astype(np.int64).clip(min=lower)


def hard_negatives(vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, sample: int = SAMPLE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are rows whose vec_id is divisible by `every`.  Negatives of a positive
    are the best of other labels between `low` and `high` hundredths of its score.
    """
    spark = vectors.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), "embedding").where("id is not null and label is not null")
    measured = rows.mapInArrow(_measures, "n long, longest double, squares array<double>").select("n", "longest", F.posexplode("squares").alias("at", "square"))
    measured = measured.groupBy("at").agg(F.sum("n").alias("n"), F.max("longest").alias("longest"), F.sum("square").alias("square")).orderBy("at").collect()
    n = measured[0]["n"] if measured else 0
    if not n:
        return spark.createDataFrame([], schema)
    longest = max(r["longest"] for r in measured)
    order = np.argsort(-np.array([r["square"] for r in measured[1:]]), kind="stable")

    def taken(some: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, labels, x in _chunks(batches, order):
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(labels), pa.array(list(x), pa.list_(pa.int64()))], ["id", "label", "x"])

        return some.mapInArrow(run, "id long, label long, x array<long>")

    def arrays(some: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        got = some.toArrow()
        x = np.array(got.column("x").to_pylist(), np.int64).reshape(got.num_rows, len(order))
        return got.column("id").to_numpy(), got.column("label").to_numpy(), x

    anchors = taken(rows.where(F.col("id") % every == 0)).dropDuplicates(["id", "label", "x"])
    blocks = max(1, math.ceil(n / every * max(len(order), 1) * 8 / BLOCK_BYTES))
    anchors = written(anchors.withColumn("block", F.pmod(F.xxhash64("id", "label", "x"), F.lit(blocks))), "anchors")
    few = rows if n <= sample else rows.where(F.xxhash64("id") < int(-(1 << 63) + (1 << 64) * (sample / n)))
    seen = arrays(taken(few.limit(2 * sample)))
    share = len(seen[0]) / n

    finished: list[str] = []
    for block in range(blocks):
        ids, labels, x = arrays(anchors.where(F.col("block") == block).orderBy("id", "label", "x").select("id", "label", "x"))
        if not len(ids):
            continue
        # the positives: one list for each anchor
        ranks = [min(positives, math.ceil(2 * positives * share)), positives]
        steps = np.full((len(ids), 2), -np.inf)
        for lo, hi, scores, same in _sampled(x, ids, labels, seen):
            steps[lo:hi] = _steps(scores, same, ranks)
        best = np.full((len(ids), positives, 2), NONE)
        count, left = np.zeros(len(ids), int), np.arange(len(ids))
        for step in (*(_whole(steps[:, k], NONE) for k in range(2)), np.full(len(ids), NONE)):
            if not len(left):
                break
            lists = Lists(ids, labels, x, left, step[left], np.full(len(left), -NONE), True, positives)
            for r in _searched(rows, lists, order, longest, {}).toArrow().to_pylist():
                a = left[r["list"]]
                count[a] = len(r["found"])
                best[a, : count[a]] = [(-f["fall"], f["id"]) for f in r["found"]]
            left = left[(count[left] < positives) & (step[left] > NONE)]
        # the negatives: a list for each positive
        owner = np.repeat(np.arange(len(ids)), count)
        slot = np.concatenate([np.arange(c) for c in count]) if len(owner) else np.zeros(0, int)
        score = best[owner, slot, 0]
        bottom, top = -((-low * score) // 100), high * score // 100
        ranks = [min(negatives, math.ceil(2 * negatives * share)), negatives]
        steps = np.full((len(owner), 2), -np.inf)
        first = np.searchsorted(owner, np.arange(len(ids) + 1))
        for lo, hi, scores, same in _sampled(x, ids, labels, seen):
            for k in range(positives):
                at = first[lo:hi] + k
                has = np.flatnonzero(at < first[lo + 1 : hi + 1])
                at, part = at[has], scores[has]
                steps[at] = _steps(part, ~same[has] & (part <= top[at, None]) & (part >= bottom[at, None]), ranks)
        left = np.flatnonzero(bottom <= top)
        for step in (*(_whole(steps[:, k], bottom) for k in range(2)), bottom):
            if not len(left):
                break
            lists = Lists(ids, labels, x, owner[left], step[left], top[left], False, negatives)
            columns = {"place": left, "last": (step[left] == bottom[left]).astype(np.int64), "anchor_id": ids[owner[left]], "positive_id": best[owner, slot, 1][left], "positive_score": score[left]}
            found = written(_searched(rows, lists, order, longest, columns), "negatives")
            # a list is final if it is full or its threshold was the window's edge
            final = found.where((F.size("found") == negatives) | (F.col("last") == 1))
            finished.append(found._written_at)
            full = final.select("place").toArrow().column("place").to_numpy()
            left = np.setdiff1d(left[step[left] > bottom[left]], full)
    forget(anchors)
    if not finished:
        return spark.createDataFrame([], schema)
    out = spark.read.parquet(*finished).where((F.size("found") == negatives) | (F.col("last") == 1))
    out = out.select("anchor_id", "positive_id", "positive_score", F.posexplode("found").alias("place", "pair"))
    return out.select("anchor_id", "positive_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("pair.id").alias("negative_id"), "positive_score", (-F.col("pair.fall")).alias("negative_score"))
