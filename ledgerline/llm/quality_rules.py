"""Quality rules: an isolation forest on rule statistics.

Each document gets rule statistics in one pass over its whole text.  A forest of
random splits, fitted on all labelled rows, gives each document a mean path
length; short paths mark anomalies.  Labelled rows are dealt over the trees by
their place in the order of a hash, so every row teaches at least one tree.  Trees
grow level by level: tasks give the extents and counts of nodes, and a table as
large as the forest reaches the driver.  The threshold comes from all labelled
rows: the largest score that at most `tolerance` of the good ones exceed.

Defined results: null and empty texts have no words and fail the base rules;
without labelled rows only the base rules decide; repeated rows and extra
columns pass through `statistics` row by row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import documents, least_hashes, written

SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_lines", "n_upper", "n_digits", "n_marks", "n_short", "n_distinct"]
SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in [*COUNTS, *EXTRA])
FEATURES = ["symbols", "upper", "marks", "monotony", "repeats"]

_symbol = np.isin(np.arange(256), list(SYMBOLS))
_lead = (np.arange(256) & 0xC0) != 0x80
_upper = np.isin(np.arange(256), list(range(65, 91)))
_digit = np.isin(np.arange(256), list(range(48, 58)))
_mark = np.isin(np.arange(256), list(b"!?{}[]=_^~\\"))


def slice_statistics(buf: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """COUNTS and EXTRA of each text of a slice."""
    n = len(at) - 1
    starts, ends, rows = K.word_spans(buf, at)
    hashes = K.span_hashes(buf, starts, ends)
    n_words = np.bincount(rows, minlength=n)
    word_chars = K.row_counts(_lead[buf] & ~K.SPACE[buf], at)

    windows, whole = K.run_hashes(hashes, 8), K.within(rows, 8)
    keys = windows ^ K.mix(rows[: len(windows)].astype(np.uint64) + np.uint64(77))
    kept = np.flatnonzero(whole)
    order = kept[np.argsort(keys[kept], kind="stable")]
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(hashes), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    repeat = K.per_row(K.covered(twice[: len(windows)], 8, len(hashes)), rows, n)

    marks = np.zeros(len(hashes), np.uint64)
    marks[:] = hashes ^ K.mix(rows.astype(np.uint64) + np.uint64(5))
    order = np.argsort(marks, kind="stable")
    fresh = np.ones(len(marks), bool)
    fresh[1:] = marks[order][1:] != marks[order][:-1]
    distinct = np.bincount(rows[order[fresh]], minlength=n)

    lines, dup, short = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    view = memoryview(np.ascontiguousarray(buf))
    for i in range(n):
        found = [x for x in bytes(view[at[i] : at[i + 1]]).split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
        lines[i], dup[i] = len(found), len(found) - len(set(found))
        short[i] = sum(len(x) < 30 for x in found)
    return [n_words, word_chars, K.row_counts(_symbol[buf], at), dup, repeat, lines, K.row_counts(_upper[buf], at), K.row_counts(_digit[buf], at), K.row_counts(_mark[buf], at), short, distinct]


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, at = K.text_column(batch.column("text"))
        parts = [slice_statistics(b, a) for _, _, b, a in K.slices(buf, at)]
        columns = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * len([*COUNTS, *EXTRA])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", *COUNTS, *EXTRA])


def statistics(docs: DataFrame) -> DataFrame:
    """Rule statistics of every whole text, one row per document row."""
    return documents(docs).mapInArrow(_statistics, SCHEMA)


def features(columns: dict[str, np.ndarray]) -> np.ndarray:
    """FEATURES in 0..1: each is 0 within the usual range and saturates beyond it."""
    c = {k: np.asarray(v, float) for k, v in columns.items()}
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    variety = np.log(np.maximum(c["n_distinct"], 1)) - 0.85 * np.log(words)
    beyond = {
        "symbols": (c["n_symbols"] / words, 0.1),
        "upper": (c["n_upper"] / chars - 0.06, 0.1),
        "marks": (c["n_marks"] / words, 0.1),
        "monotony": (0.3 - variety, 0.3),
        "repeats": (c["n_repeat_words"] / words - 0.15, 0.1),
    }
    return np.stack([(v := np.maximum(x, 0)) / (v + half) for x, half in beyond.values()], axis=1)


def _mean_path(n: np.ndarray | float) -> np.ndarray | float:
    """Expected path length of an unsuccessful search among n items."""
    n = np.maximum(n, 1.0)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / n, np.where(n > 1, 1.0, 0.0))


class IsolationForest:
    """Random split trees as arrays of complete binary trees.

    A row teaches as many trees as give each tree `sample` rows, and one at least.
    """

    def __init__(self, trees: int = 128, sample: int = 32, seed: int = 11):
        self.trees, self.sample, self.seed = trees, sample, seed
        self.depth = int(np.ceil(np.log2(sample)))

    def fit(self, x: np.ndarray) -> IsolationForest:
        """Fits on rows in their order."""
        x, places = x.astype(np.float32), np.arange(len(x))
        return self.grow(len(x), x.shape[1], lambda level: self.extents(x, places, level))

    def grow(self, rows: int, width: int, extents: Callable[[int], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> IsolationForest:
        """Grows all trees by a level at a time, from what `extents` tells of that level's nodes over all rows."""
        self.each = min(self.trees, max(1, -(-self.trees * self.sample // max(rows, 1))))
        self.norm = max(float(_mean_path(rows * self.each / self.trees)), 1e-9)
        nodes = 2 ** (self.depth + 1) - 1
        self.feature = np.zeros((self.trees, nodes), np.int8)
        self.split = np.full((self.trees, nodes), np.inf, np.float32)
        self.path = np.zeros((self.trees, nodes), np.float32)
        splits = np.zeros((self.trees, 1))  # real ones above each node of the level
        for level in range(self.depth):
            counts, low, high = extents(level)
            split = np.zeros(counts.shape, bool)
            for t, k in np.argwhere(counts > 1):
                usable = np.flatnonzero(high[t, k] > low[t, k])
                if len(usable):
                    rng = np.random.default_rng([self.seed, t, level, k])
                    f, node = int(rng.choice(usable)), 2**level - 1 + k
                    self.feature[t, node], self.split[t, node] = f, np.float32(rng.uniform(low[t, k, f], high[t, k, f]))
                    split[t, k] = True
            splits = np.repeat(splits + split, 2, axis=1)
        self.path[:, 2**self.depth - 1 :] = splits + _mean_path(extents(self.depth)[0].astype(float))
        return self

    def extents(self, x: np.ndarray, places: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each tree's nodes of a level: how many of these rows it has, and their least and greatest values."""
        wide = 2**level
        counts = np.zeros(self.trees * wide, np.int64)
        low, high = np.full((len(counts), x.shape[1]), np.inf, np.float32), np.full((len(counts), x.shape[1]), -np.inf, np.float32)
        start = K.mix(places.astype(np.uint64) + np.uint64(self.seed))
        step = (start >> np.uint64(32)) | np.uint64(1)
        for turn in range(self.each):
            tree = ((start + np.uint64(turn) * step) % np.uint64(self.trees)).astype(np.int64)
            slot = tree * wide + self.nodes(x, tree, level) - (wide - 1)
            counts += np.bincount(slot, minlength=len(counts))
            order = np.argsort(slot, kind="stable")
            head = np.flatnonzero(np.diff(slot[order], prepend=-1))
            if len(head):
                at, sorted_ = slot[order[head]], x[order]
                low[at] = np.minimum(low[at], np.minimum.reduceat(sorted_, head))
                high[at] = np.maximum(high[at], np.maximum.reduceat(sorted_, head))
        shape = (self.trees, wide)
        return counts.reshape(shape), low.reshape(*shape, -1), high.reshape(*shape, -1)

    def nodes(self, x: np.ndarray, tree: np.ndarray | int, level: int) -> np.ndarray:
        """The node of a level that each row comes to, in a tree or in one of its own."""
        every, node = np.arange(len(x)), np.zeros(len(x), np.int64)
        for _ in range(level):
            node = 2 * node + 1 + (x[every, self.feature[tree, node]] >= self.split[tree, node])
        return node

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score in 0..1; higher is stranger."""
        x, total = x.astype(np.float32), np.zeros(len(x))
        for t in range(self.trees):
            total += self.path[t, self.nodes(x, t, self.depth)]
        return 2.0 ** (-total / self.trees / self.norm)


def labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """All rows with a quality."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality is not null")
    return stats.join(known, "doc_id")


def labelled_sample(stats: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """The first `bound` labelled rows of those that the forest is fitted on, in their order: that of a hash of the id."""
    return least_hashes(labelled(stats, labels), bound, "quality", *COUNTS)


def placed(rows: DataFrame) -> DataFrame:
    """The rows with their place, from 0, in the order of `labelled_sample`; sorted by ranges, none of them whole in a task."""
    order = [F.xxhash64("doc_id"), F.col("doc_id"), *[F.col(c) for c in ["quality", *COUNTS, *EXTRA]]]
    sorted_ = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id()), "labelled-rows")
    part, ahead, before = F.shiftright("id", 33), {}, 0
    for row in sorted_.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect():
        ahead[row["part"]] = before
        before += row["n"]
    first = F.create_map(*[F.lit(v).cast("long") for item in ahead.items() for v in item]) if ahead else F.create_map().cast("map<bigint,bigint>")
    return sorted_.withColumn("place", F.col("id").bitwiseAND((1 << 33) - 1) + first[part])


def _columns(batch: pa.RecordBatch) -> np.ndarray:
    return features({c: batch.column(c).to_numpy(zero_copy_only=False) for c in [*COUNTS, *EXTRA]})


def fit_forest(rows: DataFrame) -> IsolationForest:
    """A forest on all rows by their `place`, equal to `IsolationForest.fit` on them in that order."""
    forest, width = IsolationForest(), len(FEATURES)
    lows, highs = [f"low{k}" for k in range(width)], [f"high{k}" for k in range(width)]

    def extents(level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = None
            for batch in batches:
                own = forest.extents(_columns(batch).astype(np.float32), batch.column("place").to_numpy(), level)
                found = own if found is None else (found[0] + own[0], np.minimum(found[1], own[1]), np.maximum(found[2], own[2]))
            if found is not None:
                counts, low, high = (m.reshape(forest.trees * 2**level, -1) for m in found)
                slot = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (slot, counts[slot, 0], *low[slot].T, *high[slot].T)], ["slot", "n", *lows, *highs])

        schema = "slot long, n long, " + ", ".join(f"{c} float" for c in [*lows, *highs])
        least = [F.min(c).alias(c) for c in lows] + [F.max(c).alias(c) for c in highs]
        shape = (forest.trees, 2**level)
        counts, ends = np.zeros(shape, np.int64), np.zeros((*shape, 2 * width), np.float32)
        for row in rows.mapInArrow(run, schema).groupBy("slot").agg(F.sum("n").alias("n"), *least).collect():
            at = np.unravel_index(row["slot"], shape)
            counts[at], ends[at] = row["n"], row[2:]
        return counts, ends[..., :width], ends[..., width:]

    return forest.grow(rows.count(), width, extents)


def scored(rows: DataFrame, forest: IsolationForest | None, schema: str) -> DataFrame:
    """The rows with their anomaly score; without a forest it is 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = forest.score(_columns(batch)) if forest else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*batch.schema.names, "anomaly"])

    return rows.mapInArrow(run, schema + ", anomaly double")


def value_at(values: DataFrame, rank: int, bins: int = 4096) -> float:
    """The value of a rank, from 0, of the one column of a table without nulls: exact, by counts in ever narrower bins."""
    (name,) = values.columns
    low, high = values.agg(F.min(name), F.max(name)).first()
    while low < high:
        own = values.where(F.col(name).between(low, high))
        bin_ = F.least(F.floor((F.col(name) - low) / (high - low) * bins), F.lit(bins - 1))
        for row in own.groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"), F.min(name).alias("low"), F.max(name).alias("high")).orderBy("bin").collect():
            if rank < row["n"]:
                low, high = row["low"], row["high"]
                break
            rank -= row["n"]
    return low


def calibrate(scores: DataFrame, tolerance: float) -> float:
    """The least threshold that at most `tolerance` of the good rows' scores reach."""
    n = scores.count()
    return value_at(scores, int(np.ceil((n - 1) * (1 - tolerance)))) + 1e-6 if n else 1.0


def quality_rules(docs: DataFrame, labels: DataFrame, tolerance: float = 0.002, min_words: int = 20, repeat_percent: int = 30) -> DataFrame:
    """COUNTS with base_failed, anomaly score and kept for every document.

    All labelled rows fit the forest and its threshold.
    """
    stats = written(statistics(docs), "rule-statistics")
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    rows = placed(labelled(stats, labels))
    forest, threshold = None, 1.0
    if not rows.isEmpty():
        forest = fit_forest(rows)
        good = rows.where(~base & (F.col("quality") == 1)).select(*stats.columns)
        threshold = calibrate(written(scored(good, forest, SCHEMA).select("anomaly"), "good-scores"), tolerance)
    out = scored(stats, forest, SCHEMA)
    return out.select("doc_id", *COUNTS, base.alias("base_failed"), (~base & (F.col("anomaly") < threshold)).alias("kept"), "anomaly")
