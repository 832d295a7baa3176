"""MinHash near-dedup by a multi-index Hamming join.

A document is the set of its distinct word shingles.  Its signature has
`POSITIONS` minima of `BITS` bits.  Two signatures within `DISTANCE` differing
positions have a chunk with at most one (pigeonhole over `CHUNKS` chunks), so
both list the key of that chunk without that position: all pairs under the
signature distance share a key.  At a similarity of 0.8 a pair is further apart
with a probability of about 2 in 10,000.

Only connections matter, so a bucket of equal keys doesn't give all its pairs.

1. Each row pairs with its bucket's first row and with the row before, first
   within a batch (only the batch's first row of a key is shuffled), then among
   those first rows.  Pairs are confirmed on full sets; links make components, and
   pairs within the signature distance make groups.
2. In each bucket that holds rows of several groups all pairs between groups are
   tested, and groups with a pair within the signature distance become one.  A
   bucket keeps at most `CROWD` rows; groups with rows beyond those are joined
   untested, which only enlarges what step 3 compares.
3. So no pair within the signature distance has its rows in two groups.  In each
   group the rows outside its largest component meet all others on full sets, in
   cells of bounded size.  No pairs are made as rows, and each cell gives one link
   for two components.

Equal sets are one row from the start.

Defined results: empty and null texts have no shingles and link with nothing;
a null id links with nothing and is kept; an id with several texts has the links
of all of them and is in one component; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import BROADCAST_IDS, documents, forget, only_ids, written

POSITIONS, BITS, DISTANCE, CHUNKS = 96, 16, 33, 17
SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, signature binary"

_rng = np.random.default_rng(20240501)
_FLIP = _rng.integers(0, 1 << 32, POSITIONS, dtype=np.uint32)
_TIMES = _rng.integers(0, 1 << 32, POSITIONS, dtype=np.uint32) | np.uint32(1)
_WEIGHT = _rng.integers(0, 1 << 63, POSITIONS, dtype=np.uint64) | np.uint64(1)
_SEED = _rng.integers(0, 1 << 63, POSITIONS, dtype=np.uint64)
_EDGE = np.linspace(0, POSITIONS, CHUNKS + 1).round().astype(int)


def shingle_sets(buf: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, concatenated, and their offsets."""
    low = K.LOWER[buf]
    starts, ends, rows = K.word_spans(low, at)
    hashes = K.span_hashes(low, starts, ends)
    runs = K.run_hashes(hashes, n)
    first = np.searchsorted(rows, np.arange(len(at)))
    sets = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= n:
            sets.append(np.unique(runs[a : b - n + 1]))
        else:  # too few words: the whole sequence as one
            sets.append(K.run_hashes(hashes[a:b], b - a) if b > a else hashes[:0])
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return np.concatenate(sets) if sets else hashes[:0], offsets


def signatures(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """POSITIONS minima of each non-empty set, cut to 16 bits."""
    small = (values >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(offsets) - 1, POSITIONS), np.uint16)
    for k in range(POSITIONS):
        out[:, k] = np.minimum.reduceat((small ^ _FLIP[k]) * _TIMES[k], offsets[:-1]) * np.uint32(0x9E3779B1) >> np.uint32(32 - BITS)
    return out


def bucket_keys(signature: np.ndarray) -> np.ndarray:
    """For each position, the key of its chunk without it."""
    terms = (signature.astype(np.uint64) + np.uint64(1)) * _WEIGHT
    keys = np.empty(terms.shape, np.uint64)
    for a, b in zip(_EDGE[:-1], _EDGE[1:], strict=True):
        keys[:, a:b] = terms[:, a:b].sum(1, dtype=np.uint64)[:, None] - terms[:, a:b]
    return K.mix(keys + _SEED)


def _signed(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            buf, at = K.text_column(batch.column("text"))
            for lo, hi, b, a in K.slices(buf, at):
                values, offsets = shingle_sets(b, a, words)
                sizes = np.diff(offsets)
                full = np.flatnonzero(sizes)
                sums = [np.zeros(hi - lo, np.uint64) for _ in range(2)]
                marks = np.zeros((hi - lo, POSITIONS), np.uint16)
                if len(full):
                    heads = offsets[:-1][full]
                    for total, seed in zip(sums, (3, 4), strict=True):
                        total[full] = np.add.reduceat(K.mix(values + np.uint64(seed * 0x1234567)), heads)
                    marks[full] = signatures(values, np.append(heads, len(values)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(sizes), *(pa.array(s.view(np.int64)) for s in sums), pa.array([m.tobytes() for m in marks], pa.binary())],
                    ["doc_id", "n_shingles", "set_a", "set_b", "signature"],
                )

    return run


def _marks(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(-1, POSITIONS)


def _alike(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes can reach the similarity."""
    return 100 * np.minimum(n, m) >= percent * np.maximum(n, m)


def _pairs(columns: tuple[np.ndarray, ...], others: list[tuple[np.ndarray, ...]], met: np.ndarray, percent: int) -> np.ndarray:
    """Distinct (a, b) of rows with the rows they meet, if their sizes fit, and (a, a) of every row that meets one."""
    doc, n = columns
    a, b = [doc[met]], [doc[met]]
    for other, size in others:
        fit = met & _alike(size, n, percent)
        a += [other[fit], other[met]]
        b += [doc[fit], other[met]]
    a, b = np.concatenate(a), np.concatenate(b)
    return np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)


def _keyed(percent: int):
    """Rows (key, doc_id, n_shingles) of the first of each key in a batch, and pairs (doc_id, other) of the rest of the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = bucket_keys(_marks(batch)).view(np.int64).ravel()
            order = np.argsort(keys, kind="stable")
            key, row = keys[order], order // POSITIONS
            doc, n = (batch.column(c).to_numpy()[row] for c in ("doc_id", "n_shingles"))
            head = np.concatenate([[True], key[1:] != key[:-1]])
            at = np.maximum.accumulate(np.where(head, np.arange(len(key)), 0))
            pairs = _pairs((doc, n), [(doc[at], n[at]), (np.roll(doc, 1), np.roll(n, 1))], ~head, percent)
            m = pairs.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.nulls(m, pa.int64()), pa.array(key[head])]), pa.array(np.concatenate([pairs[0], doc[head]])),
                    pa.concat_arrays([pa.nulls(m, pa.int64()), pa.array(n[head])]), pa.concat_arrays([pa.array(pairs[1]), pa.nulls(int(head.sum()), pa.int64())]),
                ],
                ["key", "doc_id", "n_shingles", "other"],
            )

    return run


def _neighbours(percent: int):
    """Over rows in order of key, pairs (null key) first: those pairs, and those of each row with its bucket's first row and with the row before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # key; id and size of the bucket's first row and of the row before
        for batch in batches:
            made = batch.column("key").null_count
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(0, made), batch.column("other").slice(0, made)], ["a", "b"])
            batch = batch.slice(made)
            if not batch.num_rows:
                continue
            key, doc, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "doc_id", "n_shingles"))
            head = np.ones(len(key), bool)
            head[1:] = key[1:] != key[:-1]
            head[0] = last is None or key[0] != last[0]
            at = np.maximum.accumulate(np.where(head, np.arange(len(key)), -1))
            first = tuple(np.where(at >= 0, c[at], last[1][k] if last else 0) for k, c in enumerate((doc, n)))
            before = tuple(np.roll(c, 1) for c in (doc, n))
            for k, c in enumerate(before):
                c[0] = last[2][k] if last else 0
            last = key[-1], [c[-1] for c in first], [doc[-1], n[-1]]
            pairs = _pairs((doc, n), [first, before], ~head, percent)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    return run


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, POSITIONS) for c in ("x", "y"))
        near = pa.array((x != y).sum(1) <= DISTANCE)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(near), batch.column("b").filter(near)], ["a", "b"])


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            buf, at = K.text_column(batch.column("text"))
            for lo, hi, b, a in K.slices(buf, at):
                values, offsets = shingle_sets(b, a, words)
                data = [values[s:e].tobytes() for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array(data, pa.binary())], ["doc_id", "elements"])

    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = np.concatenate([p, q])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(p) + len(q) - common))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    return run


def _with_both(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """The pairs (a, b) with both sides' values as x and y."""
    left = pairs.join(values.select(F.col("doc_id").alias("a"), F.col(column).alias("x")), "a")
    return left.join(values.select(F.col("doc_id").alias("b"), F.col(column).alias("y")), "b").select("a", "b", "x", "y")


def confirm(pairs: DataFrame, signed: DataFrame, docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The pairs within the signature distance, and those whose full sets reach the similarity."""
    near = written(_with_both(pairs, signed, "signature").mapInArrow(_close, "a long, b long"), "near-pairs")
    ids = near.select(F.col("a").alias("doc_id")).union(near.select("b")).distinct()
    sets = full_sets(docs, written(ids, "near-ids"), words)
    return near, written(_with_both(near, sets, "elements").mapInArrow(_confirmed(percent), "a long, b long"), "links")


def full_sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """doc_id and elements of each distinct set of the given ids; an id with several texts has several."""
    texts = only_ids(documents(docs), ids).groupBy("doc_id", F.xxhash64("text").alias("_text")).agg(F.first("text").alias("text"))
    return texts.select("doc_id", "text").mapInArrow(_sets(words), "doc_id long, elements binary")


#: Links that one task makes a forest of.
FOREST = 50_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node of a task's links with the least node they reach from it."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    nodes = [x for x in root if find(x) != x]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], ["node", "other"])


def components(links: DataFrame) -> DataFrame:
    """(node, label): the least node that links reach from each linked node.

    Tasks first leave a forest of about FOREST links each, so that a large group
    has at most a link for each node and task.  Each round then gives a node the
    least label among its neighbours and then the label of that label, so chains
    shorten geometrically.
    """
    edges = written(links.where("a <> b").distinct(), "edges")
    trees = edges.repartition(1 + edges.count() // FOREST).mapInArrow(_forest, "node long, other long")
    trees = written(trees, "forest")
    both = trees.union(trees.select("other", "node")).distinct()
    both = written(both, "graph")
    forget(edges, trees)
    labels = written(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")), "labels")
    few = labels.count() <= BROADCAST_IDS
    side = F.broadcast if few else (lambda df: df.hint("merge"))
    while True:
        near = both.join(side(labels.select(F.col("node").alias("other"), "label")), "other").select("node", "label", F.lit(None).cast("long").alias("old"))
        step = near.union(labels.select("node", "label", F.col("label").alias("old"))).groupBy("node").agg(F.min("label").alias("label"), F.max("old").alias("old"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        step = step.join(side(jump), "label", "left").select("node", F.least("label", F.coalesce("far", "label")).alias("label"), "old")
        step = written(step, "labels")
        moved = step.where("label <> old").limit(1).count()
        forget(labels)
        labels = step
        if not moved:
            forget(both)
            return labels.select("node", "label")


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return rows.withColumn("label", F.col("doc_id"))
    return rows.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))


def bucket_pairs(signed: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of neighbours in each bucket, and (a, a) of every row that shares a bucket."""
    rows = signed.select("doc_id", "n_shingles", "signature").mapInArrow(_keyed(percent), "key long, doc_id long, n_shingles long, other long")
    rows = rows.repartition(F.coalesce("key", F.xxhash64("doc_id"))).sortWithinPartitions(F.col("key").asc_nulls_first(), "doc_id")
    return rows.mapInArrow(_neighbours(percent), "a long, b long").distinct()


#: Four bits of each position, packed in longs: they differ in at most as many places as the positions do.
PACKED = POSITIONS // 16
#: Rows of a bucket that are kept for comparison.
CROWD = 16_384


def _nibbles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each key, with the row's group and four bits of each position."""
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = _marks(batch)
        four = (marks & 15).astype(np.uint64).reshape(-1, PACKED, 16)
        packed = (four << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(2, dtype=np.uint64).view(np.int64)
        for lo in range(0, len(marks), 1024):
            part = slice(lo, lo + 1024)
            keys = bucket_keys(marks[part]).view(np.int64).ravel()
            group, n = (np.repeat(batch.column(c).to_numpy()[part], POSITIONS) for c in ("label", "n_shingles"))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (keys, group, n, *np.repeat(packed[part], POSITIONS, axis=0).T.copy())], ["key", "label", "n", *_WORDS])


_WORDS = [f"w{k}" for k in range(PACKED)]
_ONES = np.uint64(0x1111111111111111)


def differing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Positions whose four bits differ, of packed rows; it never exceeds the signature distance."""
    d = x ^ y
    d |= d >> np.uint64(2)
    d |= d >> np.uint64(1)
    return np.bitwise_count(d & _ONES).sum(-1, dtype=np.int64)


def _apart(percent: int):
    """Over rows in order of (key, label): pairs of labels (groups) to be made one.

    A pair of rows that are close joins their groups; a bucket's rows beyond
    CROWD join theirs with the next group's without a test.
    """

    def close(label: np.ndarray, n: np.ndarray, packed: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        live = np.flatnonzero(label[x] != label[y])
        live = live[_alike(n[x[live]], n[y[live]], percent)]
        live = live[differing(packed[x[live]], packed[y[live]]) <= DISTANCE]
        a, b = label[x[live]], label[y[live]]
        return np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)

    def small(label, n, packed, first, size):
        """All pairs of rows of one bucket, for many small buckets at once."""
        before = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        row = np.repeat(first, size) + before
        lo = 0
        total = np.cumsum(before)
        while lo < len(row):
            hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + (1 << 20), "right")))
            b, r = before[lo:hi], row[lo:hi]
            step = np.arange(b.sum()) - np.repeat(np.cumsum(b) - b, b)
            y = np.repeat(r, b)
            yield close(label, n, packed, np.repeat(r - b, b) + step, y)
            lo = hi

    def large(label, n, packed, lo, hi, start):
        """Rows start..hi of a bucket with the rows lo..hi of the groups before theirs."""
        edge = lo + np.flatnonzero(np.concatenate([[False], label[lo + 1 : hi] != label[lo : hi - 1]]))
        for s, e in zip(edge.tolist(), np.append(edge[1:], hi).tolist(), strict=True):
            wide = max(1, (1 << 18) // (s - lo))
            for k in range(max(s, start), e, wide):
                x, y = np.meshgrid(np.arange(lo, s), np.arange(k, min(k + wide, e)))
                yield close(label, n, packed, x.ravel(), y.ravel())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, loose = None, None  # rows kept of the open bucket; a group of it with rows that weren't kept
        for batch in batches:
            if not batch.num_rows:
                continue
            key, label, n = (batch.column(c).to_numpy() for c in ("key", "label", "n"))
            packed = np.stack([batch.column(w).to_numpy().view(np.uint64) for w in _WORDS], axis=1)
            found, old = [], 0
            if held is not None and held[0][0] == key[0]:
                old = len(held[0])
                if loose is not None:
                    first = int(np.searchsorted(key, key[0], "right"))
                    others = np.unique(label[:first])
                    found.append(np.stack([np.minimum(others, loose), np.maximum(others, loose)]))
                key, label, n, packed = (np.concatenate(c) for c in zip(held, (key, label, n, packed), strict=True))
            else:
                loose = None
            edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.append(edge, len(key)))
            mixed = label[edge] != label[edge + size - 1]
            few = mixed & (size <= 64) & ((edge > 0) | (old == 0))
            if few.any():
                found += small(label, n, packed, edge[few], size[few])
            for lo, m in zip(edge[mixed & ~few].tolist(), size[mixed & ~few].tolist(), strict=True):
                found += large(label, n, packed, lo, lo + m, lo + (old if lo == 0 else 0))
            lo, m = int(edge[-1]), int(size[-1])
            if lo:
                loose = None
            kept = slice(lo, lo + min(m, CROWD))
            if m > CROWD:
                rest = np.unique(label[lo + CROWD :])
                loose = rest[-1] if loose is None else loose
                found.append(np.stack([np.minimum(rest, loose), np.maximum(rest, loose)]))
            held = tuple(c[kept].copy() for c in (key, label, n, packed))
            pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
            pairs = pairs[:, pairs[0] != pairs[1]]
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    return run


def groups_to_join(signed: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups that share a bucket and have rows within the signature distance in it."""
    rows = _labelled(signed.select("doc_id", "n_shingles", "signature"), groups)
    rows = rows.mapInArrow(_nibbles, "key long, label long, n long, " + ", ".join(f"{w} long" for w in _WORDS))
    return rows.repartition("key").sortWithinPartitions("key", "label").mapInArrow(_apart(percent), "a long, b long").distinct()


#: Members of a group, and those outside its main component, that meet in one task.
MEMBERS, STRANGERS = 256, 512


def _across(percent: int):
    def run(members: pa.Table, others: pa.Table) -> pa.Table:
        """Links between rows of one group that are in different components, on full sets."""
        none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        if not members.num_rows or not others.num_rows:
            return none
        ids, n, labels = (members.column(c).to_numpy() for c in ("doc_id", "n_shingles", "label"))
        marks = np.stack([np.frombuffer(x, np.uint16) for x in members.column("signature").to_pylist()])
        sets = [np.frombuffer(x, np.uint64) for x in members.column("elements").to_pylist()]
        a, b, known = [], [], set()  # one link is enough for two components
        for doc, size, label, mark, data in zip(*(others.column(c).to_pylist() for c in ("doc_id", "n_shingles", "label", "signature", "elements")), strict=True):
            near = np.flatnonzero((labels != label) & ((marks != np.frombuffer(mark, np.uint16)).sum(1) <= DISTANCE) & _alike(n, np.int64(size), percent))
            if not len(near):
                continue
            own = np.frombuffer(data, np.uint64)
            joined = np.concatenate([sets[k] for k in near])
            at = np.minimum(np.searchsorted(own, joined), len(own) - 1)
            heads = np.concatenate([[0], np.cumsum([len(sets[k]) for k in near])[:-1]])
            common = np.add.reduceat((own[at] == joined).astype(np.int64), heads)
            for k in near[100 * common >= percent * (n[near] + size - common)].tolist():
                parts = min(labels[k], label), max(labels[k], label)
                if parts not in known:
                    known.add(parts)
                    a.append(min(ids[k], doc))
                    b.append(max(ids[k], doc))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def links_within(groups: DataFrame, signed: DataFrame, labels: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between components of one group (node, label) of rows that chains of close pairs join.

    A group's rows are dealt into cells of about MEMBERS, and those outside its
    largest component into cells of about STRANGERS; each pair of cells meets in
    one task, so a task's rows are bounded and no pairs are made as rows.
    """
    rows = _labelled(signed.select("doc_id"), labels).join(groups.select(F.col("node").alias("doc_id"), F.col("label").alias("of")), "doc_id")
    parts = rows.groupBy("of", "label").agg(F.count("*").alias("n"))
    shape = parts.groupBy("of").agg(F.sum("n").alias("n"), F.max(F.struct("n", "label"))["label"].alias("main"), F.max("n").alias("most"), F.count("*").alias("labels"))
    shape = shape.where("labels > 1 and n > 2")  # two rows have met
    shape = written(shape.select("of", "main", F.ceil(F.col("n") / MEMBERS).cast("int").alias("lines"), F.ceil((F.col("n") - F.col("most")) / STRANGERS).cast("int").alias("columns")), "cells")
    rows = written(rows.join(shape, "of"), "grouped-rows")
    ids = written(rows.select("doc_id").distinct(), "grouped-ids")
    sets = full_sets(docs, ids, words).withColumn("n_shingles", (F.octet_length("elements") / 8).cast("long"))
    full = written(sets.join(signed.select("doc_id", "n_shingles", "signature"), ["doc_id", "n_shingles"]).join(rows, "doc_id").distinct(), "grouped-sets")
    line, column = F.pmod(F.xxhash64("doc_id"), "lines").cast("int").alias("line"), F.pmod(F.xxhash64("doc_id", F.lit(1)), "columns").cast("int").alias("column")
    values = ["doc_id", "n_shingles", "label", "signature", "elements"]
    members = full.select("of", line, F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("column"), *values)
    others = full.where("label <> main").select("of", F.explode(F.sequence(F.lit(0), F.col("lines") - 1)).alias("line"), column, *values)
    others = others.toDF(*others.columns)
    cell = ["of", "line", "column"]
    return written(members.groupBy(*cell).cogroup(others.groupBy(*cell)).applyInArrow(_across(percent), "a long, b long"), "links")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document row."""
    signed = written(documents(docs).mapInArrow(_signed(words), SIGNED), "signatures")
    usable = signed.where("n_shingles > 0 and doc_id is not null")
    classes = usable.groupBy("set_a", "set_b", "n_shingles").agg(F.min(F.struct("doc_id", "signature")).alias("first"))
    one = written(classes.select("set_a", "set_b", "n_shingles", "first.*"), "distinct-sets")

    tested = written(bucket_pairs(one, percent), "pairs")
    # only rows that share a bucket can have pairs
    some = written(only_ids(one, written(tested.where("a = b").select(F.col("a").alias("doc_id")), "paired-ids")), "paired-sets")
    close, links = confirm(tested.where("a <> b"), some, docs, words, percent)
    forget(tested)
    labels, groups = components(links), components(close)
    joins = written(groups_to_join(some, groups, percent), "joined-groups")
    groups = components(close.union(joins))
    links = links.union(links_within(groups, some, labels, docs, words, percent)).union(several_texts(usable, one))
    labels = components(links)

    class_of = one.select("set_a", "set_b", "n_shingles", F.col("doc_id").alias("first"))
    class_of = class_of.join(labels.withColumnRenamed("node", "first"), "first", "left").select("set_a", "set_b", "n_shingles", F.coalesce("label", "first").alias("group"))
    out = signed.join(class_of, ["set_a", "set_b", "n_shingles"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("group")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def several_texts(usable: DataFrame, one: DataFrame) -> DataFrame:
    """Links of an id that has several sets with the first id of each of those sets."""
    ids = usable.groupBy("doc_id").agg(F.min("set_a").alias("low"), F.max("set_a").alias("high")).where("low <> high").select("doc_id")
    rows = only_ids(usable, written(ids, "several-texts")).select(F.col("doc_id").alias("a"), "set_a", "set_b", "n_shingles")
    return rows.join(one.select("set_a", "set_b", "n_shingles", F.col("doc_id").alias("b")), ["set_a", "set_b", "n_shingles"]).select("a", "b").distinct()
