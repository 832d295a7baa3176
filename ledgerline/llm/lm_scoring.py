"""LM scoring with a small causal self-attention model over subword ids.

Words (lower-cased A-Z) become subword ids of a public byte-pair vocabulary, with
a leading space; one end follows.  One causal attention layer over ids, each with
an embedding of its own, gives the class of the next id; to its logits the log of
the corpus's class pairs is added.  The SINGLE most frequent ids are classes of
their own.

A word's probability is that of the class of its first id, among the classes that
can start a word, times its share of that class: the word's share of the class's
teaching tokens or, by the share of words that teaching has once (Good and
Turing), the chance that the model spells it, id by id and then stops.  So all
words' probabilities sum to 1 in any context.

From the corpus come, over all rows that may teach: word counts, id counts, class
pairs, and the weights.  Teaching documents are dealt into shards of about
`shard_words` words by a hash; each trains from the same start on every window of
its documents, and the weights are averaged by ids seen, an id's embedding by its
own.  Shards depend on the data only.  All of that grows with the input; only
fixed-size results reach the driver.

Windows of `WINDOW` ids overlap by `OVERLAP`; every id is scored once, with all
windows of a batch in one masked product.

The base score needs each word's count.  Words of a count that at most
`head_words` words reach go to every task as arrays of fixed bound; rarer words
meet their counts in a join by hash.

Defined results: null and empty texts are one end; a null id is not held out;
without rows that teach, counts are 0 and the class pairs are even; rows that
repeat an id each get their own score; extra columns are ignored.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import documents, id_crc, written

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
END, IDS = 50256, 50257
WINDOW, OVERLAP, WIDTH = 32, 8, 16
SINGLE, SHARED = 24, 6
CLASSES = SINGLE + 2 * SHARED + 1  # the last is the end
START = CLASSES


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


_encoders: dict[int, Callable[[str], list[int]]] = {}


def encoder(ranks: dict[bytes, int]) -> Callable[[str], list[int]]:
    """Encodes words that stand after one space each; only a word's first id starts with the space.

    A worker keeps the encoder of the last vocabulary for its next tasks.
    """
    import tiktoken

    key = hash(tuple(ranks))
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = tiktoken.Encoding("words", pat_str=r"\x20[^\x20]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return _encoders[key]


def opening(ranks: dict[bytes, int]) -> np.ndarray:
    """Whether an id starts a word."""
    out = np.zeros(IDS, bool)
    for token, rank in ranks.items():
        out[rank] = token.startswith(b" ")
    return out


def id_classes(counts: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each id, and the log of its share of the class.

    The SINGLE most frequent ids are alone; the rest are grouped by frequency,
    apart by whether they start a word.
    """
    order = np.lexsort((np.arange(IDS), -counts))
    order = order[order != END]
    classes = np.full(IDS, CLASSES - 1, np.int64)
    classes[order[:SINGLE]] = np.arange(SINGLE)
    for k, side in enumerate((True, False)):
        rest = order[SINGLE:][opens[order[SINGLE:]] == side]
        mass = np.cumsum(counts[rest] + 1.0)
        group = np.minimum((mass / max(mass[-1], 1.0) * SHARED).astype(int), SHARED - 1) if len(rest) else rest
        classes[rest] = SINGLE + k * SHARED + group
    total = np.bincount(classes, weights=counts + 1.0, minlength=CLASSES)
    return classes, np.log((counts + 1.0) / total[classes])


@dataclass
class Tools:
    """What every task needs to spell: the vocabulary, which ids start a word, classes and shares of ids."""

    ranks: dict[bytes, int]
    opens: np.ndarray
    classes: np.ndarray
    within: np.ndarray

    def starting(self) -> np.ndarray:
        """Whether words, or the end, can start with a class."""
        out = np.zeros(CLASSES, bool)
        out[self.classes[self.opens]] = True
        out[CLASSES - 1] = True
        return out


class Work:
    """Arrays by name that batches use again; the first touch of a fresh one's pages costs more than the product in it."""

    def __init__(self) -> None:
        self.kept: dict[str, np.ndarray] = {}

    def __call__(self, name: str, like: np.ndarray, *shape: int) -> np.ndarray:
        size = math.prod(shape)
        if name not in self.kept or self.kept[name].size < size or self.kept[name].dtype != like.dtype:
            self.kept[name] = np.empty(size, like.dtype)
        return self.kept[name][:size].reshape(shape)

    def take(self, name: str, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The rows at the given places, all of which exist."""
        return np.take(rows, at, axis=0, out=self(name, rows, *at.shape, *rows.shape[1:]), mode="clip")


def symbol_runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in order of their symbols, where each symbol begins in it, and the symbols."""
    symbols = x.ravel().astype(np.uint16)  # all ids fit, and short integers sort by radix
    order = np.argsort(symbols, kind="stable")
    symbols = symbols[order]
    head = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1]))
    return order, head, symbols[head]


@dataclass
class Model:
    """Class pair logits, the weights of one attention layer, and the class of each input symbol."""

    pairs: np.ndarray
    weights: dict[str, np.ndarray]
    of: np.ndarray

    @staticmethod
    def shapes() -> dict[str, tuple[int, ...]]:
        d = WIDTH  # symbols of a class start with its embedding
        return {"embed": (CLASSES + 1, d), "place": (WINDOW, d), "query": (d, d), "key": (d, d), "value": (d, d), "out": (d, CLASSES)}

    @classmethod
    def start(cls, single: np.ndarray, of: np.ndarray | None = None) -> Model:
        """Class shares for pairs, small random weights, and no say of the attention yet."""
        rng = np.random.default_rng(3)
        weights = {k: (0.3 * rng.standard_normal(s)).astype(np.float32) for k, s in cls.shapes().items()}
        weights["out"][:] = 0
        of = np.arange(CLASSES + 1) if of is None else of
        weights["embed"] = weights["embed"][of]
        return cls(pair_logs(np.zeros((CLASSES + 1, CLASSES)), single), weights, of)

    def between(self) -> np.ndarray:
        """What the attention makes of two inputs: the (scaled) query weights times those of keys."""
        return self.weights["query"] * _SCALE @ self.weights["key"].T

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """What each symbol gives by itself: what meets the inputs before it, and logits of the next id."""
        embed = self.weights["embed"]
        return embed @ self.between(), embed @ self.weights["out"] + self.pairs[self.of]

    def forward(self, x: np.ndarray, work: Work, skip: int = 0, meets: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """Inputs of the layer and, from the place `skip` on, what meets them, attention, and means of inputs.

        Keys and values are the inputs times weights, so the weights are applied once on the queries' side and once to
        the means.  Products run window by window, so a window's logits are the same to the last bit wherever it stands
        in a batch.
        """
        w, n = self.weights, len(x)
        h = work.take("h", w["embed"], x)
        h += w["place"]
        g = work.take("queries", w["embed"] @ self.between() if meets is None else meets, x[:, skip:])
        g += (w["place"] @ self.between())[skip:]
        a = np.matmul(g, h.transpose(0, 2, 1), out=work("attention", h, n, WINDOW - skip, WINDOW))
        a += _CAUSAL[skip:]
        if a.max() > 40:
            np.minimum(a, 40, out=a)
        np.exp(a, out=a)
        rows = a.reshape(-1, WINDOW)
        rows /= (rows @ _COLUMN)[:, None]
        return h, g, a, np.matmul(a, h, out=work("mean", h, n, WINDOW - skip, WIDTH))

    def log_probabilities(self, x: np.ndarray, y: np.ndarray, groups: np.ndarray, work: Work | None = None, skip: int = 0, tables: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Logs of each target's probability, and of all classes' that a word can start with, from the place `skip` on."""
        w, work, y = self.weights, work or Work(), y[:, skip:]
        meets, alone = tables or self.tables()
        mean = self.forward(x, work, skip, meets)[-1]
        logits = np.matmul(mean, w["value"] @ w["out"], out=work("logits", mean, *y.shape, CLASSES))
        logits += work.take("alone", alone, x[:, skip:])
        logits += (w["place"] @ w["out"])[skip:]
        logits = logits.reshape(-1, CLASSES)
        own = logits.ravel()[np.arange(0, logits.size, CLASSES) + y.ravel()]
        sums = np.log(np.exp(logits, out=logits) @ groups)
        return (own - sums[:, 0]).reshape(y.shape), (sums[:, 1] - sums[:, 0]).reshape(y.shape)

    def gradients(self, x: np.ndarray, y: np.ndarray, live: np.ndarray, work: Work | None = None, runs: tuple[np.ndarray, ...] | None = None) -> dict[str, np.ndarray]:
        """Of the mean loss over live targets; `runs` are those of x, if known."""
        w, windows, work = self.weights, (*x.shape, WIDTH), work or Work()
        h, g, a, mean = self.forward(x, work)
        flat, mean = h.reshape(-1, WIDTH), mean.reshape(-1, WIDTH)
        z = np.matmul(mean, w["value"], out=work("z", h, x.size, WIDTH))
        z += flat
        p = np.matmul(z, w["out"], out=work("logits", h, x.size, CLASSES))
        # pairs are log probabilities and corrections to them stay small, so no maximum is taken out
        p += work.take("pairs", self.pairs, self.of[x.ravel()])
        np.exp(p, out=p)
        share = live.ravel() * np.float32(1 / max(live.sum(), 1))
        p *= (share / (p @ _ONES))[:, None]
        p.ravel()[np.arange(0, p.size, CLASSES) + y.ravel()] -= share
        dz = np.matmul(p, w["out"].T, out=work("dz", h, x.size, WIDTH))
        dmean = np.matmul(dz, w["value"].T, out=work("dmean", h, x.size, WIDTH))
        da = np.matmul(dmean.reshape(windows), h.transpose(0, 2, 1), out=work("da", h, *a.shape))
        value = mean.T @ dz
        # a row's mean of da under the attention is what its gradient makes of the mean
        mean *= dmean
        da -= (mean @ _WIDE).reshape(*x.shape, 1)
        da *= a
        dg = np.matmul(da, h, out=work("dg", h, *windows)).reshape(-1, WIDTH)
        dh, part = dz, work("part", h, x.size, WIDTH)
        dh += np.matmul(dg, self.between().T, out=part)
        for left, right in ((da, g), (a, dmean.reshape(windows))):
            np.matmul(left.transpose(0, 2, 1), right, out=part.reshape(windows))
            dh += part
        between = flat.T @ dg * _SCALE
        order, head, symbols = runs or symbol_runs(x)
        embed = np.zeros_like(w["embed"])
        embed[symbols] = np.add.reduceat(work.take("sorted", dh, order), head)
        return {"embed": embed, "place": dh.reshape(windows).sum(0), "query": between @ w["key"], "key": between.T @ w["query"], "value": value, "out": z.T @ p}

    def train(self, batches: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], single: np.ndarray, rate: float = 0.01) -> tuple[int, np.ndarray, np.ndarray]:
        """Adam over batches of windows, moving only embeddings that a batch has.

        The class pairs seen so far are the pair logs, brought up to date now and
        then.  Returns how many ids were scored, how often each symbol was seen,
        and the class pairs.
        """
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        seen, times, pairs = 0, np.zeros(len(self.of), np.int64), np.zeros((CLASSES + 1) * CLASSES)
        work = Work()
        for step, (x, y, live) in enumerate(batches, 1):
            seen += int(live.sum())
            order, head, used = symbol_runs(x)
            each, local = np.diff(np.append(head, x.size)), np.empty(x.size, np.int64)
            local[order] = np.repeat(np.arange(len(used)), each)
            times[used] += each
            some = Model(self.pairs, self.weights | {"embed": self.weights["embed"][used]}, self.of[used])
            pace = np.float32(rate / (1 + step / 200))
            for name, g in some.gradients(local.reshape(x.shape), y, live, work, (order, head, np.arange(len(used)))).items():
                at = used if name == "embed" else slice(None)
                m, v = (d[name].take(used, 0) if name == "embed" else d[name] for d in (first, second))
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                first[name][at], second[name][at] = m, v
                self.weights[name][at] -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
            pairs += np.bincount((self.of[x] * CLASSES + y)[live], minlength=len(pairs))
            if step & (step - 1) == 0 or step % 64 == 0:
                self.pairs = pair_logs(pairs.reshape(CLASSES + 1, CLASSES), single)
        return seen, times, pairs

    def common(self) -> np.ndarray:
        """All weights but the embeddings, in a row."""
        return np.concatenate([self.weights[k].ravel() for k in self.shapes() if k != "embed"])

    def unpack(self, embed: np.ndarray, flat: np.ndarray, pairs: np.ndarray) -> Model:
        at, out = 0, {"embed": embed.astype(np.float32)}
        for name, shape in self.shapes().items():
            if name != "embed":
                n = int(np.prod(shape))
                out[name] = flat[at : at + n].reshape(shape).astype(np.float32)
                at += n
        return Model(pairs, out, self.of)


def pair_logs(counts: np.ndarray, single: np.ndarray) -> np.ndarray:
    """Logs of class pairs, smoothed towards the share of single classes."""
    single = single + 0.5
    smooth = counts + 20.0 * single / single.sum()
    return np.log(smooth / smooth.sum(1, keepdims=True)).astype(np.float32)


_SCALE = np.float32(WIDTH**-0.5)
_ONES, _COLUMN, _WIDE = (np.ones(n, np.float32) for n in (CLASSES, WINDOW, WIDTH))
_CAUSAL = np.where(np.tril(np.ones((WINDOW, WINDOW), bool)), 0, -1e9).astype(np.float32)


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in order, a place of each, and which of them each place has."""
    coded = pc.dictionary_encode(pa.array(hashes))
    values, which = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    order = np.argsort(values)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    which, place = rank[which], np.empty(len(order), np.int64)
    place[which] = np.arange(len(which))
    return values[order], place, which


class Speller:
    """Ids of words; those of words that it has spelled are kept, told apart by hash."""

    def __init__(self, ranks: dict[bytes, int], opens: np.ndarray, most: int = 1 << 20):
        self.encode, self.opens, self.most = encoder(ranks), opens, most
        self.forget()

    def forget(self) -> None:
        self.hashes, self.starts, self.lengths, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def learn(self, words: list[bytes], hashes: np.ndarray) -> None:
        ids = np.array(self.encode(" " + b" ".join(words).decode("utf-8", "replace")), np.int32)
        starts = np.flatnonzero(self.opens[ids])
        place = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, place, hashes)
        self.starts = np.insert(self.starts, place, starts + len(self.ids))
        self.lengths = np.insert(self.lengths, place, np.diff(np.append(starts, len(ids))))
        self.ids = np.append(self.ids, ids)

    def spell(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each word, and all ids."""
        return self.spell_distinct(low, starts, ends, *distinct(hashes))

    def spell_distinct(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray, first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(which):
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        if len(self.hashes) > self.most:
            self.forget()
        place = np.searchsorted(self.hashes, words)
        new = np.ones(len(words), bool)
        inside = place < len(self.hashes)
        new[inside] = self.hashes[place[inside]] != words[inside]
        if new.any():
            raw = low.tobytes()
            self.learn([raw[s:e] for s, e in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)], words[new])
            place = np.searchsorted(self.hashes, words)
        lengths = self.lengths[place][which]
        edge = np.cumsum(lengths)
        return lengths, self.ids[np.repeat(self.starts[place][which] - edge + lengths, lengths) + np.arange(edge[-1])]


_spellers: dict[int, Speller] = {}


def speller(ranks: dict[bytes, int], opens: np.ndarray) -> Speller:
    """A worker's speller of the last vocabulary, with what its earlier tasks have spelled."""
    key = hash(tuple(ranks.items()))
    if key not in _spellers:
        _spellers.clear()
        _spellers[key] = Speller(ranks, opens)
    return _spellers[key]


def sequences(speller: Speller, buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Words' rows, distinct hashes, which of them each word has, and lengths in ids; all rows' ids with an end each, and offsets."""
    low = K.LOWER[buf]
    starts, ends, rows = K.word_spans(low, at)
    words, first, which = distinct(K.span_hashes(low, starts, ends))
    lengths, ids = speller.spell_distinct(low, starts, ends, words, first, which)
    n = len(at) - 1
    sizes = np.bincount(rows, weights=lengths, minlength=n).astype(np.int64)
    out = np.empty(len(ids) + n, np.int32)
    edge = np.cumsum(sizes + 1)
    is_end = np.zeros(len(out), bool)
    is_end[edge - 1] = True
    out[is_end] = END
    out[~is_end] = ids
    return rows, words, which, lengths, out, np.concatenate([[0], edge])


def windows(symbols: np.ndarray, offsets: np.ndarray, start: int = START, overlap: int = OVERLAP) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, targets, which targets count, and the row of each window.

    A window after a row's first counts only what the one before didn't.
    """
    sizes = np.diff(offsets)
    stride = WINDOW - overlap
    number = np.maximum(1, -(-(sizes - overlap) // stride))
    row = np.repeat(np.arange(len(sizes)), number)
    step = (np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)) * stride
    place = step[:, None] + np.arange(WINDOW)
    inside = place < sizes[row][:, None]
    before = np.concatenate([[start], symbols[:-1]]).astype(np.int32)
    before[offsets[:-1]] = start
    place += offsets[row][:, None]
    x, y = before.take(place, mode="clip"), symbols.astype(np.int32).take(place, mode="clip")
    x *= inside
    y *= inside
    live = inside & ((np.arange(WINDOW) >= overlap) | (step == 0)[:, None])
    return x, y, live, row


def score_windows(model: Model, x: np.ndarray, y: np.ndarray, live: np.ndarray, groups: np.ndarray, work: Work, tables: tuple[np.ndarray, np.ndarray], most: int = 128) -> tuple[np.ndarray, np.ndarray]:
    """Log probabilities as the model gives them, at live targets; what only serves as context is not scored."""
    out = tuple(np.zeros(x.shape, np.float32) for _ in range(2))
    later = ~live[:, :OVERLAP].any(1)
    for skip, at in ((0, np.flatnonzero(~later)), (OVERLAP, np.flatnonzero(later))):
        for lo in range(0, len(at), most):
            some = at[lo : lo + most]
            for whole, part in zip(out, model.log_probabilities(x[some], y[some], groups, work, skip, tables), strict=True):
                whole[some, skip:] = part
    return out


def count_words(docs: DataFrame) -> DataFrame:
    """word, its hash and its count over the given rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, at = K.text_column(batch.column("text"))
            for _, _, b, a in K.slices(buf, at, 8 << 20):
                low = K.LOWER[b]
                starts, ends, _ = K.word_spans(low, a)
                hashes, first, which = distinct(K.span_hashes(low, starts, ends))
                counts = np.bincount(which, minlength=len(hashes))
                raw = low.tobytes()
                words = [raw[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(hashes.view(np.int64)), pa.array(counts.astype(np.int64))], ["word", "hash", "count"])

    rows = docs.select("text").mapInArrow(run, "word binary, hash long, count long")
    return rows.groupBy("word", "hash").agg(F.sum("count").alias("count"))


def count_ids(words: DataFrame, ranks: dict[bytes, int], opens: np.ndarray) -> np.ndarray:
    """Corpus counts of each subword id, and of each as a word's first, from the word counts."""
    shared = words.sparkSession.sparkContext.broadcast((ranks, opens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, opens = shared.value
        encode, total = encoder(ranks), np.zeros((2, IDS))
        for batch in batches:
            if batch.num_rows:
                ids = np.array(encode(" " + b" ".join(batch.column("word").to_pylist()).decode("utf-8", "replace")), np.int64)
                head = opens[ids]
                counts = batch.column("count").to_numpy()
                each = counts[np.cumsum(head) - 1]
                total[0] += np.bincount(ids, weights=each, minlength=IDS)
                total[1] += np.bincount(ids[head], weights=counts, minlength=IDS)
        at = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(t[at]) for t in total)], ["at", "n", "first"])

    out, sums = np.zeros((2, IDS)), [F.sum(c).alias(c) for c in ("n", "first")]
    for row in words.select("word", "count").mapInArrow(run, "at long, n double, first double").groupBy("at").agg(*sums).collect():
        out[:, row["at"]] = row[1:]
    return out


def _each_slice(batches: Iterator[pa.RecordBatch], limit: int = 1 << 21):
    for batch in batches:
        buf, at = K.text_column(batch.column("text"))
        for lo, hi, b, a in K.slices(buf, at, limit):
            yield batch, lo, hi, b, a


def train_attention(docs: DataFrame, tools, start: Model, single: np.ndarray, shards: int, batch_windows: int = 128) -> Model:
    """Each shard trains on all its documents; weights are averaged by ids seen, an id's embedding by its own."""
    shared = docs.sparkSession.sparkContext.broadcast((start, single))
    names = ["seen", "used", "times", "embed", "rest", "pairs"]
    schema = "seen double, used binary, times binary, embed binary, rest binary, pairs binary"

    def packed(seen: float, times: np.ndarray, embed: np.ndarray, rest: np.ndarray, pairs: np.ndarray) -> pa.RecordBatch:
        used = np.flatnonzero(times)
        blobs = [used.astype(np.int32), times[used].astype(np.int64), embed[used].astype(np.float32), rest.astype(np.float64), pairs.astype(np.float64)]
        return pa.RecordBatch.from_arrays([pa.array([float(seen)]), *(pa.array([b.tobytes()], pa.binary()) for b in blobs)], names)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, (begin, single) = tools.value, shared.value
        spell = speller(given.ranks, given.opens)
        model = Model(begin.pairs, {k: v.copy() for k, v in begin.weights.items()}, begin.of)

        def stream():
            for _, _, _, b, a in _each_slice(batches):
                *_, ids, offsets = sequences(spell, b, a)
                x, y, live, _ = windows(ids, offsets, IDS, 0)
                order = np.random.default_rng(len(x)).permutation(len(x))
                for lo in range(0, len(x), batch_windows):
                    some = order[lo : lo + batch_windows]
                    yield x[some], model.of[y[some]], live[some]

        seen, times, pairs = model.train(stream(), single)
        if seen:
            yield packed(seen, times, model.weights["embed"], model.common(), pairs)

    def mean(rows) -> tuple[float, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        seen, times, embed, rest, pairs = 0.0, np.zeros(IDS + 1, np.int64), np.zeros((IDS + 1, WIDTH)), 0.0, 0.0
        for n, *blobs in rows:
            used, own, part, weights, counts = (np.frombuffer(b, t) for b, t in zip(blobs, (np.int32, np.int64, np.float32, np.float64, np.float64), strict=True))
            seen, rest, pairs = seen + n, rest + n * weights, pairs + counts
            times[used] += own
            embed[used] += own[:, None] * part.reshape(-1, WIDTH).astype(np.float64)
        return seen, times, embed / np.maximum(times, 1)[:, None], rest / max(seen, 1.0), pairs

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = mean(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        if found[0]:
            yield packed(*found)

    place = F.xxhash64("doc_id", "text")
    dealt = docs.repartition(shards, place).sortWithinPartitions(place, "doc_id", "text").select("text")
    rows = dealt.mapInArrow(learn, schema).repartition(8).mapInArrow(add, schema).collect()
    if not rows:
        return start
    _, times, embed, rest, pairs = mean(sorted(tuple(bytes(v) if k else v for k, v in enumerate(r)) for r in rows))
    return start.unpack(np.where(times[:, None] > 0, embed, start.weights["embed"]), rest, pair_logs(pairs.reshape(CLASSES + 1, CLASSES), single))


def frequent_words(words: DataFrame, head_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the words of the least count that at most `head_words` words reach, and their counts."""
    least, have = 1, 0
    for row in words.groupBy(F.least("count", F.lit(100_000)).alias("c")).agg(F.count("*").alias("n")).orderBy(F.desc("c")).collect():
        have += row["n"]
        if have > head_words:
            least = row["c"] + 1
            break
    top = words.where(F.col("count") >= least).select("hash", "count").toArrow()
    hashes = top.column("hash").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], top.column("count").to_numpy()[order]


def lm_scores(docs: DataFrame, folds: int = 7, held: int = 2, vocabulary: str = VOCABULARY, head_words: int = 500_000, shard_words: int = 2_000_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document row."""
    spark = docs.sparkSession
    texts = documents(docs)
    held_out = F.coalesce(id_crc("doc_id", folds) == held, F.lit(False))
    teaching = texts.where(~held_out)
    words = written(count_words(teaching), "word-counts")
    n_docs = teaching.count()
    row = words.agg(F.count("*"), F.coalesce(F.sum("count"), F.lit(0)), F.count_if(F.col("count") == 1)).first()
    distinct, total = row[0] + (n_docs > 0), row[1] + n_docs
    escape = min(max(row[2] / max(row[1], 1), 0.001), 0.5)

    ranks = read_ranks(vocabulary)
    opens = opening(ranks)
    ids, firsts = count_ids(words, ranks, opens)
    ids[END] = firsts[END] = n_docs
    classes, within = id_classes(ids, opens)
    tools = spark.sparkContext.broadcast(Tools(ranks, opens, classes, within))
    single = np.bincount(classes, weights=ids, minlength=CLASSES)
    model = train_attention(teaching, tools, Model.start(single, np.append(classes, START)), single, 1 + int(total // shard_words))
    class_words = np.bincount(classes, weights=firsts, minlength=CLASSES)

    hashes, counts = frequent_words(words, head_words)
    head = spark.sparkContext.broadcast((hashes, counts, model, class_words, len(hashes) + (n_docs > 0) == distinct))
    end_log = float(np.log10(n_docs + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = tools.value
        words_of, work = speller(given.ranks, given.opens), Work()
        hashes, counts, model, class_words, all_known = head.value
        tables = model.tables()
        groups = np.stack([np.ones(CLASSES), given.starting()], 1).astype(np.float32)
        log_class = np.log(np.maximum(class_words, 1.0))
        with np.errstate(divide="ignore"):
            log_count, log_base = np.log(np.append(counts, 0)), np.log10(np.append(counts, 0) + 1.0)
        for batch, lo, hi, b, a in _each_slice(batches):
            rows, words_, which, lengths, spelled, offsets = sequences(words_of, b, a)
            n = hi - lo
            x, y, live, _ = windows(spelled, offsets, IDS)
            own, opening_mass = (m[live].astype(np.float64) for m in score_windows(model, x, model.of[y], live, groups, work, tables))  # every id once, in order
            last = offsets[1:] - 1
            end_score = own[last] - opening_mass[last]
            is_word = np.ones(len(own), bool)
            is_word[last] = False
            begins = np.flatnonzero(is_word)[np.cumsum(lengths) - lengths]  # a word's first id
            first_class = given.classes[spelled[begins]]
            first = own[begins] - opening_mass[begins]
            inner = np.where(is_word, own, 0.0)
            inner[begins] = 0.0
            shares = np.where(is_word, given.within[spelled], 0.0)
            spell = (np.add.reduceat((inner + shares)[is_word], np.cumsum(lengths) - lengths) if len(lengths) else np.zeros(0)) + opening_mass[begins + lengths] if len(lengths) else np.zeros(0)
            place = np.minimum(np.searchsorted(hashes, words_), max(len(hashes) - 1, 0))
            known = hashes[place] == words_ if len(hashes) else np.zeros(len(words_), bool)
            place = np.where(known, place, len(counts))[which]
            known, words_ = known[which], words_[which]
            base = np.bincount(rows, weights=log_base[place], minlength=n) + end_log
            spell += np.log(escape)
            share = np.log(1 - escape) + log_count[place] - log_class[first_class]
            score = np.bincount(rows, weights=first + np.logaddexp(spell, share), minlength=n) + end_score
            n_words = np.bincount(rows, minlength=n)
            n_known = np.bincount(rows, weights=known, minlength=n).astype(np.int64) + (n_docs > 0)
            # words beyond the head meet their counts later: the log of what one count adds against the spelling
            rare = np.flatnonzero(~known) if not all_known else np.zeros(0, np.int64)
            lead = np.log(1 - escape) - log_class[first_class[rare]] - spell[rare]
            edges = pa.array(np.searchsorted(rows[rare], np.arange(n + 1)), pa.int32())
            key = K.mix(np.add.reduceat(np.append(words_ * (np.arange(len(words_), dtype=np.uint64) | np.uint64(1)), np.uint64(0)), np.minimum(np.searchsorted(rows, np.arange(n)), len(words_))) if n else words_[:0])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(lo, n), pa.array(key.view(np.int64)), pa.array((n_words + 1).astype(np.int64)), pa.array(n_known), pa.array(base), pa.array(score / np.log(10)),
                    pa.ListArray.from_arrays(edges, pa.array(words_[rare].view(np.int64))), pa.ListArray.from_arrays(edges, pa.array(lead)),
                ],
                ["doc_id", "text_key", "n_tokens", "n_known", "base", "score", "rare", "lead"],
            )

    scored = written(texts.mapInArrow(run, "doc_id long, text_key long, n_tokens long, n_known long, base double, score double, rare array<long>, lead array<double>"), "scores")
    rare = scored.where(F.size("rare") > 0).select("doc_id", "text_key", F.explode(F.arrays_zip("rare", "lead")).alias("w")).select("doc_id", "text_key", F.col("w.rare").alias("hash"), F.col("w.lead").alias("lead"))
    over = F.col("lead") + F.log("count")
    adds = F.greatest(over, F.lit(0.0)) + F.log1p(F.exp(-F.abs(over)))
    met = rare.join(words.select("hash", "count"), "hash").withColumn("adds", adds)
    more = met.groupBy("doc_id", "text_key").agg(F.count("*").alias("more_known"), F.sum(F.log10(F.col("count") + 1.0)).alias("more_base"), F.sum("adds").alias("more_score"))
    # rows that repeat an id and its text have added up
    copies = scored.groupBy("doc_id", "text_key").agg(F.count("*").alias("copies"))
    more = more.join(copies, more["doc_id"].eqNullSafe(copies["doc_id"]) & (more["text_key"] == copies["text_key"])).select(more["doc_id"].alias("_of"), more["text_key"].alias("_key"), (F.col("more_known") / F.col("copies")).cast("long").alias("more_known"), (F.col("more_base") / F.col("copies")).alias("more_base"), (F.col("more_score") / F.col("copies")).alias("more_score"))
    out = scored.join(more, scored["doc_id"].eqNullSafe(more["_of"]) & (scored["text_key"] == more["_key"]), "left")
    scale = float(np.log10(total + distinct + 1))
    return out.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n_tokens") * F.lit(scale)).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0)) / F.lit(float(np.log(10)))).alias("score"),
    )
