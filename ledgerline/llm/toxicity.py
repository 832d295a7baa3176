"""Toxicity by compression distance: one zstandard dictionary for each class.

Both dictionaries share a base that zstandard trains on all windows of the
ordinary teaching texts.  To it each adds, from its own class's teaching texts, the
words that mark the class: those whose share of the class's documents stands out
from their share of the other's.  (Dictionaries that zstandard trains on each
class's texts alone pick what is common in any text: they differ by chance, and
tell classes apart hardly better than by chance.)  A window that
compresses better with the toxic dictionary leans to toxic.  A document's
evidence is made of the bytes saved in each of its windows; a logistic curve
fitted on other teaching rows turns it into a score, and the threshold is on it.

Only rows with crc32(doc_id) mod `folds` other than `held` teach anything, and
of those at most `bound`, chosen by a hash of the id.  Ids, labels, languages
and sources are never inputs of a score.

Defined results: null and empty texts have one empty window and get the curve's
value for it; without both classes in the labels every score is 0; if all texts of
a class repeat the other's, nothing marks a class and the curve is near its share;
repeated rows and extra columns pass row by row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, id_crc

WINDOW = 200
LEVEL = 3
#: Bytes of trained content that both dictionaries share, and about those of a trained dictionary's header.
BASE_BYTES, HEADER = 15_000, 2_000


def windows(text: bytes, size: int = WINDOW) -> list[bytes]:
    """The whole text in pieces of about `size` bytes, cut after white space."""
    out, lo = [], 0
    while lo < len(text):
        hi = lo + size
        if hi < len(text):
            cut = max(text.rfind(b" ", lo, hi), text.rfind(b"\n", lo, hi))
            hi = cut + 1 if cut > lo else hi
        out.append(text[lo:hi])
        lo = hi
    return out


def lowered(text: bytes) -> bytes:
    return b" " + text.lower().replace(b"\n", b" ") + b" "


def fresh_texts(texts: list[tuple[int, bytes]], most: float = 0.3) -> list[tuple[int, bytes]]:
    """Leaves out texts that mostly repeat earlier ones, so that copies don't mark their words."""
    seen: set[int] = set()
    out = []
    for y, text in texts:
        words = lowered(text).split()
        own = {hash(tuple(words[i : i + 3])) for i in range(max(len(words) - 2, 1))}
        if len(own & seen) <= most * len(own):
            out.append((y, text))
        seen |= own
    return out


def marking_words(texts: list[tuple[int, bytes]], side: int, least: float = 0.02, sigmas: float = 6.0) -> list[bytes]:
    """Words of one class whose document share exceeds the other class's by many standard errors, rarest first."""
    seen, n = (Counter(), Counter()), [0, 0]
    for y, text in texts:
        seen[y].update(set(lowered(text).split()))
        n[y] += 1
    out = {}
    if not all(n):
        return []
    for word, count in seen[side].items():
        own, other = count / n[side], seen[1 - side][word] / n[1 - side]
        pool = (seen[0][word] + seen[1][word] + 1) / (n[0] + n[1] + 2)
        if len(word) > 3 and own > least and own - other > sigmas * np.sqrt(pool * (1 - pool) * (1 / n[0] + 1 / n[1])):
            out[word] = count
    return sorted(out, key=lambda w: (out[w], w))


def train_base(ordinary: list[bytes]) -> bytes:
    """What zstandard's trainer picks from all windows of the ordinary texts; their windows themselves where they are too few to train on."""
    pieces = [w for t in ordinary for w in windows(t)]
    try:
        return zstandard.train_dictionary(BASE_BYTES + HEADER, pieces).as_bytes()[-BASE_BYTES:]
    except zstandard.ZstdError:
        return b" ".join(pieces)[:BASE_BYTES]


def train_dictionaries(texts: list[tuple[int, bytes]]) -> tuple[bytes, bytes]:
    """Contents of the toxic and of the ordinary dictionary."""
    base = train_base([lowered(t) for y, t in texts if y == 0])
    # zstandard's offsets are cheapest for the dictionary's end
    toxic, plain = (base + b" " + b"  ".join(marking_words(texts, side)) + b" " for side in (1, 0))
    return toxic, plain


class Distance:
    """Compressed lengths of windows under both dictionaries."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.raw = (toxic, ordinary)
        self.sides: list[zstandard.ZstdCompressor] = []

    def __reduce__(self):  # compressors are made anew in each process
        return Distance, self.raw

    def open(self) -> Distance:
        if not self.sides:
            params = zstandard.ZstdCompressionParameters.from_level(LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_dict_id=0, min_match=3, strategy=zstandard.STRATEGY_BTULTRA)
            for raw in self.raw:
                dictionary = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                dictionary.precompute_compress(compression_params=params)
                self.sides.append(zstandard.ZstdCompressor(compression_params=params, dict_data=dictionary))
        return self

    def evidence(self, text: bytes) -> np.ndarray:
        """What the toxic side saves: mean, most, parts of windows that save 2 and 4 bytes, log windows, savings alone and net."""
        toxic, ordinary = (c.compress for c in self.open().sides)
        saved = np.array([len(ordinary(w)) - len(toxic(w)) for w in windows(lowered(text))], float)
        gain, root = np.maximum(saved, 0), np.sqrt(len(saved))
        return np.array([saved.mean(), saved.max(), (saved >= 2).mean(), (saved >= 4).mean(), np.log1p(len(saved)), gain.sum() / root, gain.mean(), saved.sum() / root])


SCALES = np.array([4, 8, 1, 1, 4, 8, 4, 8], float)


def _design(x: np.ndarray) -> np.ndarray:
    return np.hstack([x / SCALES, x[:, :1] * x[:, 1:2] / 32, x[:, 2:3] * x[:, 4:5] / 4, np.ones((len(x), 1))])


def fit_curve(x: np.ndarray, y: np.ndarray, rounds: int = 60, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression by Newton steps."""
    a = _design(x)
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p) + 1e-6)[:, None]).T @ a + ridge * np.eye(len(w)), a.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def curve(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_design(x) @ w, -30, 30)))


def teaching_rows(docs: DataFrame, labels: DataFrame, bound: int, folds: int, held: int, most_bytes: int) -> DataFrame:
    """Labelled texts that may teach, none over `most_bytes`; `part` is 0 for the dictionaries and 1 for the curve.

    The dictionaries get at most half of `bound` of each class, the curve at
    most `bound` rows in their natural shares.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (id_crc("doc_id", folds) != held)).distinct()
    known = known.withColumn("part", F.floor(F.crc32(F.col("doc_id").cast("string").cast("binary")) / folds) % 2)
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("toxic")]
    some = known.where("part = 1").orderBy(*order).limit(bound)
    for side in (0, 1):
        some = some.unionByName(known.where(f"part = 0 and toxic = {side}").orderBy(*order).limit(bound // 2))
    return documents(docs).where(F.octet_length("text") <= most_bytes).join(F.broadcast(some), "doc_id")


def score_toxicity(docs: DataFrame, labels: DataFrame, bound: int = 8000, folds: int = 4, held: int = 2, threshold: float = 0.3, most_bytes: int = 20_000) -> DataFrame:
    """doc_id, held_out, score, predicted for every document row; `bound` is the most rows that fit the curve."""
    rows = sorted((r["doc_id"], r["toxic"], r["text"].encode(), r["part"]) for r in teaching_rows(docs, labels, bound, folds, held, most_bytes).collect())
    first, second = ([(y, t) for _, y, t, part in rows if part == k] for k in (0, 1))
    distance, w = None, None
    if all(len({y for y, _ in part}) == 2 for part in (first, second)):
        distance = Distance(*train_dictionaries(fresh_texts(first)))
        w = fit_curve(np.array([distance.evidence(t) for _, t in second]), np.array([y for y, _ in second], float))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            if distance is None:
                score = np.zeros(len(texts))
            else:
                x = np.array([distance.evidence((t.as_py() or "").encode()) for t in texts]).reshape(-1, len(SCALES))
                score = curve(w, x)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    out = documents(docs).mapInArrow(scored, "doc_id long, score double")
    held_out = F.coalesce(id_crc("doc_id", folds) == held, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
