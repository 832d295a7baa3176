"""Line dedup: content-defined chunks of lines, repeated chunks removed.

A rolling hash over line hashes sets the boundaries: a chunk ends after a line
where the hash of the last two lines falls on a fixed residue, so the same lines
give the same chunks wherever they stand.  A chunk of several lines that stands
earlier too (smaller doc_id, or earlier in the same document) is removed once
its bytes equal the first one's.

With `runs`, chunks are cut by the same rolling hash, blank lines aside and without
white space at the ends of lines, and share the line at their border, so every two
lines next to each other (a pair) lie in one chunk.  Chunks that stand earlier go
as a whole.  What a chunk can't tell, a repeat that starts or ends within it, an
exact pass over the pairs of each chunk's first place adds: the first place of a
pair lies in the first place of a chunk.  So all repeated runs of two lines or more
go, each grown to its last line; the first place of a line always stays.  One line
over and over leaves its first.

Counts are summed by chunk hash before any rows meet, so a chunk that very many
documents share is one row for each task.  Rows of such a chunk meet only its
first occurrence, in a join that Spark may split.  Chunks next to each other that
repeat chunks next to each other of one document are a stretch: its first place's
bytes travel once to the later one, which compares them with its own.

Defined results: null and empty texts have no lines and stay as they are; blank
lines belong to the chunk around them; different texts of one id are documents of
their own, and equal rows count as one;
one-line chunks are never removed; a null id takes no part; all columns are
kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, only_ids, written

EVERY, LEAST, MOST = 3, 2, 32


def _cuts(before: int, own: int) -> bool:
    """Whether the rolling hash of two lines' hashes sets a boundary."""
    rolled = ((before * 0x9E3779B97F4A7C15) ^ own) & 0xFFFFFFFFFFFFFFFF
    return (rolled >> 17) % EVERY == 0


def chunks(text: bytes) -> list[tuple[int, int, int]]:
    """(start byte, end byte, lines) of the chunks of a text, which cover it."""
    out, start, end, lines, before = [], 0, 0, 0, 0
    for line in _lines(text):
        end += len(line)
        lines += 1
        own = xxhash.xxh3_64_intdigest(line.strip())
        cut = _cuts(before, own)
        before = own
        if lines >= MOST or lines >= LEAST and cut:
            out.append((start, end, lines))
            start, lines = end, 0
    if lines:
        out.append((start, end, lines))
    return out


def _lines(text: bytes) -> list[bytes]:
    pieces = text.split(b"\n")
    return [p + b"\n" for p in pieces[:-1]] + ([pieces[-1]] if pieces[-1] else [])


def line_pairs(text: bytes) -> list[tuple[int, int, bytes]]:
    """(start byte, end byte, bytes compared) of every two lines next to each other, blank lines aside."""
    at, spans = 0, []
    for line in _lines(text):
        if own := line.strip():
            spans.append((at, at + len(line), own))
        at += len(line)
    return [(a[0], b[1], a[2] + b"\n" + b[2]) for a, b in zip(spans[:-1], spans[1:], strict=True)]


def pair_chunks(text: bytes) -> list[tuple[int, int, list[int]]]:
    """(first pair, hash of the chunk's lines, hashes of its pairs) of the chunks by rolling hash; each pair is in one."""
    lines = [own for line in _lines(text) if (own := line.strip())]
    hashes, out, first = [xxhash.xxh3_64_intdigest(x) for x in lines], [], 0
    for k in range(len(lines) - 1):
        if k + 1 - first >= MOST or k == len(lines) - 2 or _cuts(hashes[k], hashes[k + 1]):
            pairs = [xxhash.xxh3_64_intdigest(a + b"\n" + b) - (1 << 63) for a, b in zip(lines[first : k + 1], lines[first + 1 : k + 2], strict=True)]
            out.append((first, xxhash.xxh3_64_intdigest(b"\n".join(lines[first : k + 2])) - (1 << 63), pairs))
            first = k + 1
    return out


def _repeatable(text: bytes, runs: bool) -> Iterator[tuple[int, int, int, bytes]]:
    """(place, lines, hash, bytes) of the chunks of several lines, or of all pairs of lines."""
    if runs:
        yield from ((k, 2, xxhash.xxh3_64_intdigest(piece) - (1 << 63), piece) for k, (_, _, piece) in enumerate(line_pairs(text)))
        return
    for k, (s, e, lines) in enumerate(chunks(text)):
        piece = text[s:e].strip()
        if lines >= LEAST and piece:
            yield k, lines, xxhash.xxh3_64_intdigest(piece) - (1 << 63), piece


def _hashed(batches: Iterator[pa.RecordBatch], runs: bool) -> Iterator[pa.RecordBatch]:
    """Chunks with the hashes of their pairs; without `runs`, there are none and a chunk is one unit."""
    for batch in batches:
        rows = []
        for *own, text in zip(*_keys(batch), batch.column("text"), strict=True):
            raw = (text.as_py() or "").encode()
            rows += [(*own, k, len(pairs), h, pairs) for k, h, pairs in pair_chunks(raw)] if runs else [(*own, k, 1, h, []) for k, _, h, _ in _repeatable(raw, False)]
        yield _batch(rows, LIGHT)


#: A document is told by its id and a hash of its text.
LIGHT = "doc_id long, part long, at int, size int, hash long, pairs array<long>"
STRETCHES = "doc_id long, part long, at int, size int, of long, of_part long, of_at int"
FIRSTS = "of long, of_part long, of_at int, size int, bytes binary"
GONE = "doc_id long, part long, gone array<int>"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}


def _keys(batch: pa.RecordBatch) -> tuple[list, list]:
    return batch.column("doc_id").to_pylist(), batch.column("part").to_pylist()


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], [name for name, _ in fields])


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks or pairs that follow each other and repeat such of one document that follow each other, joined."""
    for batch in batches:
        out = []
        for doc, part, listed in zip(*_keys(batch), batch.column("listed").to_pylist(), strict=True):
            open_ = None
            for at, size, *of, of_at in sorted((x["at"], x["size"], x["of"], x["of_part"], x["of_at"]) for x in listed):
                if open_ and [at, *of, of_at] == [open_[0] + open_[1], *open_[2:4], open_[4] + open_[1]]:
                    open_[1] += size
                else:
                    open_ = [at, size, *of, of_at]
                    out.append((doc, part, open_))
        yield _batch([(doc, part, *x) for doc, part, x in out], STRETCHES)


def _joined(pieces: dict[int, bytes], at: int, size: int, runs: bool) -> bytes:
    """The bytes of a stretch; two pairs of lines that follow each other share a line."""
    if not runs:
        return b"\n".join(pieces[k] for k in range(at, at + size))
    return b"\n".join([pieces[at], *(pieces[k].split(b"\n", 1)[1] for k in range(at + 1, at + size))])


def _first_bytes(batches: Iterator[pa.RecordBatch], runs: bool) -> Iterator[pa.RecordBatch]:
    """Bytes of the listed stretches of first places."""
    for batch in batches:
        rows = []
        for *own, text, listed in zip(*_keys(batch), batch.column("text"), batch.column("listed").to_pylist(), strict=True):
            pieces = {k: piece for k, _, _, piece in _repeatable((text.as_py() or "").encode(), runs)}
            rows += [(*own, x["of_at"], x["size"], _joined(pieces, x["of_at"], x["size"], runs)) for x in listed]
        yield _batch(rows, FIRSTS)


def _same_bytes(batches: Iterator[pa.RecordBatch], runs: bool) -> Iterator[pa.RecordBatch]:
    """Places of the stretches whose bytes are those of the first place; of others, the chunks that differ stay."""
    for batch in batches:
        gone = []
        for text, listed in zip(batch.column("text"), batch.column("listed").to_pylist(), strict=True):
            pieces, places = {k: piece for k, _, _, piece in _repeatable((text.as_py() or "").encode(), runs)}, set()
            for x in listed:
                at, size = x["at"], x["size"]
                if _joined(pieces, at, size, runs) == x["bytes"]:
                    places |= set(range(at, at + size))
                elif runs:  # a collision of hashes: line by line
                    lines = x["bytes"].split(b"\n")
                    places |= {at + k for k in range(size) if lines[k : k + 2] == pieces[at + k].split(b"\n")}
            gone.append(sorted(places))
        yield _batch(list(zip(*_keys(batch), gone, strict=True)), GONE)


def repeated_units(light: DataFrame) -> DataFrame:
    """Chunks or pairs whose hash stands earlier too, with its first place."""
    place = F.struct("doc_id", "part", "at")
    first = light.groupBy("hash").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    return light.join(first, "hash").where(place != F.col("first"))


def first_pairs(light: DataFrame) -> DataFrame:
    """The pairs of each chunk's first place, and of no other."""
    least = F.min(F.struct("doc_id", "part", "at", "pairs")).alias("c")
    pairs = written(light.groupBy("hash").agg(least).select("c.*"), "first-chunks").select("doc_id", "part", "at", F.posexplode("pairs").alias("k", "hash"))
    return pairs.select("doc_id", "part", (F.col("at") + F.col("k")).alias("at"), F.lit(1).alias("size"), "hash")


def repeated_chunks(docs: DataFrame, runs: bool = False) -> DataFrame:
    """doc_id, a hash of the text, and the places (array) of the chunks (or pairs of lines) to remove.

    Hashes of all chunks meet first; bytes travel once for each stretch that repeats.
    """
    texts = documents(docs).where("doc_id is not null").withColumn("part", F.xxhash64("text"))
    light = texts.mapInArrow(partial(_hashed, runs=runs), LIGHT)
    later = repeated_units(light.drop("pairs"))
    if runs:
        later = later.unionByName(repeated_units(first_pairs(light)))
    of = F.struct("at", "size", F.col("first.doc_id").alias("of"), F.col("first.part").alias("of_part"), F.col("first.at").alias("of_at"))
    stretches = written(later.groupBy("doc_id", "part").agg(F.collect_set(of).alias("listed")).mapInArrow(_stretches, STRETCHES), "repeated-stretches")
    firsts = stretches.select("of", "of_part", "of_at", "size").distinct().groupBy(F.col("of").alias("doc_id"), F.col("of_part").alias("part")).agg(F.collect_list(F.struct("of_at", "size")).alias("listed"))
    firsts = written(firsts, "first-stretches")
    own = ["doc_id", "part"]
    content = only_ids(texts, firsts.select("doc_id")).join(firsts.hint("merge"), own).mapInArrow(partial(_first_bytes, runs=runs), FIRSTS)
    given = stretches.join(content, ["of", "of_part", "of_at", "size"]).groupBy(*own).agg(F.collect_list(F.struct("at", "size", "bytes")).alias("listed"))
    some = only_ids(texts, written(stretches.select("doc_id").distinct(), "repeating-ids")).join(given.hint("merge"), own)
    same = some.mapInArrow(partial(_same_bytes, runs=runs), GONE)
    return same.where(F.size("gone") > 0).groupBy(*own).agg(F.first("gone").alias("gone"))


def without_pairs(raw: bytes, gone: set[int]) -> tuple[bytes, int]:
    """The text without the lines of the listed pairs, and how many lines went."""
    spans = [(s, e) for k, (s, e, _) in enumerate(line_pairs(raw)) if k in gone]
    kept, removed, at, k = [], 0, 0, 0
    for line in _lines(raw):
        while k < len(spans) and spans[k][1] <= at:
            k += 1
        if k < len(spans) and spans[k][0] <= at:
            removed += 1
        else:
            kept.append(line)
        at += len(line)
    return b"".join(kept), removed


def _rebuilt(batches: Iterator[pa.RecordBatch], runs: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, lines, removed = [], [], []
        for text, gone in zip(batch.column("text"), batch.column("gone").to_pylist(), strict=True):
            raw = (text.as_py() or "").encode()
            if runs:
                left, n = without_pairs(raw, set(gone)) if gone else (raw, 0)
                lines.append(len(_lines(raw)))
                removed.append(n)
                texts.append(left.decode() if gone else text.as_py())
                continue
            parts, drop = chunks(raw), set(gone or ())
            lines.append(sum(n for _, _, n in parts))
            removed.append(sum(n for k, (_, _, n) in enumerate(parts) if k in drop))
            texts.append(text.as_py() if not drop else b"".join(raw[s:e] for k, (s, e, _) in enumerate(parts) if k not in drop).decode())
        yield pa.RecordBatch.from_arrays([batch.column("others"), pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(removed, pa.int64())], ["others", "text", "n_lines", "n_removed"])


def line_dedup(docs: DataFrame, runs: bool = False, counts: bool = True) -> DataFrame:
    """The documents with repeated chunks (or runs of lines) cut from their texts.

    With `counts`, n_lines and n_removed follow, and columns of the documents with
    those names give way; without, all columns are those of the documents.  Texts
    that lose nothing stay where they are read.
    """
    gone = written(repeated_chunks(docs, runs), "gone-chunks")
    names = [c for c in docs.columns if c != "text" and not (counts and c in ("n_lines", "n_removed"))]
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("part"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("others"))
    ids = written(gone.select("doc_id").distinct(), "cut-ids")
    cut = only_ids(own, ids).join(gone.hint("merge"), ["doc_id", "part"], "left")
    whole = only_ids(own, ids, "left_anti").withColumn("gone", F.lit(None).cast("array<int>"))
    schema = T.StructType([own.schema["others"], T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())])
    rebuilt = partial(_rebuilt, runs=runs)
    out = cut.select("others", "text", "gone").mapInArrow(rebuilt, schema).unionByName(whole.select("others", "text", "gone").mapInArrow(rebuilt, schema))
    kept = [F.col("text") if c == "text" else F.col("others")[c].alias(c) for c in docs.columns if c == "text" or c in names]
    return out.select(*kept, *(["n_lines", "n_removed"] if counts else []))
