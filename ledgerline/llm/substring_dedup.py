"""Substring dedup over words, with a log-structured fingerprint index.

The index is a list of immutable runs in a folder, with a manifest that names them;
whoever opens the folder later goes on where it stands.  A run has the
fingerprints (gram, hash of its surroundings, doc_id, place) of one batch of documents
that no earlier run has.  It lies in buckets of the gram, each in order of gram and
surroundings, so a new batch's grams meet the runs in a merge join for which no
row of the index moves and none is sorted again.  Only the fingerprints whose
gram the batch has go on to meet the batch's own: equal surroundings are repeats,
and where one gram has different surroundings, the windows themselves are compared by
two independent 64-bit hashes of their words, read again from the texts.  More
than `fan_in` runs are compacted into one, bucket by bucket.

Batches come in order of doc_id, so what a run holds stands earlier than what a
later batch brings.

Defined results: null and empty texts have no words; texts under 20 words lose
nothing; rows that repeat an id and its text count as one document, different texts
of one id are documents of their own, and those without an id come before all
others, by a hash of their texts; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import versions as V
from . import repeats as R
from .common import forget, shared_folder, written

UNITS = R.Units("words", 20, 8)
#: With it, a bucket of one file is known to be in order.
IN_ORDER = "spark.sql.legacy.bucketedTableScan.outputOrdering"


@contextmanager
def _stored_order(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(IN_ORDER)
    spark.conf.set(IN_ORDER, "true")
    try:
        yield
    finally:
        spark.conf.set(IN_ORDER, before)


class FingerprintIndex:
    """Sorted immutable runs of fingerprints in a shared folder, and the manifest that names them.

    The number of buckets is set when the folder is new, by default as many as
    there are shuffle partitions.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, fan_in: int = 4, buckets: int | None = None):
        self.spark, self.fan_in = spark, fan_in
        self.folder = folder or f"{shared_folder(spark)}/fingerprints-{uuid.uuid4().hex}"
        self.version = V.current(spark, self.folder)
        self.buckets = self.version.buckets if self.version else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    @property
    def runs(self) -> list[str]:
        return self.version.folders[""] if self.version else []

    def _next(self, runs: list[str]) -> None:
        """Makes the runs the index; another writer's version is an error, as batches have an order."""
        number = self.version.number + 1 if self.version else 0
        self.version = V.publish(self.spark, self.folder, V.Version(number, self.rows().schema.json(), {"": runs}, ["gram"], self.buckets))

    def _run(self, folder: str) -> DataFrame:
        """A run as the bucketed table it is."""
        name = f"fingerprints_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{c.split()[0]}` {c.split()[1].replace('long', 'bigint')}" for c in R.PLACES.split(", ") if not c.startswith("kind"))
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (gram) SORTED BY (gram, around) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{folder}'")
        rows = self.spark.table(name).select(F.lit(R.HEAD).alias("kind"), "gram", "around", "doc_id", "at")
        self.spark.sql(f"DROP TABLE {name}")  # the files stay
        return rows

    def _write(self, rows: DataFrame) -> str:
        """Writes rows that lie by bucket of gram; the folder, with a part for each kind."""
        name, folder = f"fingerprints_{uuid.uuid4().hex}", f"data/{uuid.uuid4().hex}"
        rows.write.format("parquet").option("path", f"{self.folder}/{folder}").partitionBy("kind").bucketBy(self.buckets, "gram").sortBy("gram", "around").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")
        return folder

    def _has(self, folder: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{folder}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def rows(self) -> DataFrame:
        """All fingerprints; no two have one gram and surroundings."""
        out = self.spark.createDataFrame([], R.PLACES)
        for k, folder in enumerate(self.runs):
            out = self._run(folder) if k == 0 else out.unionByName(self._run(folder))
        return out

    def known(self, grams: DataFrame) -> DataFrame:
        """The fingerprints whose gram is among `grams`: a merge join with each run where it lies."""
        asked = grams.repartition(self.buckets, "gram")
        out = None
        for folder in self.runs:
            met = self._run(folder).join(asked.hint("merge"), "gram", "left_semi").select("kind", "gram", "around", "doc_id", "at")
            out = met if out is None else out.unionByName(met)
        return out

    def merge(self, batch: DataFrame, least: int) -> DataFrame:
        """Merges a batch whose ids start at `least`; adds its run and returns what repeats and what to compare."""
        rows = R.anchor_rows(batch, UNITS)
        temporary = []
        if self.runs:
            rows = written(rows, "batch-fingerprints")
            with _stored_order(self.spark):
                known = written(self.known(rows.where(F.col("kind") != R.LATER).select("gram")), "known-fingerprints")
            temporary = [rows, known]
            rows = known.withColumn("kind", F.lit(R.FIRST)).unionByName(rows)
        met = R.meet(rows, heads=True, buckets=self.buckets)
        folder = self._write(met.where((F.col("kind") != R.HEAD) | (F.col("doc_id") >= least)))
        forget(*temporary)
        if self._has(f"{folder}/kind={R.HEAD}"):
            self._next([*self.runs, f"{folder}/kind={R.HEAD}"])
        # what repeats is no part of the index, but lies beside the run
        parts = [self.spark.read.schema(R.PLACES).parquet(f"{self.folder}/{folder}/kind={k}").withColumn("kind", F.lit(k)) for k in (R.LATER, R.FIRST) if self._has(f"{folder}/kind={k}")]
        out = self.spark.createDataFrame([], R.PLACES)
        for k, part in enumerate(parts):
            out = part if k == 0 else out.unionByName(part)
        return out

    def compact(self) -> None:
        """Merges the runs into one where there are more than `fan_in`, and clears what no run is part of."""
        if len(self.runs) <= self.fan_in:
            return
        with _stored_order(self.spark):
            folder = self._write(self.rows().repartition(self.buckets, "gram").sortWithinPartitions("gram", "around"))
        self._next([f"{folder}/kind={R.HEAD}"])
        V.expire(self.spark, self.folder, keep=1, grace=0)


def repeated_ranges(batch: DataFrame, archive: DataFrame, index: FingerprintIndex, least: int) -> DataFrame:
    """(doc_id, first, last): window starts of the batch whose words stand earlier in it or in the index.

    Batch and archive are `numbered` rows.  The result is a written table: the index may
    be compacted, and its folders go, before it is read.
    """
    places = index.merge(batch, least)
    later = R.as_ranges(places.where(F.col("kind") == R.LATER))
    firsts = places.where(F.col("kind") == R.FIRST)
    open_grams = firsts.where(F.col("doc_id") >= least).select("gram").distinct()
    firsts = firsts.join(open_grams, "gram", "left_semi")
    windows = R.surroundings(archive, firsts, R.window_rows(UNITS), R.WINDOWS)
    single = R.later_windows(windows).where(F.col("doc_id") >= least)
    return written(later.unionByName(single.select("doc_id", F.col("start").alias("first"), F.col("start").alias("last"))), "repeated-ranges")


def _digest(text: bytes, gone) -> tuple[int, int, str]:
    words, removed = text.split(), 0
    n = len(words)
    if gone is not None:
        mask = R.removed_units(gone, UNITS.window, n)
        removed = int(mask.sum())
        words = [w for w, out in zip(words, mask.tolist(), strict=True) if not out]
    return n, removed, hashlib.sha256(b" ".join(words)).hexdigest()


def substring_dedup(docs: DataFrame, batches: int = 3, index: FingerprintIndex | None = None, archive: DataFrame | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document row, ingested in `batches` ranges of ids.

    With an index that has runs, `archive` has the documents that made them, all of lesser ids.
    """
    index = index or FingerprintIndex(docs.sparkSession, fan_in=2)
    texts = R.numbered(docs)
    known = texts if archive is None else R.numbered(archive).unionByName(texts)
    shares = [k / batches for k in range(1, batches)] or [0.5]
    low, inner, high = texts.agg(F.min("doc_id"), F.percentile_approx("doc_id", shares), F.max("doc_id")).first()
    edges = [low, *inner[: batches - 1], high] if low is not None else [0] * (batches + 1)
    gone = None
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b > a or a == edges[0]:
            batch = texts.where((F.col("doc_id") >= a) & ((F.col("doc_id") < b) | F.lit(b == edges[-1])))
            found = repeated_ranges(batch, known, index, a)
            gone = found if gone is None else gone.unionByName(found)
            index.compact()
    return R.rebuilt(texts, gone, _digest, "doc_id long, n_words long, n_removed long, kept_sha256 string", ["n_words", "n_removed", "kept_sha256"])
