"""Incremental ingest with Structured Streaming: new files once, batches upserted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.versions import append, merge
from ..sources.landing import CORRUPT, OPTIONS, raw_schema, tidy_strings


def stream_files(spark: SparkSession, folder: str, schema: T.StructType, form: str = "parquet", files_per_batch: int = 1, **options: str) -> DataFrame:
    """A stream over a growing folder, so many files at a time; the checkpoint holds which are done."""
    return spark.readStream.schema(schema).options(**options).option("maxFilesPerTrigger", files_per_batch).format(form).load(folder)


def ingest_once(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Appends all files that are new, then stops."""
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def query_of(batch: DataFrame) -> str:
    """The id of the stream that a batch is of: its checkpoint keeps it over restarts."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def upsert_once(stream: DataFrame, table: str, key: list[str], by: list[str], checkpoint: str, buckets: int = 64) -> None:
    """Merges new batches into a table of versions, then stops.

    A batch rewrites only the buckets that its keys touch.  Its number is noted
    with the version, so a batch that runs again, as after a writer was lost between
    the version and the checkpoint, is skipped.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            merge(rows, table, key, by, source=query_of(batch), batch=batch_id, buckets=buckets)
        finally:
            rows.unpersist()

    stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def land_once(spark: SparkSession, folder: str, columns: tuple[str, ...], good: str, bad: str, checkpoint: str, files_per_batch: int = 100) -> None:
    """Reads new landing files once, good records into one table and malformed ones, as (file_name, raw), into another, then stops.

    Both sinks belong to one stream with one checkpoint.  Each notes the batches that it
    has, so if the writer is lost between them, the batch that comes again goes
    only where it is missing.
    """
    read = stream_files(spark, folder, raw_schema(columns), "csv", files_per_batch, **OPTIONS)

    def put(batch: DataFrame, batch_id: int) -> None:
        rows, source = batch.persist(), query_of(batch)  # the files are parsed once for both
        try:
            append(rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT), good, source, batch_id)
            append(rows.where(F.col(CORRUPT).isNotNull()).select("file_name", F.col(CORRUPT).alias("raw")), bad, source, batch_id)
        finally:
            rows.unpersist()

    tidy_strings(read, columns).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
