"""Small helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; on one machine, a local one where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = f"file://{tempfile.gettempdir()}/ledgerline-{spark.sparkContext.applicationId}"
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write a table into the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes tables of `written` that nothing will read again."""
    for df in tables:
        session = df.sparkSession
        path = session._jvm.org.apache.hadoop.fs.Path(df._written_at)
        path.getFileSystem(session._jsc.hadoopConfiguration()).delete(path, True)


def id_crc(column: str | Column, modulus: int) -> Column:
    """crc32 of an id's decimal text, modulo `modulus`; null for a null id."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(column.cast("string").cast("binary")) % modulus


def documents(docs: DataFrame, *extra: str) -> DataFrame:
    """The id and text columns with fixed types; a null text counts as empty."""
    keep = [F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")]
    return docs.select(*keep, *extra)


#: Ids that may be broadcast: about 30 MB in a hashed relation.
BROADCAST_IDS = 1_000_000


def only_ids(df: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows whose doc_id is in `ids` (or, by left_anti, is not), a written table of distinct ids.

    Ids are broadcast, so that texts stay in place, up to BROADCAST_IDS of them;
    more ids take a shuffled join.
    """
    few = ids.count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids.hint("merge"), "doc_id", how).select(*df.columns)


def least_hashes(df: DataFrame, bound: int, *ties: str) -> DataFrame:
    """At most `bound` rows, those whose doc_id has the least hashes.

    Where there are many more, a threshold on the hash, which is uniform, leaves
    a third more than `bound` before the sort, so each task gives up few rows.
    """
    n, place = df.count(), F.xxhash64("doc_id")
    if n > 2 * bound:
        df = df.where(place < int(-(1 << 63) + (1 << 64) * (bound * 4 / 3 / n)))
    return df.orderBy(place, "doc_id", *ties).limit(bound)
