"""Layouts that answer a search without reading the table: trigrams, bloom filters, shared buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Candidates whose keys are put into the filter of the scan; more are joined.
FEW = 1000


def trigrams(c: Column) -> Column:
    """The different runs of three characters of a text in lower case; none for shorter ones and null."""
    low = F.lower(c)
    runs = F.transform(F.sequence(F.lit(1), F.length(low) - 2), lambda k: F.substr(low, k, F.lit(3)))
    return F.when(F.length(low) > 2, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def with_bloom(writer, columns: list[str], ndv: int, block: int):
    """A Parquet writer whose row groups have bloom filters of some columns."""
    for c in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.expected.ndv#{c}", ndv)
    return writer.option("parquet.block.size", block).option("compression", "zstd")


def write_trigram_index(df: DataFrame, key: str, text: str, path: str, parts: int, block: int = 8 << 20) -> None:
    """Two tables: postings (gram, key), in order of both, and all columns of the rows in order of key.

    Ranges are of gram and key together, so a gram that very many texts have
    takes several files.  `key` is unique.
    """
    postings = df.select(F.explode(trigrams(F.col(text))).alias("gram"), key)
    ordered = postings.repartitionByRange(parts, "gram", key).sortWithinPartitions("gram", key)
    ordered.write.option("parquet.block.size", block).option("compression", "zstd").parquet(f"{path}/postings")
    rows = df.repartitionByRange(parts, key).sortWithinPartitions(key)
    rows.write.option("parquet.block.size", block).option("compression", "zstd").parquet(f"{path}/rows")


def candidates(spark: SparkSession, path: str, key: str, wanted: str) -> DataFrame | None:
    """Keys of texts that have all trigrams of the wanted text; None if it is too short to have one."""
    grams = spark.range(1).select(trigrams(F.lit(wanted))).first()[0]
    if not grams:
        return None
    found = spark.read.parquet(f"{path}/postings").where(F.col("gram").isin(grams))
    return found.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") == len(grams)).select(key)


def substring_search(spark: SparkSession, path: str, key: str, text: str, wanted: str, few: int = FEW) -> DataFrame:
    """Rows whose text has the wanted one in it, whatever the case of letters.

    Postings are intersected by counting, and what has all trigrams is then looked
    at.  A few candidates go into the filter of the scan, so that it skips all
    row groups but theirs (beyond spark.sql.parquet.pushdown.inFilterThreshold of
    them, those outside their range); more are joined.  Wanted texts of fewer than three
    characters have no trigrams: all rows are read.
    """
    rows = spark.read.parquet(f"{path}/rows")
    holds = F.contains(F.lower(text), F.lower(F.lit(wanted)))
    keys = candidates(spark, path, key, wanted)
    if keys is None:
        return rows.where(holds)
    some = [r[0] for r in keys.limit(few + 1).collect()]
    near = rows.where(F.col(key).isin(some)) if len(some) <= few else rows.join(keys, key, "left_semi")
    return near.where(holds)


def write_point_layout(df: DataFrame, path: str, keys: list[str], parts: int, ndv: int = 1_000_000, block: int = 8 << 20) -> None:
    """Rows in any order whose row groups say which values of some columns they surely lack.

    A look-up by one of the columns reads the row groups that may hold it, though
    the rows lie by another; `ndv` is about the number of values in a row group.
    """
    with_bloom(df.repartition(parts).write, keys, ndv, block).parquet(path)


def save_bucketed(df: DataFrame, name: str, path: str, key: list[str], buckets: int) -> None:
    """A table in buckets of a key, one sorted file each; tables with as many buckets of that key join where they lie."""
    dealt = df.repartition(buckets, *key)
    dealt.write.mode("overwrite").option("path", path).option("compression", "zstd").bucketBy(buckets, *key).sortBy(*key).format("parquet").saveAsTable(name)


def join_in_place(left: DataFrame, right: DataFrame, key: list[str], how: str = "inner") -> DataFrame:
    """A merge join of two tables in the same buckets: no row moves."""
    return left.join(right.hint("merge"), key, how)
