"""Parquet export with a manifest, resume by table, statistics and layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA_VERSION = "2"


def export_table(df: DataFrame, path: str) -> None:
    """ZSTD Parquet, made again from nothing."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def is_exported(spark: SparkSession, path: str) -> bool:
    """Whether a table is complete: a half-written folder is not."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def export_all(tables: dict[str, DataFrame], folder: str, resume: bool = True) -> list[str]:
    """Exports the tables that are not complete yet; returns their names."""
    done = []
    for name, df in tables.items():
        path = f"{folder}/{name}.parquet"
        if not (resume and is_exported(df.sparkSession, path)):
            export_table(df, path)
            done.append(name)
    return done


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) of each table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


def manifest_totals(counts: DataFrame) -> DataFrame:
    return counts.agg(F.count("*").alias("n_tables"), F.sum("n_rows").alias("n_rows"))


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(table, size_bytes) of a table's part files, from the listing; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.sum("length").alias("size_bytes"))


def write_manifest(tables: list[str], folder: str, spark: SparkSession, source_month: str, version: str) -> None:
    """One JSON row: when, what, and rows and bytes of each table and of all."""
    rows = None
    for name in sorted(tables):
        path = f"{folder}/{name}.parquet"
        one = spark.read.parquet(path).agg(F.count("*").alias("rows")).crossJoin(file_sizes(spark, path))  # one row each
        one = one.select(F.lit(name).alias("table"), "rows", F.col("size_bytes").alias("sizeBytes"), F.lit(f"{name}.parquet").alias("file"))
        rows = one if rows is None else rows.unionByName(one)
    total = rows.agg(F.sort_array(F.collect_list(F.struct("table", "rows", "sizeBytes", "file"))).alias("tables"), F.sum("rows").alias("totalRows"), F.sum("sizeBytes").alias("totalBytes"), F.count("*").alias("totalTables"))
    total = total.select(F.current_timestamp().alias("exportedAt"), F.lit(version).alias("pipelineVersion"), F.lit(SCHEMA_VERSION).alias("schemaVersion"), F.lit(source_month).alias("sourceMonth"), "*")
    total.coalesce(1).write.mode("overwrite").json(f"{folder}/manifest")


def save_mart(df: DataFrame, table: str) -> None:
    """Drop, rebuild and collect statistics."""
    df.write.mode("overwrite").format("parquet").saveAsTable(table)
    df.sparkSession.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def column_statistics(spark: SparkSession, table: str, columns: list[str]) -> DataFrame:
    """(column_name, low, high, nulls, distinct) as the catalog has them; text has no low and high."""
    rows = []
    for c in columns:
        found = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {table} {c}").collect()}
        known = lambda k: None if found.get(k) in (None, "NULL") else found[k]  # noqa: E731, B023
        rows.append((c, known("min"), known("max"), *(int(v) if (v := known(k)) else None for k in ("num_nulls", "distinct_count"))))
    return spark.createDataFrame(rows, "column_name string, low string, high string, nulls long, distinct long")


def write_search_layout(df: DataFrame, path: str, region: str, name: str, key: list[str], parts: int) -> None:
    """Partitioned by region and in order of name, so that files and row groups prune by both."""
    ordered = df.repartitionByRange(parts, region, name).sortWithinPartitions(region, name, *key)
    ordered.write.mode("overwrite").partitionBy(region).parquet(path)
