"""Measurements of a data-quality report, as tidy rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookups import lookup_missing_flag


@dataclass(frozen=True)
class Reference:
    """A column that should be in a code table; `ignore` has values that don't count."""

    label: str
    table: str
    column: str
    lookup: str
    enriched: str | None = None
    ignore: tuple[str, ...] = ()


def orphan_report(tables: dict[str, DataFrame], checks: list[Reference], key: str = "codigo") -> DataFrame:
    """(label, orphans): one scan of each fact table for all its checks; nulls are no orphans."""
    out = None
    for name in dict.fromkeys(c.table for c in checks):
        own = [c for c in checks if c.table == name]
        df = tables[name].select(*dict.fromkeys(c.column for c in own))
        for k, c in enumerate(own):
            df = lookup_missing_flag(df, tables[c.lookup], c.column, f"_m{k}", key=key, ignore=c.ignore)
        row = df.agg(*[F.count_if(f"_m{k}").alias(f"_m{k}") for k in range(len(own))])
        labels = ", ".join("'{}', _m{}".format(c.label.replace("'", "\\'"), k) for k, c in enumerate(own))
        one = row.select(F.expr(f"stack({len(own)}, {labels}) as (label, orphans)"))
        out = one if out is None else out.unionByName(one)
    return out


def enriched_coverage(tables: dict[str, DataFrame], checks: list[Reference], key: str = "codigo") -> DataFrame:
    """(label, monthly_orphans, enriched_orphans, available) of each check; without an enriched table it is not available."""
    monthly = orphan_report(tables, checks, key).withColumnRenamed("orphans", "monthly_orphans")
    usable = [c for c in checks if c.enriched in tables]
    if not usable:
        return monthly.select("label", "monthly_orphans", F.lit(None).cast("long").alias("enriched_orphans"), F.lit(False).alias("available"))
    second = [Reference(c.label, c.table, c.column, c.enriched, None, c.ignore) for c in usable]
    enriched = orphan_report(tables, second, key).withColumnRenamed("orphans", "enriched_orphans")
    return monthly.join(enriched, "label", "left").withColumn("available", F.col("enriched_orphans").isNotNull())


def fused_counts(df: DataFrame, section: str, metrics: dict[str, Column]) -> DataFrame:
    """(section, metric, value, total): all counters of a table in one pass."""
    row = df.agg(F.count("*").alias("_n"), *[F.count_if(c).alias(f"_{k}") for k, c in enumerate(metrics.values())])
    pairs = ", ".join(f"'{name}', _{k}" for k, name in enumerate(metrics))
    return row.select(F.lit(section).alias("section"), F.expr(f"stack({len(metrics)}, {pairs}) as (metric, value)"), F.col("_n").alias("total"))


def percent(part: Column, whole: Column) -> Column:
    """Four decimals and a sign, or n/a where there is nothing to divide by."""
    return F.when(whole == 0, "n/a").otherwise(F.format_string("%.4f%%", part * 100.0 / whole))


def sample_rows(df: DataFrame, percent_: float, seed: int) -> DataFrame:
    """A row sample of a percentage in (0, 100]."""
    if not 0 < percent_ <= 100:  # also false for nan
        raise ValueError(f"sample percentage {percent_} is not in (0, 100]")
    return df.sample(fraction=percent_ / 100, seed=seed)


def hash_sample(df: DataFrame, key: list[str], percent_: float, salt: str = "sample") -> DataFrame:
    """The rows whose key's hash is among the lowest so many percent, in (0, 100].

    The same keys are taken at every run, in every order of rows and in every engine that
    has MD5; all rows of a key go together, and a greater percentage takes all of a smaller one's.
    """
    if not 0 < percent_ <= 100:
        raise ValueError(f"sample percentage {percent_} is not in (0, 100]")
    text = F.concat_ws(":", F.lit(salt), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key])
    return df.where(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") < F.lit(int(percent_ / 100 * 2**32)))


def cleared(df: DataFrame, changes: dict[str, Column]) -> DataFrame:
    """(column, cleared): how many values each change turns into null, all in one pass."""
    row = df.agg(*[F.count_if(F.col(c).isNotNull() & change.isNull()).alias(f"_{k}") for k, (c, change) in enumerate(changes.items())])
    pairs = ", ".join(f"'{c}', _{k}" for k, c in enumerate(changes))
    return row.select(F.expr(f"stack({len(changes)}, {pairs}) as (column, cleared)"))


def reconciled(rollup: DataFrame, base: DataFrame) -> DataFrame:
    """(kind, total, agrees): whether the buckets of each kind add up to the rows that were rolled up."""
    whole = base.agg(F.count("*").alias("_all")).withColumn("_one", F.lit(1))  # one row
    sums = rollup.groupBy("kind").agg(F.sum("total").alias("total")).withColumn("_one", F.lit(1))
    return sums.join(F.broadcast(whole), "_one").select("kind", "total", (F.col("total") == F.col("_all")).alias("agrees"))
