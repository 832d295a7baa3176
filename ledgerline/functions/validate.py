"""Rules that count and never change rows, all in one pass over the data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, Column, Column]  # name, rows it applies to, rows that break it


def format_rule(column: str, pattern: str) -> Rule:
    c = F.col(column)
    return f"{column}:format", c.isNotNull(), c.isNotNull() & ~c.rlike(pattern)


def domain_rule(column: str, allowed: Iterable[str]) -> Rule:
    c = F.col(column)
    return f"{column}:domain", c.isNotNull(), c.isNotNull() & ~c.isin(list(allowed))


def length_rule(column: str, most: int) -> Rule:
    c = F.col(column)
    return f"{column}:length", c.isNotNull(), F.length(c) > most


def required_rule(column: str) -> Rule:
    return f"{column}:required", F.lit(True), F.col(column).isNull()


def count_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rule, checked, invalid) rows from one aggregate over one scan."""
    counts = [x for k, (_, on, bad) in enumerate(rules) for x in (F.count_if(on).alias(f"c{k}"), F.count_if(bad).alias(f"i{k}"))]
    row = df.agg(*counts)
    pairs = ", ".join(f"'{name}', c{k}, i{k}" for k, (name, _, _) in enumerate(rules))
    return row.select(F.expr(f"stack({len(rules)}, {pairs}) as (rule, checked, invalid)"))


def observed_rules(df: DataFrame, name: str, rules: list[Rule]) -> DataFrame:
    """The rows themselves, with the counts observed while they are written."""
    return df.observe(name, *[F.count_if(bad).alias(rule) for rule, _, bad in rules])


def key_uniqueness(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows, distinct keys and keys with several rows, from one grouping."""
    sizes = df.groupBy(*key).count()
    return sizes.agg(F.sum("count").alias("n_rows"), F.count("*").alias("n_keys"), F.count_if(F.col("count") > 1).alias("n_repeated"))
