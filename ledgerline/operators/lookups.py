"""Joins with code tables, and what the marts are made of."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a code table that may be broadcast; the largest has some 6,000.
LOOKUP_ROWS = 100_000
#: Bytes of its values as text, and a few for each value.
LOOKUP_BYTES = 64 << 20


def small(dim: DataFrame, rows: int = LOOKUP_ROWS, size: int = LOOKUP_BYTES) -> DataFrame:
    """Broadcast a table if a bounded look shows that its rows and bytes are few; else leave the join to Spark.

    A table that has been looked at keeps its hint through selections, and one that
    is part of the plan itself, as static dictionaries are, tells its rows: neither is
    looked at again.
    """
    plan = dim._jdf.queryExecution()
    node = plan.analyzed()
    while node.nodeName() != "ResolvedHint" and node.children().size() == 1:
        node = node.children().head()
    if node.nodeName() == "ResolvedHint":
        return dim
    if plan.optimizedPlan().nodeName() == "LocalRelation" and plan.optimizedPlan().data().size() <= rows:
        return F.broadcast(dim)
    width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 16 for c in dim.columns), F.lit(0))
    found = dim.select(width.cast("long").alias("width")).limit(rows + 1).agg(F.count("*"), F.coalesce(F.sum("width"), F.lit(0))).first()
    return F.broadcast(dim) if found[0] <= rows and found[1] <= size else dim


def looked_at(tables: dict[str, DataFrame], names: list[str]) -> dict[str, DataFrame]:
    """The tables, with each of the named code tables looked at once, however many joins use it."""
    return tables | {name: small(tables[name]) for name in dict.fromkeys(names)}


def with_lookup(df: DataFrame, dim: DataFrame, code: str, out: str, key: str = "codigo", label: str = "descricao") -> DataFrame:
    """Adds a code's label as `out`; unknown and null codes keep their row with a null label."""
    side = small(dim.select(F.col(key).alias("_key"), F.col(label).alias(out)))
    return df.join(side, df[code] == F.col("_key"), "left").drop("_key")


def lookup_missing_flag(df: DataFrame, dim: DataFrame, code: str, out: str, key: str = "codigo", ignore: tuple[str, ...] = ()) -> DataFrame:
    """Adds whether a code is absent from a code table; false for null and ignored codes."""
    side = small(dim.select(F.col(key).alias("_key")).where("_key is not null").distinct().withColumn("_found", F.lit(True)))
    joined = df.join(side, df[code] == F.col("_key"), "left")
    asked = df[code].isNotNull() & (~df[code].isin(list(ignore)) if ignore else F.lit(True))
    return joined.withColumn(out, asked & F.col("_found").isNull()).drop("_key", "_found")


def static_dictionary(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows that are part of the plan."""
    kinds = spark.createDataFrame([], schema).schema
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    arrow = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}
    data = pa.table({f.name: pa.array(list(c), arrow[f.dataType.simpleString()]) for f, c in zip(kinds, columns, strict=True)})
    return spark.createDataFrame(data, kinds)


def enrich_domain(monthly: DataFrame, supplement: DataFrame, kind: str, url: str, monthly_kind: str = "receita_monthly") -> DataFrame:
    """Monthly rows and the supplement's rows whose code they lack, with provenance; monthly always wins."""
    own = monthly.select(
        "codigo", "descricao", F.lit(monthly_kind).alias("source_kind"), F.lit(None).cast("string").alias("source_url"), F.lit(False).alias("is_supplemental"), F.lit("high").alias("confidence"),
        F.lit(None).cast("string").alias("notes"),
    )
    fresh = supplement.join(small(monthly.select("codigo")), "codigo", "left_anti")
    extra = fresh.select("codigo", "descricao", F.lit(kind).alias("source_kind"), F.lit(url).alias("source_url"), F.lit(True).alias("is_supplemental"), "confidence", "notes")
    return own.unionByName(extra)


def superset_gaps(larger: DataFrame, smaller: DataFrame) -> DataFrame:
    """Rows of `smaller` that `larger` lacks; nulls equal nulls."""
    names = smaller.columns
    side = larger.select(*[F.col(c).alias(f"_{c}") for c in names])
    on = F.lit(True)
    for c in names:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return smaller.join(side, on, "left_anti")


def prefix_hierarchy(df: DataFrame, code: str, sections: DataFrame) -> DataFrame:
    """Adds secao, divisao, grupo and classe of an activity code; divisions without a section get null."""
    c = F.col(code)
    out = df.withColumns({"divisao": F.left(c, F.lit(2)), "grupo": F.left(c, F.lit(3)), "classe": F.concat(F.left(c, F.lit(4)), F.lit("-"), F.substring(c, 5, 1))})
    return with_lookup(out, sections, "divisao", "secao", key="divisao_code", label="secao_name")


def explode_delimited(df: DataFrame, keys: list[str], column: str, out: str, separator: str = ",") -> DataFrame:
    """One row for each non-empty trimmed part of a delimited text; repeats stay."""
    quoted = "".join(f"\\x{{{ord(c):x}}}" for c in separator)
    parts = df.select(*keys, F.explode(F.split(F.col(column), quoted)).alias("_part"))
    return parts.select(*keys, F.trim("_part").alias(out)).where(F.col(out) != "")


def shape_status(c: Column, cases: list[tuple[Column, str]], otherwise: str, missing: str = "missing") -> Column:
    """The first case that holds, after null."""
    out = F.when(c.isNull(), missing)
    for test, name in cases:
        out = out.when(test, name)
    return out.otherwise(otherwise)


def sentinel_flag(c: Column, value: object) -> Column:
    return c == F.lit(value)


def raw_clean_pair(c: Column, name: str, bad: Column) -> list[Column]:
    """A column as it is, and again with null where `bad` holds; a null `bad` keeps the value."""
    return [c.alias(f"{name}_raw"), F.when(bad, None).otherwise(c).alias(f"{name}_clean")]


def count_rollups(df: DataFrame, kinds: dict[str, list[str]], representatives: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Counts at several grains in one pass: kind, all grouping columns, total.

    A rolled-up column is null; a real null stays a bucket of its own kind.
    `representatives` gives, for a kind, output columns that hold the least
    value of a column.
    """
    columns = list(dict.fromkeys(c for names in kinds.values() for c in names))
    extra = {out: source for reps in (representatives or {}).values() for out, source in reps.items()}
    aggregates = [F.count("*").alias("total"), F.grouping_id().alias("_grain"), *[F.min(source).alias(f"_min_{out}") for out, source in extra.items()]]
    grouped = df.groupingSets([[F.col(c) for c in names] for names in kinds.values()], *[F.col(c) for c in columns]).agg(*aggregates)
    code = {kind: sum(1 << (len(columns) - 1 - k) for k, c in enumerate(columns) if c not in names) for kind, names in kinds.items()}
    kind = F.coalesce(*[F.when(F.col("_grain") == n, F.lit(k)) for k, n in code.items()])
    out = grouped.withColumn("kind", kind)
    for kind_name, reps in (representatives or {}).items():
        for name in reps:
            out = out.withColumn(name, F.when(F.col("kind") == kind_name, F.col(f"_min_{name}")))
    return out.select("kind", *columns, *extra, "total")


def count_of(rollup: DataFrame, kind: str, **keys: object) -> DataFrame:
    """The row of a rollup for one bucket, that of nulls too, or none."""
    out = rollup.where(F.col("kind") == kind)
    for name, value in keys.items():
        out = out.where(F.col(name).eqNullSafe(F.lit(value)))
    return out.select("total")


def prefix_search(df: DataFrame, name: str, prefix: str, order: list[str], n: int, where: Callable[[DataFrame], DataFrame] = lambda d: d) -> DataFrame:
    """The first n rows by name and key whose name starts with a prefix; the filter reaches the files."""
    return where(df).where(F.col(name).startswith(prefix)).orderBy(name, *order).limit(n)
