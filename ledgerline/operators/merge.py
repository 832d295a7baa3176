"""Keys, deduplication and upsert of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_by_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row of each key, the first in an order of columns ("name" or "name DESC"; nulls are least); equal rows are interchangeable.

    Where all columns go one way it is a grouped extreme, summed in part before rows
    move, so a key with very many rows costs no task more than a row for each input
    task.  Only a mixed order needs each key's rows in one place, in a ranking window.
    """
    names = [o.split()[0] for o in order]
    falls = {o.upper().endswith(" DESC") for o in order}
    if len(falls) == 1:
        rest = [c for c in df.columns if c not in key and c not in names]
        pick = F.max_by if falls == {True} else F.min_by
        # the order goes along in the extreme itself
        best = df.groupBy(*key).agg(pick(F.struct(*names, *rest), F.struct(*names)).alias("_best"))
        return best.select(*[F.col(c) if c in key else F.col(f"_best.{c}").alias(c) for c in df.columns])
    by = [F.col(n).desc_nulls_last() if o.upper().endswith(" DESC") else F.col(n).asc_nulls_first() for n, o in zip(names, order, strict=True)]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*by)))
    return ranked.where("_rank = 1").drop("_rank")


def latest_by_key(df: DataFrame, key: list[str], by: list[str]) -> DataFrame:
    """The row of each key that is greatest by `by`, then by all other columns.

    A grouped maximum is summed in part before rows move, so a key with very
    many rows costs no task more than a row for each input task.
    """
    rest = [c for c in df.columns if c not in key and c not in by]
    best = df.groupBy(*key).agg(F.max(F.struct(*by, *rest)).alias("_best"))
    return best.select(*[F.col(c) if c in key else F.col(f"_best.{c}").alias(c) for c in df.columns])


def _same_key(left: DataFrame, right: DataFrame, key: list[str]) -> tuple[DataFrame, Column]:
    """The right side's keys under other names, and the test that keys are equal, nulls too."""
    side = right.withColumnsRenamed({c: f"_key_{k}" for k, c in enumerate(key)})
    on = F.lit(True)
    for k, c in enumerate(key):
        on = on & left[c].eqNullSafe(F.col(f"_key_{k}"))
    return side, on


def upsert(target: DataFrame, incoming: DataFrame, key: list[str], by: list[str], now: Column | None = None) -> DataFrame:
    """The target with incoming rows put over it; the last row by `by` wins among incoming ones; null keys are keys like others.

    With `now`, inserted rows get it as data_criacao, changed ones keep theirs,
    and both get it as data_atualizacao.
    """
    fresh = latest_by_key(incoming, key, by)
    values = [c for c in fresh.columns if c not in key]
    if now is not None:
        known, on = _same_key(fresh, target.select(*key, F.col("data_criacao").alias("_made")), key)
        kept = [c for c in fresh.columns if c not in ("data_criacao", "data_atualizacao")]
        fresh = fresh.join(known, on, "left").withColumn("data_criacao", F.coalesce("_made", now)).withColumn("data_atualizacao", now).select(*kept, "data_criacao", "data_atualizacao")
    if not values:  # only keys: nothing to update
        known, on = _same_key(fresh, target.select(*key), key)
        return target.unionByName(fresh.join(known, on, "left_anti"))
    known, on = _same_key(target, fresh.select(*key), key)
    return target.join(known, on, "left_anti").unionByName(fresh, allowMissingColumns=True)
