"""How many rows a join may make, counted in the job that writes them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .versions import Version, overwrite

#: What the rows out may be, given the rows in.
RULES: dict[str, Callable[[int, int], bool]] = {"same": lambda came, went: came == went, "no more": lambda came, went: went <= came, "no fewer": lambda came, went: went >= came}


class CardinalityError(ValueError):
    """A step made more or fewer rows than it may."""


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """(key, n) of keys that more than one row has; null keys count."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def write_kept(rows: DataFrame, build: Callable[[DataFrame], DataFrame], path: str, rule: str = "same", **options: object) -> tuple[Version, int, int]:
    """Writes what `build` makes of the rows as a table's next version, with the rows in and out.

    The rows on both sides are counted as they pass, in the job that writes.  If their
    numbers break the rule, the version is refused and readers keep the last.  Tasks
    that run again after a lost executor may count rows twice, so before it
    refuses, the rows are counted once more by themselves.
    """
    came, went = Observation(), Observation()
    one = F.count(F.lit(1)).alias("n")
    made = build(rows.observe(came, one)).observe(went, one)
    seen: list[int] = []

    def check() -> None:
        seen[:] = [o.get.get("n", -1) for o in (came, went)]
        if min(seen) < 0 or not RULES[rule](*seen):
            seen[:] = rows.count(), build(rows).count()
            if not RULES[rule](*seen):
                raise CardinalityError(f"{seen[0]} rows became {seen[1]}; the rule is: {rule}")

    return overwrite(made, path, check=check, **options), *seen
