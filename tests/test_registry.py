"""Every registered query against its SQL, and the rows-only ones against what they promise."""

import pytest

from ledgerline.plans import registry, registry_marts, stores  # noqa: F401 (modules register their queries)

from .compare import duck, same

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_equals_sql(spark, con, name):
    same(registry.QUERIES[name](spark, FOLDER), con, registry.ORACLE_SQL[name])


def test_entry_imports():
    import __spark_entry__ as entry

    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_sample_bounds(spark):
    n, total = registry.QUERIES["bernoulli_sample"](spark, FOLDER).count(), spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()
    assert 0.02 * total < n < 0.09 * total
    assert n == registry.QUERIES["bernoulli_sample"](spark, FOLDER).count()


def test_no_nested_loops(spark):
    for name in ("denorm_mart", "quality_flags", "orphan_report", "enrich_domain"):
        plan = registry.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name
