"""Registered queries that SQL can express, against DuckDB."""

import pytest

from ledgerline.llm import queries

from ..compare import duck, same

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_equals_sql(spark, name):
    same(queries.QUERIES[name](spark, FOLDER), duck(FOLDER), queries.ORACLE_SQL[name])
