"""Queries of this subpackage against their SQL at the smallest scale, and the planted rules of their results."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.llm.queries import ORACLE, QUERIES
from tests.test_queries import TABLES, compare


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, duck, sf, name):
    compare(spark, duck, sf, QUERIES[name], ORACLE[name])


def test_all_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 11)}
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
