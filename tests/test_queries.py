"""Every query against its SQL, as the driver compares them, at the smallest scale."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.queries import ORACLE, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def compare(spark, duck, sf, query, sql):
    df = query(spark, sf)
    columns = sorted(df.columns)
    mine = sorted(tuple(x.hex() if isinstance(x, float) else str(x) for x in r) for r in df.select(*columns).collect())
    found = duck.execute(sql)
    names = [x[0] for x in found.description]
    assert sorted(names) == columns
    theirs = sorted(tuple(r[names.index(c)].hex() if isinstance(r[names.index(c)], float) else str(r[names.index(c)]) for c in columns) for r in found.fetchall())
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, duck, sf, name):
    compare(spark, duck, sf, QUERIES[name], ORACLE[name])


@pytest.mark.parametrize("parts", [2, 3, 5, 8])
def test_facts_are_whole_however_they_are_dealt(spark, tmp_path, parts):
    c = duckdb.connect()
    c.execute("CREATE TABLE orders AS SELECT i * 2500 AS o_orderkey, ['F', 'O', 'P'][i % 3 + 1] AS o_orderstatus, i % 5 || '-X' AS o_orderpriority, i / 8 AS o_totalprice FROM range(100) t(i)")
    c.execute(f"COPY orders TO '{tmp_path}/orders.parquet'")
    conf = {"spark.sql.shuffle.partitions": str(parts), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        compare(spark, c, str(tmp_path), QUERIES["read_facts"], ORACLE["read_facts"])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_registered():
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
