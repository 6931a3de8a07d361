"""Every query with SQL gives DuckDB's rows."""

import math

import duckdb
import pytest

from wayfold.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    return float(f"{v:.10g}") if isinstance(v, float) and not math.isnan(v) else v


def rows(cols, data):
    order = sorted(range(len(cols)), key=cols.__getitem__)
    return sorted([tuple(plain(r[i]) for i in order) for r in data], key=repr)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows(spark, duck, name):
    got = registry.queries()[name](spark, SF)
    want = duck.sql(registry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())
