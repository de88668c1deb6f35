"""Every registered query of the swim operators against DuckDB."""

import math

import duckdb
import pytest

from natatio.plans import catalogue

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


@pytest.fixture(scope="module")
def given():
    con, at = duckdb.connect(), "/root/testdata/sf0.01"
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{at}/{t}.parquet'")
    return con, at


def plain(value):
    return round(value, 9) if isinstance(value, float) and not math.isnan(value) else value


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_matches_duckdb(spark, given, name):
    duck, at = given
    got = catalogue.QUERIES[name](spark, at)
    want = duck.execute(catalogue.ORACLE[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    rows = lambda data: sorted((tuple(map(plain, r)) for r in data), key=str)
    expected = rows(want.fetchall())
    assert rows(map(tuple, got.select(*columns).collect())) == expected
    assert expected
