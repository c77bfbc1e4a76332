"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from lodestone.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def plain(value):
    return 0.0 if isinstance(value, float) and value == 0 else value


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_matches_sql(spark, sf, duck, name):
    df = registry.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    result = duck.execute(registry.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in places) for r in result.fetchall()), key=repr)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*columns).collect()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_runs(spark, sf, name):
    assert registry.QUERIES[name](spark, sf).count() > 0
