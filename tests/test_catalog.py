"""Every registered query of the core against its SQL in DuckDB, on sf0.001."""

import math

import duckdb
import pytest

from tessera.plans import catalog
from tessera.sources.tables import NAMES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in NAMES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = lambda v: round(v, 4) if isinstance(v, float) and not math.isnan(v) else v
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    want = duck.execute(catalog.ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, want.fetchall())
