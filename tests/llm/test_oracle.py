"""The registered queries of this subpackage against their SQL in DuckDB, on sf0.001."""

import duckdb
import pytest

from tessera.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(queries.ORACLE[name])
    names = sorted(d[0] for d in want.description)
    at = [[d[0] for d in want.description].index(n) for n in names]
    rows = sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)
    found = queries.QUERIES[name](spark, SF)
    assert sorted(found.columns) == names
    assert sorted((tuple(r) for r in found.select(*names).collect()), key=repr) == rows
