"""Queries of text operators against their SQL over the whole small tables."""

import duckdb
import pytest

from barloom.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    want = con.execute(queries.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    got, want = (x[sorted(got.columns)].sort_values([c for c in ("doc_id", "query_id", "rank") if c in got.columns]).reset_index(drop=True) for x in (got, want))
    assert len(got) == len(want) and (got == want).all().all(), (got != want).sum()
