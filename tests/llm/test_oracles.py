"""The SQL twins of the training-data operators on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(x for x in E.oracle_sql() if x.startswith("op")))
def test_query_matches_its_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    columns = sorted(df.columns)
    want = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    rows = sorted(tuple(r[names.index(c)] for c in columns) for r in want.fetchall())
    assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == rows
