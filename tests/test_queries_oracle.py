"""Every registered query against its SQL twin (DuckDB) on the sf0.001 tables:
same column names and types, same rows (order-insensitive), as the driver checks."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from docspark.session import TABLES

SF = "/root/testdata/sf0.001"
TYPES = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE", "StringType()": "VARCHAR",
         "BooleanType()": "BOOLEAN"}


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{round(v, 6):.6f}"
    return str(v)


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_a_reason():
    rows_only = {"cluster_topics"}  # iterative ML (k-means): rows-only by design
    own = {name for name in E.queries() if not name.startswith("op") and name != "pipeline"}
    assert own - set(E.oracle_sql()) == rows_only


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "status" in df.columns


@pytest.mark.parametrize("name", sorted(x for x in E.oracle_sql() if not x.startswith("op")))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    stypes = {f.name: TYPES.get(repr(f.dataType), repr(f.dataType)) for f in df.schema.fields}
    dtypes = {d[0]: str(d[1]) for d in cur.description}
    assert {c: t for c, t in stypes.items() if t in TYPES.values()} == {c: dtypes[c] for c, t in stypes.items() if t in TYPES.values()}
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, cur.fetchall())


def test_cluster_topics_rows(spark):
    out = E.queries()["cluster_topics"](spark, SF)
    n = spark.read.parquet(f"{SF}/embeddings.parquet").count()
    assert out.count() == n and out.select("cluster").distinct().count() <= 10
