"""Every query with SQL gives the rows that DuckDB gives for it."""

import glob
import os

import pandas as pd
import pytest

from voltloom.plans.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def rows(df):
    df = df[sorted(df.columns)]

    def text(v):
        if v is None or pd.isna(v):
            return "NULL"
        return f"{float(v):.6g}" if isinstance(v, (float, int)) and not isinstance(v, bool) else str(v)

    return sorted(tuple(map(text, r)) for r in df.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA).toPandas()
    want = duck.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_all_edges_are_exported(spark, duck):
    from voltloom.plans import queries

    _, g = queries._grid(spark, DATA)
    names = {f"DeliveryPoint.{r.id}": f"DeliveryPoint.{r.delivery_point_id}" for r in g["node"].where("node_type = 'DeliveryPoint'").collect()}
    got = QUERIES["export_topology_edges"](spark, DATA).toPandas()
    want = duck.sql(SQL["export_topology"]).df()
    for end in ("a", "b"):
        got[end] = got[end].map(lambda code: names.get(code, code))
    for df in (got, want):
        df[["a", "b"]] = [sorted(pair) for pair in df[["a", "b"]].itertuples(index=False, name=None)]
    assert any(code.startswith("DeliveryPoint.") for code in want["b"])
    assert rows(got) == rows(want)
