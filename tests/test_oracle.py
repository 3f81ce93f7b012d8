"""Every registered query with a SQL counterpart gives the same rows in both engines."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from digestlake.plans import catalog
from digestlake.sources import posts as source

TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "int": "INTEGER", "timestamp_ntz": "TIMESTAMP"}


def rows(frame: pd.DataFrame) -> list[tuple]:
    show = lambda v: "NULL" if v is None or v is pd.NaT or (isinstance(v, float) and v != v) else format(v, ".9g") if isinstance(v, float) else str(v)
    return sorted(tuple(map(show, r)) for r in frame[sorted(frame.columns)].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_rows(spark, sf, duck, name):
    df = catalog.queries()[name](spark, sf)
    sql = catalog.oracle_sql()[name]
    assert {c: TYPES[t] for c, t in df.dtypes} == {r[0]: r[1] for r in duck.execute("DESCRIBE " + sql).fetchall()}
    assert rows(df.toPandas()) == rows(duck.execute(sql).df())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_runs(spark, sf, name):
    assert catalog.queries()[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["section", "part", "rank", "line_no", "line"]
    assert set(catalog.queries()) <= set(entry.queries())


def test_posts_hold_whole_texts(spark, sf, duck):
    whole = {str(i): t for i, t in duck.execute("SELECT doc_id, text FROM documents").fetchall()}
    assert all(whole[r["id"]] in r["text"] for r in source.view(spark, sf).select("id", "text").collect())
    assert all(whole[i] in t for i, t in duck.execute(f"SELECT id, text FROM ({source.view_sql()})").fetchall())
