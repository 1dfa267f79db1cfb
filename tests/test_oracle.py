"""Every registered query against its DuckDB SQL (the driver's gate), at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from conftest import SF_SMALL
from stockyard import registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if hasattr(v, "item"):
        v = v.item()
    return repr(v)


def _rows(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False))


def test_every_query_of_the_library_has_oracle():
    assert set(registry.QUERIES) <= set(entry_module.queries())
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    got = entry_module.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.execute(entry_module.oracle_sql()[name]).df()
    gcols, grows = _rows(got)
    wcols, wrows = _rows(want)
    assert gcols == wcols
    assert len(grows) == len(wrows)
    assert grows == wrows


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["total_sales", "territory", "territory_id"]
    assert df.count() > 0
