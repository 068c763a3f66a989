"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as E
from obsgate.plans.registered import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

DUCK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
              "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def _norm(v):
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else ("f", float(f"{v:.9g}"))
    return ("v", v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    otypes = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {E.oracle_sql()[name]}").fetchall()}
    assert {c: DUCK_TYPES[t] for c, t in df.dtypes} == otypes
    assert _rows(df.columns, df.collect()) == _rows(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["YEAR", "MONTH", "DAY", "OBSERVATION1", "OBSERVATION2", "OBSERVATION3", "SPLIT_RANGE"]
