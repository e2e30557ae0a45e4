"""Each query of the eight problems against its SQL in DuckDB, over the smallest tables; the others for their columns."""

import math
import os
from pathlib import Path

import duckdb
import pytest

from textmill.llm import queries as Q

FOLDER = os.environ.get("TEXTMILL_TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return str(v) if isinstance(v, (bool, str)) else round(float(v), 5)


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query(spark, duck, name):
    df = Q.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    cursor = duck.execute(Q.ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=str)
    assert sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str) == want


def test_columns():
    assert set(Q.ORACLE) <= set(Q.QUERIES) and all(name[0] == "p" for name in Q.QUERIES)
