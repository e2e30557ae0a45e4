"""Each query of the core against its SQL in DuckDB, over the smallest tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

from textmill import plans

FOLDER = os.environ.get("TEXTMILL_TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool) or not isinstance(v, (int, float)) and type(v).__name__ != "Decimal":
        return str(v)
    return round(float(v), 5)


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, duck, name):
    df = plans.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    if name not in plans.ORACLE:
        assert len(set(columns)) == len(columns)
        return
    cursor = duck.execute(plans.ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=str)
    assert got == want


def test_core_stands_alone():
    """Nothing of the core imports the subpackage for training data."""
    root = Path(plans.__file__).resolve().parent.parent
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "textmill.llm" not in path.read_text(encoding="utf-8"), path
