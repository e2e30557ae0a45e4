"""One small session for all tests."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from textmill.session import session, ship

    made = session("tests", "local[4]", spark__driver__memory="4g", spark__sql__shuffle__partitions="4", spark__default__parallelism="4", spark__ui__showConsoleProgress="false", spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    made.sparkContext.setLogLevel("ERROR")
    ship(made)
    yield made
    made.stop()


@pytest.fixture
def rows(spark):
    """Rows of a frame as sorted tuples."""

    def sorted_rows(df, *columns):
        return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)

    return sorted_rows
