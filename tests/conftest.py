from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from skyledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", {
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.driver.memory": "6g",
    }, "local[8]")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def flights(spark):
    """The small flights as a stored table, read many times."""
    from checks import views
    from skyledger.storage import materialise

    return materialise(views.flights(spark, SMALL), "test-flights")


def rows(df, *columns):
    """Rows as tuples, sorted, for comparison."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=repr)


def plan_of(df) -> str:
    """The formatted physical plan."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
