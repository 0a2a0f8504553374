import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from threadloom.session import get_spark, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_spark("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


def tuples(df, *columns):
    """Rows of a small result, sorted."""
    rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=repr)
