import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfscope.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session("local[4]", "tests", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(warehouse),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluates columns over one row of named string values (None allowed)."""

    def evaluate(expression, **values):
        schema = ", ".join(f"{k} string" for k in values) or "unused string"
        row = spark.createDataFrame([tuple(values.values()) or ("",)], schema)
        return row.select(expression.alias("out")).first()["out"]

    return evaluate
