import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lumbung.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session("tests", 4, **{
        "spark.checkpoint.dir": str(shared),
        "spark.sql.warehouse.dir": str(shared / "tables"),
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
        "spark.sql.maxMetadataStringLength": "20000",
    })
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Values of an expression over single-column text rows."""

    def run(values, expression):
        rows = [(i, x) for i, x in enumerate(values)]
        df = spark.createDataFrame(rows, "i int, x string")
        return [r[0] for r in df.orderBy("i").select(expression).collect()]

    return run
