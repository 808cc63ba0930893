import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from seriesmill import schema  # noqa: E402
from seriesmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        "tests",
        8,
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Build a raw table from dictionaries; columns that are not given are NULL."""

    def build(rows):
        fields = schema.RAW_SCHEMA
        return spark.createDataFrame(
            [tuple(row.get(f.name) for f in fields) for row in rows], fields
        )

    return build
