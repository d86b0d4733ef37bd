import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tagloom import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tagloom-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Frame of text rows with the given column names."""

    def make(names, rows):
        return spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names.split(",")))

    return make


def pairs(df):
    return {tuple(row) for row in df.collect()}


@pytest.fixture(name="pairs")
def pairs_fixture():
    return pairs
