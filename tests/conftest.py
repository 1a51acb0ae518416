import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from tallymart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", 8,
        {
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.sql.maxMetadataStringLength": "100000",
            "spark.sql.debug.maxToStringFields": "1000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a frame as plain tuples, in the given order of columns."""

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in chosen.collect()), key=repr)

    return collect


@pytest.fixture
def plan():
    """The physical plan of a frame as text."""

    def text(df, executed=False):
        if executed:
            df.collect()
        return df._jdf.queryExecution().executedPlan().toString()

    return text
