import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from sievepoint.runtime import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tests-")})
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def rows(spark):
    """Build a frame from tuples and a DDL schema."""
    return lambda data, schema: spark.createDataFrame(data, schema)


def values(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())
