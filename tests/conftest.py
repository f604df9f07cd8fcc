import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from jobweave.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", 8, {"spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def values(spark):
    """Evaluate a column over single values and hand back the results."""
    def run(column, inputs, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
        return [r[0] for r in df.orderBy("i").select(column).collect()]

    return run
