import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
# Python workers import the package and the helper classes of the tests.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [str(ROOT), str(ROOT / "tests"), os.environ.get("PYTHONPATH", "")]
)

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tallywatch.session import build_session

    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA
