import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from martkit.session import build_session

    session = build_session(
        master="local[8]",
        app_name="martkit-tests",
        shuffle_partitions=8,
        conf={"spark.driver.memory": "8g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
