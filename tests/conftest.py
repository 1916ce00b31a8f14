import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from larder.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "larder-tests",
        master="local[4]",
        shuffle_partitions=4,
        extra={"spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.sql.adaptive.enabled": "true"},
    )
    yield session
    session.stop()
