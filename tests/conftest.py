import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tests.oracle import spark_session


@pytest.fixture(scope="session")
def spark():
    session = spark_session()
    yield session
    session.stop()
