import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from clearspan.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    conf = {"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"}
    session = build_session("tests", "local[4]", conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
