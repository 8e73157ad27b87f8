import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from padron.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "local[8]", "tests",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
           "spark.checkpoint.dir": str(shared)})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def months():
    """First days of n consecutive months from January 2020."""
    from datetime import date

    def build(n, skip=()):
        return [date(2020 + i // 12, i % 12 + 1, 1) for i in range(n) if i not in skip]
    return build
