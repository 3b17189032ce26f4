import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rollmark.plans.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.sql.shuffle.partitions": "2",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    session = local_session(4, "tests", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
