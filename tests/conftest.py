import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from vecshelf.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="run-")
    session = local_session(
        8,
        "tests",
        **{
            "spark.checkpoint.dir": f"{folder}/checkpoints",
            "spark.sql.warehouse.dir": f"{folder}/warehouse",
            "spark.driver.memory": "6g",
            "spark.sql.shuffle.partitions": "4",
        },
    )
    yield session
    session.stop()
