import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tiers.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    root = tempfile.mkdtemp(prefix="tiers-test-")
    session = local_session(
        "4",
        "tests",
        **{
            "spark.checkpoint.dir": f"{root}/shared",
            "spark.sql.warehouse.dir": f"{root}/warehouse",
            "spark.sql.shuffle.partitions": "3",
        },
    )
    yield session
    session.stop()
