import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakemarts import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="lakemarts-wh-")
    session = build_session(
        "local[4]",
        app_name="lakemarts-tests",
        conf={
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": warehouse,
            "spark.driver.memory": "4g",
        },
    )
    yield session
    session.stop()
