from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from cardwarden.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session(
        "tests",
        **{
            "spark.sql.warehouse.dir": str(warehouse),
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def features(spark):
    """The feature table of the smallest data set, computed once."""
    from cardwarden.sources.tables import stored
    from checks.queries import _features

    return stored(_features(spark, SMALL), "test-features")
