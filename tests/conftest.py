import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martwright.session import WIDTH, get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        {
            "spark.master": "local[*]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="module", autouse=True)
def own_width(spark):
    """A query sets the session's shuffle width; the tests of one module do not see that of another."""
    before = spark.conf.get(WIDTH, None)
    yield
    spark.conf.unset(WIDTH) if before is None else spark.conf.set(WIDTH, before)


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
