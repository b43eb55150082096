import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pulsewatch.session import build_session, drop_scratch  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        "local[4]",
        app_name="pulsewatch-tests",
        shuffle_partitions=8,
        extra={"spark.ui.showConsoleProgress": "false"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    drop_scratch(s)
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the shared checkpoint dir for one test."""
    from pulsewatch.session import scratch_path

    return scratch_path(spark, "test")
