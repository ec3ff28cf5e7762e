import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master("local[*]")
        .appName("devmetrics-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # A zone far from UTC: every result must be independent of the session zone.
        .config("spark.sql.session.timeZone", "America/New_York")
    )
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="devmetrics-test-"))
    yield s


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="devmetrics-t-")
