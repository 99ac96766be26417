import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from flowaudit.session import ensure_checkpoint_dir
    s = (SparkSession.builder.master("local[*]").appName("flowaudit-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         # tiny buckets so the bucketed prefix sums cross bucket borders in tests
         .config("spark.flowaudit.bucketRows", "50")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
