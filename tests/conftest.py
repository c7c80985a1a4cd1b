import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    os.environ.setdefault("COHORTKIT_DRIVER_MEMORY", "8g")
    from cohortkit.session import build_session
    s = build_session("local[*]", shuffle_partitions=8, app_name="cohortkit-tests")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ck-test-"))
    yield s
