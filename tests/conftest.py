import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "scripts"))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from eventide.session import get_session
    s = get_session("local[4]", shuffle_partitions=4,
                    extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def chunked(spark):
    """Force every key with more than 3 rows through the hot-key path."""
    spark.conf.set("spark.eventide.rowsPerChunk", "3")
    yield
    spark.conf.unset("spark.eventide.rowsPerChunk")
