import os
import sys
import tempfile
import time

import pytest

# collect() renders timestamps in the Python process's zone; pin it to the
# session zone (UTC) so comparisons do not depend on the machine.
os.environ["TZ"] = "UTC"
time.tzset()

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from eventflow.session import build_session
    ckpt = tempfile.mkdtemp(prefix="eventflow-test-ckpt-")
    s = build_session("local[4]", app="eventflow-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def _block_sizes(spark, small: bool):
    conf = {"spark.eventflow.scan.arrivalBlock": "16" if small else "262144",
            "spark.eventflow.scan.bucketRows": "16" if small else "1000000"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.fixture()
def small_blocks(spark):
    """Tiny blocks, so that carries cross arrival blocks and time buckets."""
    yield from _block_sizes(spark, True)


@pytest.fixture(params=["small_blocks", "default"])
def scan_mode(request, spark):
    """Run a test with tiny blocks and with the default block sizes."""
    yield from _block_sizes(spark, request.param == "small_blocks")
