import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lakestrata.session import get_spark

    s = get_spark(
        "local[*]",
        app_name="lakestrata-tests",
        shuffle_partitions=8,
        extra_conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="lakestrata-test-ckpt-")},
    )
    yield s
    s.stop()


@pytest.fixture
def workdir(tmp_path):
    return str(tmp_path)


@pytest.fixture
def run_id():
    return "RUN-0187"
