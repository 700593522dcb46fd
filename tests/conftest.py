import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from incidentlake.config import local_session

    scratch = tempfile.mkdtemp(prefix="incidentlake-tests-")
    s = local_session(
        "incidentlake-tests",
        shuffle_partitions=8,
        extra={"spark.checkpoint.dir": f"{scratch}/checkpoint"},
    )
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
