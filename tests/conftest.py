import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from newsevents.session import get_spark
    ckpt = tempfile.mkdtemp(prefix="newsevents-test-ckpt-")
    s = get_spark("newsevents-tests", master="local[4]", shuffle_partitions=4,
                  conf={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="newsevents-test-")


def event_line(**cols) -> str:
    """A 58-column event line; ``cols`` maps column index (as ``c<i>``) to text."""
    f = [""] * 58
    for k, v in cols.items():
        f[int(k[1:])] = v
    return "\t".join(f)
