import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from landlens.session import build_session

    s = build_session("local[4]", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="landlens-test-ckpt-"),
                             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="landlens-test-wh-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def smoke_dir():
    if not os.path.isdir(SMOKE_DIR):
        pytest.skip("test tables not present")
    return SMOKE_DIR


def rows(df, order=None):
    """Collected rows as plain tuples (sorted when ``order`` is true)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=repr) if order else out
