import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from churnlab.session import build_session, ensure_checkpoint_dir

    s = build_session("local[*]", app_name="churnlab-tests", shuffle_partitions=8)
    # Tests run without a cluster: give the session its own checkpoint folder.
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="churnlab-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_sources(spark):
    from churnlab.sources.fixtures import loaded_sources

    return loaded_sources(spark, SF_SMALL)
