import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from auctide.session import build_session
    s = build_session("local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def panel(spark):
    from auctide.session import stored
    from auctide.sources.snapshots import snapshots
    # written, not cached: a cached plan would stand in for the queries' own in every test that comes later
    return stored(snapshots(spark, SF_SMALL), "test-panel")
