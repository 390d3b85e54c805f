import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sluice.session import local_session
    s = local_session(8, shuffle_partitions=8, app="sluice-tests")
    yield s


def pages_df(spark, bodies, run_id="r", request_cursors=None):
    """Landed pages from literal bodies (test inputs only)."""
    from sluice.schemas import LANDED_PAGE
    rows = []
    for i, b in enumerate(bodies):
        rc = request_cursors[i] if request_cursors else None
        rows.append((run_id, i, rc, None, b))
    return spark.createDataFrame(rows, LANDED_PAGE)
