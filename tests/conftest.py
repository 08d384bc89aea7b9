import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerlake.session import build_session, checkpoint_root
    s = build_session("local[4]", app="ledgerlake-tests", shuffle_partitions=8)
    checkpoint_root(s)  # sets a local checkpoint folder only when the session names none
    yield s
    s.stop()


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
