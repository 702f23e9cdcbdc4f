import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from touchcredit.session import local_session

    s = local_session(4, shuffle_partitions=4, app="touchcredit-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tc-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh folder per test (never reused, never cleaned by rm)."""
    return tempfile.mkdtemp(prefix="tc-test-")


TOUCH_SCHEMA = "user_pseudo_id string, ga_session_id bigint, touchpoint_us bigint, channel string"
CONV_SCHEMA = ("conversion_id string, user_pseudo_id string, conversion_date string, "
               "conversion_us bigint, purchase_revenue double")
DAY = 86_400_000_000


def conv_row(user, us, revenue=10.0, date="20240115"):
    cid = None if user is None else f"{user}-{us}"
    return (cid, user, date, us, revenue)
