from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from feedlens.sources.schemas import FEED, MESSAGES  # noqa: E402

SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from feedlens.session import local_session

    s = local_session(4, shuffle_partitions=4, app="feedlens-tests")
    yield s
    s.stop()


def ts(day: str, hms: str = "12:00:00") -> dt.datetime:
    return dt.datetime.fromisoformat(f"{day} {hms}")


def feed_df(spark, rows):
    """rows: (user_id, time, action, exp_group, gender, age, country, city, os, source)."""
    full = [tuple(r) + (None,) * (len(FEED.fields) - len(r)) for r in rows]
    return spark.createDataFrame(full, FEED)


def msg_df(spark, rows):
    """rows: (user_id, receiver_id, time, gender, age, country, city, os, source)."""
    full = [tuple(r) + (None,) * (len(MESSAGES.fields) - len(r)) for r in rows]
    return spark.createDataFrame(full, MESSAGES)
