"""Signed deltas against a full rebuild, and publications that fail their checks."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from feedlens.operators import cube as C
from feedlens.operators import cube_upkeep as U
from feedlens.sources.schemas import MEASURES
from tests.conftest import feed_df, msg_df

DAYS = [dt.date(2024, 1, d) for d in range(1, 7)]
LATE = dt.date(2024, 1, 5)


def drawn(spark, seed):
    rng = random.Random(seed)
    at = lambda d: dt.datetime(d.year, d.month, d.day, rng.randrange(24), rng.randrange(60))
    person = lambda u: (u % 2, 10 + 7 * u, "c", "x", rng.choice(["iOS", "Android"]) if u % 4 == 0 else "iOS")
    feed, msgs = [], []
    for d in DAYS:
        for u in range(12):
            if rng.random() < 0.5:
                g, a, country, city, os_ = person(u)
                feed.append((u, at(d), rng.choice(["view", "like"]), 1, g, a, country, city, os_, "ads"))
            # Some send on late days only: before, their days had no profile.
            if rng.random() < 0.4 and not (u in (3, 6, 9) and d < LATE):
                g, a, country, city, os_ = person(u)
                msgs.append((u, rng.randrange(14), at(d), g if u != 5 else None, a, country, city, os_ if u != 7 else rng.choice(["iOS", None]), "ads"))
    return feed_df(spark, feed), msg_df(spark, msgs)


def rows(df):
    return sorted((str(r.event_date), r.dimension, r.dimension_value, *[r[m] for m in MEASURES]) for r in df.collect())


def published(spark, feed, msgs, target, profile):
    early = F.to_date("time") < F.lit(LATE)
    before, arrived = C.profile_tuples(msgs.where(early)), C.profile_tuples(msgs.where(~early))
    user_days, marginals = C.build_cube(feed.where(early), msgs.where(early), profile=profile, tuples=before)
    U.publish_checked(marginals, target, "first", {**U.CHECKS, "totals": U.totals_of(user_days)})
    return C.message_user_day(msgs.where(early)), before, arrived


@pytest.mark.parametrize("profile", ["all", "latest"])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_full_rebuild(spark, tmp_path, seed, profile):
    feed, msgs = drawn(spark, seed)
    target = str(tmp_path / "cube")
    days, before, arrived = published(spark, feed, msgs, target, profile)
    old = rows(C.read_cube(spark, target))
    touched = U.apply_late_profiles(target, days, before, arrived, "late", profile)
    early = F.to_date("time") < F.lit(LATE)
    _, rebuilt = C.build_cube(feed.where(early), msgs.where(early), profile=profile, tuples=C.profile_tuples(msgs))
    want = rows(rebuilt)
    assert rows(C.read_cube(spark, target)) == want != old
    assert U.apply_late_profiles(target, days, before, arrived, "late", profile) == touched
    assert rows(C.read_cube(spark, target)) == want  # a second run counts nothing twice


def test_only_touched_days_are_rewritten(spark, tmp_path):
    at = lambda d, h=9: dt.datetime(2024, 1, d, h)
    feed = feed_df(spark, [(1, at(d), "view", 1, 0, 20, "c", "x", "iOS", "ads") for d in (1, 2, 3)])
    person = lambda os_: (1, 30, "c", "x", os_, "ads")
    msgs = msg_df(spark, [(8, 9, at(1), *person("iOS")), (2, 8, at(3), *person("iOS")), (9, 8, at(5), *person("Android"))])
    target = str(tmp_path / "cube")
    days, before, arrived = published(spark, feed, msgs, target, "all")
    files = lambda: {d: sorted(os.listdir(f"{target}/{d}")) for d in os.listdir(target) if d.startswith("event_date")}
    old = files()
    assert U.apply_late_profiles(target, days, before, arrived, "late") == [dt.date(2024, 1, 1)]  # user 9 received that day
    new = files()
    assert {d for d in old if old[d] != new[d]} == {"event_date=2024-01-01"}
    # Tuples that are known already touch nothing.
    assert U.apply_late_profiles(target, days, before, before, "again") == [] and files() == new


@pytest.mark.parametrize(
    "fault,name",
    [
        (lambda c: c.withColumn("dimension_value", F.expr("nullif(dimension_value, 'iOS')")), "null keys"),
        (lambda c: c.unionByName(c.where("dimension = 'os'")), "repeated keys"),
        (lambda c: c.withColumn("views", F.when(F.col("dimension") == "os", -1).otherwise(F.col("views"))), "negative measures"),
        (lambda c: c.where("dimension_value <> '<18'"), "age labels"),
        (lambda c: c.withColumn("likes", F.when(F.col("dimension") == "gender", F.col("likes") + 1).otherwise(F.col("likes"))), "totals"),
        (lambda c: c.where("dimension <> 'os'"), "totals"),
    ],
)
def test_a_failed_check_leaves_the_old_day(spark, tmp_path, fault, name):
    feed, msgs = drawn(spark, 3)
    target = str(tmp_path / "cube")
    published(spark, feed, msgs, target, "all")
    old = rows(C.read_cube(spark, target))
    user_days, marginals = C.build_cube(feed, msgs)
    checks = {**U.CHECKS, "totals": U.totals_of(user_days)}
    with pytest.raises(U.CheckFailed, match=name):
        U.publish_checked(fault(marginals), target, "second", checks)
    assert rows(C.read_cube(spark, target)) == old
    U.publish_checked(marginals, target, "third", checks)
    assert rows(C.read_cube(spark, target)) == rows(marginals)
