"""Hand-made fixtures with expected rows (one per semantic trap)."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from feedlens.functions.columns import age_band_bot, age_band_etl
from feedlens.operators import cube as C
from feedlens.operators import engagement as E
from feedlens.operators import retention as R
from feedlens.operators import services as M
from feedlens.session import shared_path
from feedlens.sources.fixtures import feed_actions, message_actions
from tests.conftest import SF001, feed_df, msg_df, ts

D = dt.date


def test_weekly_flow(spark):
    w = ["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2024-01-29"]
    rows = [(1, ts(w[0]), "view", 1), (1, ts(w[1]), "view", 1), (1, ts(w[3]), "view", 1), (2, ts(w[0]), "view", 1), (3, ts(w[1]), "view", 1)]
    got = {(r.week.isoformat(), r.status): r.users for r in R.weekly_user_flow(feed_df(spark, rows)).collect()}
    assert got == {
        (w[0], "new"): 2,
        (w[1], "retained"): 1,
        (w[1], "new"): 1,
        (w[1], "gone"): -1,
        (w[2], "gone"): -2,
        (w[3], "new"): 1,
        (w[4], "gone"): -1,
    }


def test_new_plus_retained_is_active(spark):
    feed = feed_actions(spark, SF001).filter(F.col("event_id") % 9 == 0)
    nr = R.weekly_new_retained(feed).groupBy("week").agg(F.sum("users").alias("n"))
    active = R.user_weeks(feed).groupBy("week").agg(F.count("*").alias("n"))
    assert sorted(nr.collect()) == sorted(active.collect())
    flow = {(r.week.isoformat(), r.status): r.users for r in R.weekly_user_flow(feed).collect()}
    assert flow[("2024-01-01", "new")] == 93
    assert flow[("2024-01-15", "gone")] == -32


def test_age_bands(spark):
    ages = [17, 18, 24, 25, 34, 35, 44, 45, 60, 61, 64, 65, -1, None]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    got = {r.age: (r.etl, r.bot) for r in df.select("age", age_band_etl("age").alias("etl"), age_band_bot("age").alias("bot")).collect()}
    assert got[60] == ("45-60", "45-64")
    assert got[61] == ("старше 60", "45-64")
    assert got[64] == ("старше 60", "45-64")
    assert got[65] == ("старше 60", "65+")
    assert got[17] == ("<18", "<18")
    assert got[18] == ("18-24", "18-24")
    assert got[-1] == (None, "<18")
    assert got[None] == (None, None)


def _cube(spark, feed_rows, msg_rows, profile="all"):
    return C.build_cube(feed_df(spark, feed_rows), msg_df(spark, msg_rows), profile=profile)


def test_empty_age_band_and_distinct_senders(spark):
    day = "2024-01-10"
    feed = [(1, ts(day), "view", 1, 0, 30, "RU", "x", "iOS")]
    msgs = [
        (2, 1, ts(day), 1, 40, "RU", "x", "Android"),
        (2, 1, ts(day, "13:00:00"), 1, 40, "RU", "x", "Android"),
        (3, 1, ts(day), 0, 50, "RU", "x", "Android"),
    ]
    cube, marg = _cube(spark, feed, msgs)
    ages = {r.dimension_value: r for r in marg.filter("dimension = 'age'").collect()}
    assert set(ages) == {"<18", "18-24", "25-34", "35-44", "45-60", "старше 60"}
    assert ages["<18"].views == 0 and ages["<18"].messages_sent == 0
    u1 = [r for r in cube.collect() if r.user_id == 1]
    assert sum(r.messages_received for r in u1) == 3
    assert sum(r.users_received for r in u1) == 2


def test_null_safe_outer_join(spark):
    day = D(2024, 1, 10)
    f = spark.createDataFrame([(1, day, None, None, "iOS", 2, 5)], "user_id long, event_date date, gender int, age int, os string, likes long, views long")
    m = spark.createDataFrame(
        [(1, day, None, None, "iOS", 1, 1, 0, 0)],
        "user_id long, event_date date, gender int, age int, os string, messages_sent long, users_sent long, messages_received long, users_received long",
    )
    rows = C.user_day_cube(f, m).collect()
    assert len(rows) == 1
    assert (rows[0].likes, rows[0].views, rows[0].messages_sent) == (2, 5, 1)


def test_profile_fan_out(spark):
    day = "2024-01-10"
    msgs = [
        (5, 6, ts(day, "10:00:00"), 1, 30, "RU", "x", "iOS"),
        (5, 7, ts(day, "11:00:00"), 1, 30, "RU", "x", "Android"),
        (5, 8, ts(day, "12:00:00"), 1, 30, "RU", "x", "Android"),
    ]
    _, marg_all = _cube(spark, [], msgs, "all")
    os_all = {r.dimension_value: r.messages_sent for r in marg_all.filter("dimension = 'os'").collect()}
    assert os_all == {"iOS": 3, "Android": 3}
    _, marg_latest = _cube(spark, [], msgs, "latest")
    os_latest = {r.dimension_value: r.messages_sent for r in marg_latest.filter("dimension = 'os'").collect()}
    assert os_latest == {"Android": 3}


def test_receiver_without_profile(spark):
    day = "2024-01-10"
    msgs = [(5, 9, ts(day), 1, 30, "RU", "x", "iOS"), (5, 9, ts(day, "13:00:00"), 1, 30, "RU", "x", "iOS")]
    cube, marg = _cube(spark, [], msgs)
    r9 = [r for r in cube.collect() if r.user_id == 9]
    assert len(r9) == 1 and r9[0].os is None and r9[0].messages_received == 2
    assert sum(r.messages_received for r in marg.filter("dimension = 'os'").collect()) == 0
    dq = C.cube_null_keys(cube).first()
    assert dq.messages_received == 2


def test_midnight_boundaries(spark):
    rows = [(1, dt.datetime(2024, 1, 9, 23, 59, 59, 999999), "view", 1), (1, dt.datetime(2024, 1, 10, 0, 0, 0), "view", 1)]
    daily = {r.day: r.views for r in E.feed_daily(feed_df(spark, rows)).collect()}
    assert daily == {D(2024, 1, 9): 1, D(2024, 1, 10): 1}
    both = E.feed_daily(feed_df(spark, rows), "2024-01-09", "2024-01-10").count()
    assert both == 2


def test_zero_views_ctr_is_null(spark):
    rows = [(1, ts("2024-01-15"), "like", 1), (2, ts("2024-01-15"), "view", 1), (2, ts("2024-01-15"), "like", 1)]
    users = E.user_ctr(feed_df(spark, rows), "2024-01-15", "2024-01-21")
    got = {r.user_id: r.ctr for r in users.collect()}
    assert got[1] is None and got[2] == 1.0
    from feedlens.operators.experiments import smoothed_ctr

    sm = {r.user_id: r.smoothed_ctr for r in smoothed_ctr(users, 5.0).collect()}
    g = 2 / 1
    assert sm[1] == pytest.approx((1 + 5 * g) / 5)


def test_missing_previous_day(spark):
    df = spark.createDataFrame([(D(2024, 1, 10), 5), (D(2024, 1, 12), 4), (D(2024, 1, 13), 8)], "day date, x long")
    got = {(r.day, r.metric): r.pct_change for r in M.day_over_day(df, ["x"]).collect()}
    assert got[(D(2024, 1, 12), "x")] is None
    assert got[(D(2024, 1, 13), "x")] == pytest.approx(100.0)


@pytest.mark.skipif(not os.path.exists(SF001), reason="test data missing")
def test_cube_day_values(spark):
    feed, msgs = feed_actions(spark, SF001), message_actions(spark, SF001)
    cube, marg = C.build_cube(feed, msgs, "2024-01-30", "2024-01-30")
    cols = ["likes", "views", "messages_sent", "users_sent", "messages_received", "users_received"]
    os_rows = {r.dimension_value: tuple(r[c] for c in cols) for r in marg.filter("dimension = 'os'").collect()}
    assert os_rows["Android"] == (46, 94, 85, 83, 91, 90)
    assert os_rows["iOS"] == (17, 47, 74, 72, 76, 74)
    assert cube.count() == 178
    assert C.cube_null_keys(cube).count() == 0  # every receiver of the fixtures has sent as well


def test_top3_tie_by_name(spark):
    day = "2024-01-30"
    feed, msgs = [], []
    for i, c in enumerate(["DE", "AR", "CN", "BR"]):
        feed.append((i, ts(day), "view", 1, 0, 30, c, "x", "iOS"))
        msgs.append((i, 100, ts(day), 0, 30, c, "x", "iOS"))
    top = M.service_top_countries(feed_df(spark, feed), msg_df(spark, msgs), "2024-01-31").collect()
    assert [r.country for r in top] == ["AR", "BR", "CN"]


def test_service_split_receivers(spark):
    day = "2024-01-30"
    feed = [(1, ts(day), "view", 1), (3, ts(day), "view", 1)]
    msgs = [(1, 2, ts(day)), (2, 4, ts(day))]
    f, m = feed_df(spark, feed), msg_df(spark, msgs)
    s = M.service_split_daily(f, m, "2024-01-31").filter(F.col("day") == D(2024, 1, 30)).first()
    assert (s.both_users, s.messenger_only_users, s.feed_only_users) == (1, 1, 1)
    s2 = M.service_split_daily(f, m, "2024-01-31", include_receivers=True).filter(F.col("day") == D(2024, 1, 30)).first()
    assert (s2.both_users, s2.messenger_only_users, s2.feed_only_users) == (1, 2, 1)


@pytest.mark.skipif(not os.path.exists(SF001), reason="test data missing")
def test_idempotent_publish(spark):
    import uuid

    feed, msgs = feed_actions(spark, SF001), message_actions(spark, SF001)
    target = shared_path(spark, f"test-cube-{uuid.uuid4().hex}")
    _, day1 = C.build_cube(feed, msgs, "2024-01-29", "2024-01-29")
    _, day2 = C.build_cube(feed, msgs, "2024-01-30", "2024-01-30")
    C.publish_cube(day1, target)
    C.publish_cube(day2, target)
    once = sorted(C.read_cube(spark, target).collect())
    C.publish_cube(day2, target)  # a retry of the same day
    twice = sorted(C.read_cube(spark, target).collect())
    assert once == twice
    assert len(once) == day1.count() + day2.count()


@pytest.mark.skipif(not os.path.exists(SF001), reason="test data missing")
def test_cube_marginals_sum_to_totals(spark):
    feed, msgs = feed_actions(spark, SF001), message_actions(spark, SF001)
    cube, marg = C.build_cube(feed, msgs)
    cols = ["likes", "views", "messages_sent", "users_sent", "messages_received", "users_received"]
    for dim, key in [("gender", "gender"), ("os", "os"), ("age", "age")]:
        m = marg.filter(F.col("dimension") == dim).agg(*[F.sum(c).alias(c) for c in cols]).first()
        t = cube.filter(F.col(key).isNotNull()).agg(*[F.sum(c).alias(c) for c in cols]).first()
        assert tuple(m) == tuple(t), dim


@pytest.mark.skipif(not os.path.exists(SF001), reason="test data missing")
def test_daily_job_publishes_yesterday(spark):
    import uuid

    from feedlens.plans.daily_cube import run_daily_cube

    feed, msgs = feed_actions(spark, SF001), message_actions(spark, SF001)
    target = shared_path(spark, f"test-daily-{uuid.uuid4().hex}")
    run_daily_cube(feed, msgs, "2024-01-31", target)
    run_daily_cube(feed, msgs, "2024-01-31", target)  # a retry
    got = sorted(tuple(r) for r in C.read_cube(spark, target).collect())
    _, want = C.build_cube(feed, msgs, "2024-01-30", "2024-01-30")
    assert got == sorted(tuple(r) for r in want.collect())
    assert {r[0] for r in got} == {D(2024, 1, 30)}


def test_report_half_even_rounding(spark):
    from feedlens.operators.report import feed_report

    rows = [(1, ts("2024-01-30"), "view", 1)] * 8 + [(1, ts("2024-01-30"), "like", 1)]
    r = {x.metric: x.value for x in feed_report(feed_df(spark, rows), "2024-01-31", ctr_digits=2).collect()}
    assert r["ctr"] == 0.12  # 1/8 = 0.125 -> half-to-even


@pytest.mark.skipif(not os.path.exists(SF001), reason="test data missing")
def test_cube_catalog_table(spark):
    import uuid

    feed, msgs = feed_actions(spark, SF001), message_actions(spark, SF001)
    name = f"cube_{uuid.uuid4().hex[:8]}"
    loc = shared_path(spark, f"test-table-{name}")
    C.create_cube_table(spark, name, loc)
    C.create_cube_table(spark, name, loc)  # if absent: a second call is a no-op
    _, d29 = C.build_cube(feed, msgs, "2024-01-29", "2024-01-29")
    _, d30 = C.build_cube(feed, msgs, "2024-01-30", "2024-01-30")
    C.publish_cube_table(d29, name)
    C.publish_cube_table(d30, name)
    C.publish_cube_table(d30, name)  # retry of one day
    got = spark.table(name)
    assert got.count() == d29.count() + d30.count()
    assert sorted(r.event_date for r in got.select("event_date").distinct().collect()) == [D(2024, 1, 29), D(2024, 1, 30)]
