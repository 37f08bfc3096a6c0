"""Determinism and distributional properties of the resampling operators,
and the distributed running total against brute force."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlens.operators import experiments as X
from feedlens.operators import power as Q
from feedlens.operators.prefix import running_total_below
from feedlens.sources.fixtures import feed_actions
from tests.conftest import SF001


def test_running_total_brute_force(spark):
    rng = np.random.default_rng(1)
    vals = np.unique(rng.normal(size=500))
    w = rng.integers(0, 10, len(vals))
    df = spark.createDataFrame([(float(v), int(x)) for v, x in zip(vals, w)], "v double, w long")
    for buckets in (1, 7, 64):
        got = sorted((r.v, r.w_below) for r in running_total_below(df, "v", ["w"], buckets).collect())
        expect = np.concatenate([[0], np.cumsum(w)[:-1]])
        assert [g[1] for g in got] == list(expect)


@pytest.mark.skipif(not os.path.exists(SF001), reason="test data missing")
def test_bootstrap_partition_independent(spark):
    users = X.experiment_users(feed_actions(spark, SF001), "2024-01-15", "2024-01-21")
    a = sorted(X.poisson_bootstrap(users.repartition(1), n=50, seed=5).collect())
    b = sorted(X.poisson_bootstrap(users.repartition(13), n=50, seed=5).collect())
    assert a == b
    c = sorted(X.poisson_bootstrap(users, n=50, seed=6).collect())
    assert a != c


@pytest.mark.skipif(not os.path.exists(SF001), reason="test data missing")
def test_bootstrap_interval_brackets_observed(spark):
    users = X.experiment_users(feed_actions(spark, SF001), "2024-01-15", "2024-01-21")
    ci = X.bootstrap_ci(X.poisson_bootstrap(users, n=400, seed=1)).first()
    g = {r.exp_group: r.global_ctr for r in X.global_ctr(users).collect()}
    observed = g[2] - g[1]
    assert ci.ci_lo < observed < ci.ci_hi
    assert ci.n_boot == 400


PERIOD = ("2024-01-08", "2024-01-14")


def _power(spark, size=None, **kw):
    feed = feed_actions(spark, SF001)
    frame = Q.group_size(feed, *PERIOD) if size is None else spark.createDataFrame([(size,)], "group_size long")
    return Q.expected_power(Q.views_distribution(feed, *PERIOD), Q.ctr_distribution(feed, *PERIOD), frame, **kw).first()


@pytest.mark.skipif(not os.path.exists(SF001), reason="test data missing")
def test_power_zero_effect_is_alpha(spark):
    assert _power(spark, effect_probability=0.0).power == pytest.approx(0.05, abs=1e-8)


@pytest.mark.skipif(not os.path.exists(SF001), reason="test data missing")
def test_power_grows_with_the_group(spark):
    small, big = (_power(spark, size=n, views_threshold=0).power for n in (50, 5000))
    assert 0.05 < small < big <= 1


@pytest.mark.skipif(not os.path.exists(SF001), reason="test data missing")
def test_power_agrees_with_drawn_experiments(spark):
    feed = feed_actions(spark, SF001)
    v, c = (d.toPandas() for d in (Q.views_distribution(feed, *PERIOD), Q.ctr_distribution(feed, *PERIOD)))
    rng, n, runs = np.random.default_rng(2), 300, 2000
    draw = lambda d, x: rng.choice(d[x].to_numpy(), (runs, n), p=(d["users"] / d["users"].sum()).to_numpy())
    groups = []
    for extra in (0, 1):
        views, rate = draw(v, "views"), np.minimum(draw(c, "ctr"), 1)
        views = views + extra * (rng.random((runs, n)) < 0.9) * rng.integers(1, 3, (runs, n)) * (views >= 2)
        groups.append(rng.binomial(views, rate))
    a, b = groups
    t = (b.mean(1) - a.mean(1)) / np.sqrt((a.var(1, ddof=1) + b.var(1, ddof=1)) / n)
    assert _power(spark, size=n, views_threshold=2).power == pytest.approx((np.abs(t) > 1.96).mean(), abs=0.04)


def test_histogram_counts(spark):
    df = spark.createDataFrame([(1, float(x)) for x in range(10)] + [(2, 9.0)], "exp_group int, ctr double")
    h = X.histogram(df, "ctr", "exp_group", 3).collect()
    by = {}
    for r in h:
        by.setdefault(r.exp_group, {})[r.bin] = r["count"]
    assert by[1] == {0: 3, 1: 3, 2: 4}
    assert by[2] == {0: 0, 1: 0, 2: 1}
    assert F is not None


def test_message_directions_under_skew(spark):
    """One sender and one receiver carry a third of all messages each; the
    two-level aggregation equals a brute-force count."""
    import datetime as dt

    import pandas as pd

    from feedlens.operators.cube import message_user_day
    from tests.conftest import msg_df

    rng = np.random.default_rng(11)
    n = 3000
    senders = np.where(rng.random(n) < 1 / 3, 7, rng.integers(0, 60, n))
    receivers = np.where(rng.random(n) < 1 / 3, 9, rng.integers(0, 60, n))
    days = rng.integers(0, 3, n)
    rows = [(int(s), int(r), dt.datetime(2024, 1, 10 + int(d), 12)) for s, r, d in zip(senders, receivers, days)]
    got = {(r.event_date.day, r.user_id): (r.messages_sent, r.users_sent, r.messages_received, r.users_received) for r in message_user_day(msg_df(spark, rows)).collect()}
    pdf = pd.DataFrame({"s": senders, "r": receivers, "d": 10 + days})
    want = {}
    for (d, u), g in pdf.groupby(["d", "s"]):
        want[(d, u)] = [len(g), g["r"].nunique(), 0, 0]
    for (d, u), g in pdf.groupby(["d", "r"]):
        w = want.setdefault((d, u), [0, 0, 0, 0])
        w[2], w[3] = len(g), g["s"].nunique()
    assert got == {k: tuple(v) for k, v in want.items()}


@pytest.mark.skipif(not os.path.exists(SF001), reason="test data missing")
def test_power_joint(spark):
    feed = feed_actions(spark, SF001)
    joint = Q.joint_distribution(feed, *PERIOD)
    assert joint.agg(F.sum("users")).first()[0] == Q.group_size(feed, *PERIOD).first()["users"]
    assert _power(spark, effect_probability=0.0, joint_dist=joint).power == pytest.approx(0.05, abs=1e-8)


@pytest.mark.skipif(not os.path.exists(SF001), reason="test data missing")
def test_gone_equals_active_minus_retained(spark):
    import datetime as dt

    from feedlens.operators import retention as R

    feed = feed_actions(spark, SF001).filter(F.col("event_id") % 9 == 0)
    flow = {(r.week, r.status): r.users for r in R.weekly_user_flow(feed).collect()}
    active = {r.week: r.n for r in R.user_weeks(feed).groupBy("week").agg(F.count("*").alias("n")).collect()}
    for week, n in active.items():
        nxt = week + dt.timedelta(days=7)
        retained_next = flow.get((nxt, "retained"), 0)
        assert flow.get((nxt, "gone"), 0) == -(n - retained_next)


@pytest.mark.skipif(not os.path.exists(SF001), reason="test data missing")
def test_service_split_adds_up(spark):
    from feedlens.operators import services as M
    from feedlens.sources.fixtures import message_actions

    feed, msgs = feed_actions(spark, SF001), message_actions(spark, SF001)
    split = {r.day: r.both_users + r.messenger_only_users + r.feed_only_users for r in M.service_split_daily(feed, msgs, "2024-01-31").collect()}
    day = F.to_date("time")
    users = (
        feed.select(day.alias("day"), "user_id")
        .unionByName(msgs.select(day.alias("day"), "user_id"))
        .filter(F.col("day").between(F.lit("2024-01-24").cast("date"), F.lit("2024-01-30").cast("date")))
        .groupBy("day")
        .agg(F.count_distinct("user_id").alias("n"))
    )
    assert split == {r.day: r.n for r in users.collect()}


@pytest.mark.skipif(not os.path.exists(SF001), reason="test data missing")
def test_ab_summary_consistent_with_single_tests(spark):
    from feedlens.plans.ab_analysis import ab_summary

    feed = feed_actions(spark, SF001)
    rows = {r.test: r for r in ab_summary(feed, "2024-01-15", "2024-01-21", n_bootstrap=200).collect()}
    assert set(rows) == {
        "welch_ctr",
        "mann_whitney_ctr",
        "welch_smoothed_ctr",
        "bootstrap_ctr_difference",
        "welch_bucket_ctr",
        "mann_whitney_bucket_ctr_less",
    }
    users = X.experiment_users(feed, "2024-01-15", "2024-01-21")
    single = X.welch_ttest(users, "ctr").first()
    assert rows["welch_ctr"].p_value == pytest.approx(single.p_value)
    assert rows["welch_ctr"].significant == single.significant
    b = rows["bootstrap_ctr_difference"]
    assert b.ci_lo <= b.statistic <= b.ci_hi
