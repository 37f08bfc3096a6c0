"""Kept bitmaps and sketches against counts of the events themselves."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from feedlens.operators import distinct_index as D
from feedlens.operators import retention as R
from feedlens.operators.engagement import feed_daily, feed_summary
from tests.conftest import feed_df

DAYS = [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(24)]


@pytest.fixture(scope="module")
def feed(spark):
    """Ids of either sign over several blocks, days without events, null users."""
    rng = random.Random(3)
    ids = [rng.choice([1, -1]) * rng.randrange(200_000) for _ in range(300)] + [0, 1, -1, 32767, 32768, 32769, -32768, 999_999]
    rows = []
    for u in ids:
        for d in DAYS:
            if d.day not in (9, 10) and rng.random() < 0.2:
                rows.append((u, dt.datetime(d.year, d.month, d.day, rng.randrange(24)), rng.choice(["view", "like"]), 1, 0, 20, rng.choice(["A", "B", None]), "c", rng.choice(["iOS", "Android", None]), "ads"))
    return feed_df(spark, rows).withColumn("user_id", F.expr("nullif(user_id, 999999)"))


def events(feed):
    return {(r.user_id, r.time.date(), r.os, r.country) for r in feed.collect() if r.user_id is not None}


@pytest.fixture(scope="module")
def index(spark, feed, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "bits")
    some = feed.where(F.to_date("time") <= "2024-01-12")
    D.keep_days(D.bitmap_index(some, ("os", "country")), path)
    D.keep_days(D.bitmap_index(feed.where(F.to_date("time") >= "2024-01-12"), ("os", "country")), path)  # a day twice
    return D.read_index(spark, path)


def test_any_range(feed, index):
    ev = events(feed)
    for a, b in ((0, 0), (0, 23), (5, 11), (8, 9), (20, 30)):
        start, end = DAYS[0] + dt.timedelta(a), DAYS[0] + dt.timedelta(b)
        inside = [e for e in ev if start <= e[1] <= end]
        assert D.distinct_users(index, start, end).first().users == len({e[0] for e in inside})
        by = {r.os: r.users for r in D.distinct_users(index, start, end, ("os",)).collect()}
        assert by == {o: len({e[0] for e in inside if e[2] == o}) for o in {e[2] for e in inside}}


@pytest.mark.parametrize("days", [1, 7])
def test_trailing_days(feed, index, days):
    ev, got = events(feed), {r.day: r.users for r in D.active_users(index, days).collect()}
    last = max(e[1] for e in ev)
    want = {d: len({e[0] for e in ev if 0 <= (d - e[1]).days < days}) for d in DAYS if d <= last}
    assert got == {d: n for d, n in want.items() if n}


def test_cohorts_equal_the_user_form(feed, index):
    exact = sorted(map(tuple, R.cohort_retention(feed.where("user_id IS NOT NULL")).collect()))
    assert sorted(map(tuple, D.cohort_retention(index).collect())) == exact and len(exact) == 10


def test_count_reads_no_events(index):
    plan = D.distinct_users(index, "2024-01-08", "2024-01-14")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "user_id" not in plan


def test_sketches(spark, feed, tmp_path):
    """The union of kept days is the sketch of the range, and its error is small."""
    many = spark.range(60_000).select("id", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("d"))
    many = many.select(F.col("id").alias("user_id"), F.timestamp_seconds(F.col("d") * 86400 + 1704103200).alias("time"), F.expr("if(id % 3 = 0, 'a', null)").alias("os"))
    many = many.where(F.pmod(F.xxhash64("user_id", "time"), F.lit(3)) == 0)
    D.keep_days(D.sketch_index(many, ("os",)), str(tmp_path / "hll"))
    index = D.read_index(spark, str(tmp_path / "hll"))
    assert index.count() == 14
    got = D.approx_users(index, "2024-01-01", "2024-01-07").first().users
    whole = many.agg(F.hll_sketch_estimate(F.hll_sketch_agg("user_id", D.SKETCH_LOG2))).first()[0]
    exact = many.select("user_id").distinct().count()
    assert got == pytest.approx(whole, rel=1e-3) and got == pytest.approx(exact, rel=4 * D.sketch_error())
    by = {r.os: r.users for r in D.approx_users(index, "2024-01-02", "2024-01-03", ("os",)).collect()}
    want = {r.os: r.n for r in many.where(F.to_date("time").between("2024-01-02", "2024-01-03")).groupBy("os").agg(F.count_distinct("user_id").alias("n")).collect()}
    assert by.keys() == want.keys() == {"a", None} and all(by[k] == pytest.approx(want[k], rel=4 * D.sketch_error()) for k in want)


def test_approximate_forms_of_the_daily_counts(feed):
    """``exact=False`` (A7) is near the exact counts; Spark's default error is 5 percent."""
    exact, near = ({r.day: r.dau for r in feed_daily(feed, exact=e).collect()} for e in (True, False))
    assert exact.keys() == near.keys() and all(near[d] == pytest.approx(n, rel=0.2) for d, n in exact.items())
    assert feed_summary(feed, "2024-01-06", exact=False).first().dau == pytest.approx(feed_summary(feed, "2024-01-06").first().dau, rel=0.2)


def test_empty_feed(spark, feed):
    none = D.bitmap_index(feed.where("false"), ("os",))
    assert D.distinct_users(none, "2024-01-01", "2024-01-07").first().users == 0
    assert D.active_users(none, 7).collect() == [] and D.cohort_retention(none).collect() == []
    assert D.approx_users(D.sketch_index(feed.where("false")), "2024-01-01", "2024-01-07").first().users == 0
