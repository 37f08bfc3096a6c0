"""Typed readers accept the declared schemas and reject a mismatch."""

from __future__ import annotations

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from feedlens.session import shared_path
from feedlens.sources import read_feed, read_messages
from feedlens.sources.fixtures import feed_actions, message_actions
from feedlens.sources.schemas import FEED, MESSAGES
from tests.conftest import SF001, msg_df, ts


@pytest.mark.skipif(not os.path.exists(SF001), reason="test data missing")
def test_readers_round_trip(spark):
    base = shared_path(spark, f"test-src-{uuid.uuid4().hex}")
    feed_actions(spark, SF001).write.parquet(f"{base}/feed")
    message_actions(spark, SF001).write.parquet(f"{base}/msgs")
    f = read_feed(spark, f"{base}/feed")
    m = read_messages(spark, f"{base}/msgs")
    assert f.columns == FEED.fieldNames() and m.columns == MESSAGES.fieldNames()
    assert f.count() == feed_actions(spark, SF001).count()


def test_reader_rejects_mismatch(spark):
    base = shared_path(spark, f"test-src-{uuid.uuid4().hex}")
    spark.range(3).select(F.col("id").alias("user_id"), F.lit("x").alias("time")).write.parquet(base)
    with pytest.raises(ValueError, match="time"):
        read_feed(spark, base)


@pytest.mark.skipif(not os.path.exists(SF001), reason="test data missing")
def test_day_partitions_are_pruned(spark):
    from feedlens.operators import cube as C
    from feedlens.operators import engagement as E
    from feedlens.operators import services as M

    base = shared_path(spark, f"test-part-{uuid.uuid4().hex}")
    feed_fx, msgs_fx = feed_actions(spark, SF001), message_actions(spark, SF001)
    feed_fx.withColumn("dt", F.to_date("time")).write.partitionBy("dt").parquet(f"{base}/feed")
    msgs_fx.withColumn("dt", F.to_date("time")).write.partitionBy("dt").parquet(f"{base}/msgs")
    feed, msgs = read_feed(spark, f"{base}/feed", "dt"), read_messages(spark, f"{base}/msgs", "dt")

    summary = E.feed_summary(feed, "2024-01-31")
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "2024-01-30" in plan
    assert summary.collect() == E.feed_summary(feed_fx, "2024-01-31").collect()

    _, cube_p = C.build_cube(feed, msgs, "2024-01-30", "2024-01-30")
    _, cube_f = C.build_cube(feed_fx, msgs_fx, "2024-01-30", "2024-01-30")
    assert sorted(cube_p.collect()) == sorted(cube_f.collect())

    split_p = M.service_split_daily(feed, msgs, "2024-01-31")
    assert "PartitionFilters: [isnotnull(dt" in split_p._jdf.queryExecution().executedPlan().toString()
    assert sorted(split_p.collect()) == sorted(M.service_split_daily(feed_fx, msgs_fx, "2024-01-31").collect())


@pytest.mark.skipif(not os.path.exists(SF001), reason="test data missing")
def test_late_rows_are_kept(spark):
    """A partition by ingestion day: a row of the 30th lies in the one of the 31st."""
    from feedlens.operators import engagement as E

    base = shared_path(spark, f"test-late-{uuid.uuid4().hex}")
    feed_fx = feed_actions(spark, SF001)
    late = F.when(F.col("event_id") % 3 == 0, F.date_add(F.to_date("time"), 1)).otherwise(F.to_date("time"))
    feed_fx.withColumn("dt", late).write.partitionBy("dt").parquet(base)
    expect = E.feed_summary(feed_fx, "2024-01-31").collect()
    assert E.feed_summary(read_feed(spark, base), "2024-01-31").collect() == expect
    pruned = E.feed_summary(read_feed(spark, base, "dt", lateness_days=1), "2024-01-31")
    assert pruned.collect() == expect
    assert "PartitionFilters: [isnotnull(dt" in pruned._jdf.queryExecution().executedPlan().toString()


def test_cli_asks_for_what_a_job_needs():
    from feedlens.plans.cli import main

    for argv in (["forecast", "--feed", "f", "--as-of", "2024-01-31", "--out", "o"], ["report", "--feed", "f", "--out", "o"], ["ab", "--feed", "f", "--start", "a", "--end", "b"]):
        with pytest.raises(SystemExit):
            main(argv)


def test_scale_conf_bounds():
    from feedlens.session import scale_conf

    assert scale_conf(10 << 20, "hdfs:///ckpt")["spark.sql.shuffle.partitions"] == "200"
    assert scale_conf(100 << 40, "hdfs:///ckpt")["spark.sql.shuffle.partitions"] == "204800"
    assert scale_conf(300 << 30, "s3://b/ckpt")["spark.checkpoint.dir"] == "s3://b/ckpt"


@pytest.mark.skipif(not os.path.exists(SF001), reason="test data missing")
def test_cli_daily_cube_and_report(spark):
    from feedlens.operators.cube import read_cube
    from feedlens.plans.cli import main

    base = shared_path(spark, f"test-cli-{uuid.uuid4().hex}")
    feed_actions(spark, SF001).withColumn("dt", F.to_date("time")).write.partitionBy("dt").parquet(f"{base}/feed")
    message_actions(spark, SF001).withColumn("dt", F.to_date("time")).write.partitionBy("dt").parquet(f"{base}/msgs")
    main(["cube", "--feed", f"{base}/feed", "--messages", f"{base}/msgs", "--as-of", "2024-01-31", "--target", f"{base}/cube"])
    cube = read_cube(spark, f"{base}/cube")
    assert cube.select("event_date").distinct().count() == 1 and cube.count() == 10
    main(["report", "--feed", f"{base}/feed", "--messages", f"{base}/msgs", "--as-of", "2024-01-31", "--out", f"{base}/report"])
    rep = spark.read.parquet(f"{base}/report")
    assert set(r.section for r in rep.select("section").distinct().collect()) == {"feed", "split", "change_pct", "os", "top_countries", "age"}


@pytest.mark.skipif(not os.path.exists(SF001), reason="test data missing")
@pytest.mark.parametrize("profile", ["all", "latest"])
def test_daily_cube_from_kept_profiles(spark, profile):
    """Three daily runs with the profile table give the cubes of the full history,
    and only the first one reads more than a day of messages."""
    from feedlens.operators.cube import build_cube, read_cube
    from feedlens.plans import daily_cube

    base = shared_path(spark, f"test-profiles-{uuid.uuid4().hex}")
    feed, msgs = feed_actions(spark, SF001), message_actions(spark, SF001)
    for as_of in ("2024-01-19", "2024-01-20", "2024-01-21"):
        daily_cube.run_daily_cube(feed, msgs, as_of, f"{base}/cube", profile, f"{base}/profiles")
        day = str(daily_cube._day_before(as_of))
        known = msgs.filter(F.to_date("time") <= F.lit(day).cast("date"))
        _, expect = build_cube(feed, known, day, day, profile)
        got = read_cube(spark, f"{base}/cube").filter(F.col("event_date") == F.lit(day).cast("date"))
        assert sorted(map(str, got.collect())) == sorted(map(str, expect.select(*got.columns).collect()))


@pytest.mark.parametrize("partition_col", ["dt", None])
def test_kept_profiles_take_late_messages(spark, partition_col):
    """A message of the 18th that arrives on the 20th is in the 20th's snapshot."""
    from feedlens.operators.cube import profile_tuples
    from feedlens.plans import daily_cube

    base = shared_path(spark, f"test-late-{uuid.uuid4().hex}")
    sent = [(1, "2024-01-18", "2024-01-18"), (2, "2024-01-19", "2024-01-19"), (3, "2024-01-18", "2024-01-20"), (4, "2024-01-20", "2024-01-20")]
    for day in ("2024-01-18", "2024-01-19", "2024-01-20"):
        for user, on, arrived in sent:
            if arrived == day:
                new = msg_df(spark, [(user, 9, ts(on), 1, 30, "x", "y", "iOS", "ads")])
                new.withColumn("dt", F.lit(arrived)).write.mode("append").partitionBy("dt").parquet(f"{base}/msgs")
        msgs = read_messages(spark, f"{base}/msgs", partition_col, 2)
        got = daily_cube.advance_profiles(msgs, dt.date.fromisoformat(day), f"{base}/profiles", 2)
        assert sorted(map(str, got.collect())) == sorted(map(str, profile_tuples(msgs).select(*got.columns).collect()))
    assert got.count() == 4
