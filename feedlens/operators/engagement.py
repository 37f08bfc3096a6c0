"""Feed engagement: daily DAU / views / likes / CTR, per-user CTR, trends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.columns import as_date, safe_ratio, to_day
from feedlens.sources.schemas import PART_DAY, PART_EVENT_DAY


def is_view():
    """Predicate: the action is a view."""
    return F.col("action") == "view"


def is_like():
    """Predicate: the action is a like."""
    return F.col("action") == "like"


def _in_days(df: DataFrame, start=None, end=None, day: str = "day", end_exclusive: bool = False) -> DataFrame:
    """Closed (or half-open) day range on a day column; Catalyst pushes it to
    the timestamp scan, and it is repeated on the source's day partition when
    the frame carries one, so whole partitions are skipped."""
    lows, highs = [day], [day]
    if PART_DAY in df.columns:
        lows.append(PART_DAY)
        highs.append(PART_EVENT_DAY)
    if start is not None:
        for c in lows:
            df = df.filter(F.col(c) >= as_date(start))
    if end is not None:
        for c in highs:
            df = df.filter(F.col(c) < as_date(end)) if end_exclusive else df.filter(F.col(c) <= as_date(end))
    return df


def _users(exact: bool):
    return F.count_distinct("user_id") if exact else F.approx_count_distinct("user_id")


def feed_daily(feed: DataFrame, start=None, end=None, exact: bool = True) -> DataFrame:
    """One row per day with dau, views, likes and ctr = likes / views (NULL if no view)."""
    days = _in_days(feed.withColumn("day", to_day("time")), start, end)
    return (
        days.groupBy("day")
        .agg(
            _users(exact).alias("dau"),
            F.count_if(is_view()).alias("views"),
            F.count_if(is_like()).alias("likes"),
        )
        .withColumn("ctr", safe_ratio("likes", "views"))
    )


def feed_summary(feed: DataFrame, as_of, exact: bool = True) -> DataFrame:
    """One row for the day before ``as_of``; an empty day gives zeros, ctr NULL."""
    day = F.date_sub(as_date(as_of), 1)
    return (
        _in_days(feed.withColumn("day", to_day("time")), day, day)
        .agg(
            _users(exact).alias("dau"),
            F.count_if(is_view()).alias("views"),
            F.count_if(is_like()).alias("likes"),
        )
        .select(day.alias("day"), "dau", "views", "likes", safe_ratio("likes", "views").alias("ctr"))
    )


def user_ctr(feed: DataFrame, start=None, end=None, groups=(1, 2)) -> DataFrame:
    """Per (user_id, exp_group) likes, views and ctr over a closed day range."""
    df = _in_days(feed.withColumn("day", to_day("time")), start, end)
    if groups is not None:
        df = df.filter(F.col("exp_group").isin(*groups))
    return (
        df.groupBy("user_id", "exp_group")
        .agg(F.count_if(is_like()).alias("likes"), F.count_if(is_view()).alias("views"))
        .withColumn("ctr", safe_ratio("likes", "views"))
    )


def feed_user_day(feed: DataFrame, start=None, end=None) -> DataFrame:
    """Per (event_date, user_id, gender, age, os) likes and views."""
    df = _in_days(feed.withColumn("event_date", to_day("time")), start, end, day="event_date")
    return df.groupBy("event_date", "user_id", "gender", "age", "os").agg(
        F.count_if(is_like()).alias("likes"), F.count_if(is_view()).alias("views")
    )


TREND_METRICS = ["dau", "views", "likes", "ctr"]


def feed_trend(feed: DataFrame, as_of, days: int = 8, exact: bool = True) -> DataFrame:
    """E5: the trailing window behind the trend charts, long format (day, metric, value).

    Days from ``as_of - days`` on, except ``as_of`` itself: the reference's
    filter, which also admits any days after ``as_of`` present in the data.
    """
    d0 = as_date(as_of)
    first = F.date_sub(d0, days)
    recent = _in_days(feed.withColumn("day", to_day("time")), first).filter(F.col("day") != d0).drop("day")
    daily = feed_daily(recent, exact=exact)
    wide = daily.select("day", *[F.col(m).cast("double").alias(m) for m in TREND_METRICS])
    return wide.unpivot("day", TREND_METRICS, "metric", "value")
