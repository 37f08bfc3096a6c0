"""Service mix: who uses the feed, the messenger, or both (M1-M7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.columns import age_band_bot, as_date, safe_ratio, to_day, week_start
from feedlens.operators.engagement import _in_days

SPLIT = ["both_users", "messenger_only_users", "feed_only_users"]


def both_services():
    """Predicate on service flags: used the feed and the messenger."""
    return (F.col("used_feed") == 1) & (F.col("used_message") == 1)


def messenger_only():
    return (F.col("used_feed") == 0) & (F.col("used_message") == 1)


def feed_only():
    return (F.col("used_feed") == 1) & (F.col("used_message") == 0)


def _day_range(df: DataFrame, start=None, end=None, end_exclusive: bool = False) -> DataFrame:
    return _in_days(df, start, end, day="dt", end_exclusive=end_exclusive)


def service_flags(
    feed: DataFrame,
    msgs: DataFrame,
    keys: list[str],
    include_receivers: bool = False,
    start=None,
    end=None,
    end_exclusive: bool = False,
) -> DataFrame:
    """M1: one row per distinct ``keys`` tuple with used_feed / used_message flags.

    ``keys`` may name ``dt`` (the event day) and any profile column.  Senders
    count as messenger users; with ``include_receivers`` receivers do too, under
    the sender's profile columns (the dashboard's semantics).  The union is
    aggregated with partial aggregation before the shuffle.
    """
    cols = [k for k in keys if k != "user_id"]

    def side(df: DataFrame, user: str, used_feed: int) -> DataFrame:
        df = _day_range(df.withColumn("dt", to_day("time")), start, end, end_exclusive)
        return df.select(
            F.col(user).alias("user_id"),
            *cols,
            F.lit(used_feed).alias("used_feed"),
            F.lit(1 - used_feed).alias("used_message"),
        )

    if include_receivers:
        # One scan of the messages: each row stands for its sender and its receiver.
        both = msgs.withColumn("_people", F.array("user_id", "receiver_id")).drop("user_id")
        both = both.select("*", F.explode("_people").alias("user_id")).drop("_people")
        parts = side(feed, "user_id", 1).unionByName(side(both, "user_id", 0))
    else:
        parts = side(feed, "user_id", 1).unionByName(side(msgs, "user_id", 0))
    return parts.groupBy("user_id", *cols).agg(
        F.max("used_feed").alias("used_feed"), F.max("used_message").alias("used_message")
    )


def _split(flags: DataFrame, by: list) -> DataFrame:
    return flags.groupBy(*by).agg(
        F.count(F.when(both_services(), F.col("user_id"))).alias("both_users"),
        F.count(F.when(messenger_only(), F.col("user_id"))).alias("messenger_only_users"),
        F.count(F.when(feed_only(), F.col("user_id"))).alias("feed_only_users"),
    )


def rollup_flags(fine: DataFrame, keys: list[str]) -> DataFrame:
    """Re-aggregate service flags to coarser ``keys`` (max of each flag)."""
    return fine.groupBy("user_id", *keys).agg(
        F.max("used_feed").alias("used_feed"), F.max("used_message").alias("used_message")
    )


def service_split_daily(feed: DataFrame, msgs: DataFrame, as_of, days: int = 7, include_receivers: bool = False) -> DataFrame:
    """M2: per day of the ``days`` days before ``as_of``: both / messenger only / feed only."""
    end = F.date_sub(as_date(as_of), 1)
    start = F.date_sub(as_date(as_of), days)
    flags = service_flags(feed, msgs, ["user_id", "dt"], include_receivers, start, end)
    return _split(flags, ["dt"]).withColumnRenamed("dt", "day")


def service_split_os(feed: DataFrame, msgs: DataFrame, as_of, include_receivers: bool = False) -> DataFrame:
    """M3: the split by OS for the day before ``as_of``."""
    day = F.date_sub(as_date(as_of), 1)
    flags = service_flags(feed, msgs, ["user_id", "os"], include_receivers, day, day)
    return _split(flags, ["os"])


def service_top_countries(feed: DataFrame, msgs: DataFrame, as_of, k: int = 3, include_receivers: bool = False) -> DataFrame:
    """M4: the ``k`` countries with most both-service users the day before ``as_of``.

    Ties are broken by country name.  Sort + limit plans as a top-k
    (TakeOrderedAndProject), never a global sort.
    """
    day = F.date_sub(as_date(as_of), 1)
    flags = service_flags(feed, msgs, ["user_id", "dt", "country"], include_receivers, day, day)
    split = _split(flags, ["dt", "country"]).withColumnRenamed("dt", "day")
    return split.orderBy(F.col("both_users").desc(), F.col("country").asc_nulls_last()).limit(k)


def service_split_age(feed: DataFrame, msgs: DataFrame, as_of, days: int = 7, include_receivers: bool = False) -> DataFrame:
    """M5: unique users per report age group over the ``days`` days before ``as_of``
    (a user is counted once per distinct age value seen)."""
    end = F.date_sub(as_date(as_of), 1)
    start = F.date_sub(as_date(as_of), days)
    flags = service_flags(feed, msgs, ["user_id", "age"], include_receivers, start, end)
    return _split(flags.withColumn("age_group", age_band_bot("age")), ["age_group"])


def day_over_day(df: DataFrame, metrics: list[str], day: str = "day") -> DataFrame:
    """M6: per day and metric, the value, the value of the calendar day before and
    the change in percent; NULL when that day is missing or its value is 0.

    The previous row comes from ``lag`` per metric and counts only if it is the
    calendar day before (one consumer of the input, no self-join)."""
    long = df.select(day, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        day, metrics, "metric", "value"
    )
    w = Window.partitionBy("metric").orderBy(day)
    prev_day, prev_val = F.lag(day).over(w), F.lag("value").over(w)
    with_prev = long.select(
        day, "metric", "value", F.when(prev_day == F.date_sub(F.col(day), 1), prev_val).alias("prev_value")
    )
    return with_prev.select(
        day,
        "metric",
        "value",
        "prev_value",
        ((safe_ratio("value", "prev_value") - 1.0) * 100.0).alias("pct_change"),
    )


WEEKLY_KEYS = ["user_id", "dt", "gender", "age", "country", "city", "os", "source"]


def _weekly_flags(feed: DataFrame, msgs: DataFrame, start, end) -> DataFrame:
    flags = service_flags(feed, msgs, WEEKLY_KEYS, True, start, end, end_exclusive=True)
    return flags.withColumn("week", week_start("dt"))


def both_service_weekly(feed: DataFrame, msgs: DataFrame, start, end) -> DataFrame:
    """M7: per Monday week of [start, end), user-days (at the grain of day, user
    and six profile columns) active in both services; receivers included."""
    flags = _weekly_flags(feed, msgs, start, end)
    return flags.groupBy("week").agg(F.count(F.when(both_services(), F.col("user_id"))).alias("both_service_user_days"))


def both_service_wau(feed: DataFrame, msgs: DataFrame, start, end) -> DataFrame:
    """M7 variant: distinct users per Monday week with a both-service user-day."""
    flags = _weekly_flags(feed, msgs, start, end)
    return flags.groupBy("week").agg(F.count_distinct(F.when(both_services(), F.col("user_id"))).alias("both_service_wau"))
