"""Report values of the two daily bots as long rows (B1, B2).

The reference formats text and sends it to a chat; here the values are a
DataFrame (section, metric, key, value) that any sink can render.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.columns import age_band_bot, as_date
from feedlens.operators.engagement import feed_summary
from feedlens.operators.services import SPLIT, _split, day_over_day, rollup_flags, service_flags

def _rows(df: DataFrame, section: str, metric_cols: list[str], key: F.Column | None = None) -> DataFrame:
    keyed = df.select((key if key is not None else F.lit(None).cast("string")).alias("key"), *[F.col(m).cast("double").alias(m) for m in metric_cols])
    return keyed.unpivot("key", metric_cols, "metric", "value").select(F.lit(section).alias("section"), "metric", "key", "value")


def feed_report(feed: DataFrame, as_of, ctr_digits: int | None = None) -> DataFrame:
    """B1: DAU, views, likes and CTR of the day before ``as_of``.  With
    ``ctr_digits`` the CTR is rounded half-to-even, as the reference's text shows it."""
    s = feed_summary(feed, as_of)
    if ctr_digits is not None:
        s = s.withColumn("ctr", F.bround("ctr", ctr_digits))
    return _rows(s, "feed", ["dau", "views", "likes", "ctr"], F.col("day").cast("string"))


def service_report(feed: DataFrame, msgs: DataFrame, as_of, k: int = 3, days: int = 7) -> DataFrame:
    """B2: yesterday's service split with change against the calendar day
    before, the split by OS (by name, not by row position), the top-k
    countries by both-service users (key = rank:country) and, from the bot's
    second task, both-service users per age group over the last ``days`` days.

    All four sections come from one flags table at (user, day, os, country,
    age) grain over the window, re-aggregated per section; the sections of the
    whole window share its scan, the one-day sections read a pruned day."""
    yesterday = F.date_sub(as_date(as_of), 1)
    first = F.date_sub(as_date(as_of), days)
    fine = service_flags(feed, msgs, ["user_id", "dt", "os", "country", "age"], False, first, yesterday)
    daily = _split(rollup_flags(fine, ["dt"]), ["dt"]).withColumnRenamed("dt", "day")
    dod = day_over_day(daily, SPLIT).filter(F.col("day") == yesterday)
    split = dod.select(F.lit("split").alias("section"), "metric", F.col("day").cast("string").alias("key"), "value")
    change = dod.select(
        F.lit("change_pct").alias("section"), "metric", F.col("day").cast("string").alias("key"), F.col("pct_change").alias("value")
    )
    last_day = fine.filter(F.col("dt") == yesterday)
    by_os = _rows(_split(rollup_flags(last_day, ["os"]), ["os"]), "os", SPLIT, F.col("os"))
    top = _split(rollup_flags(last_day, ["country"]), ["country"]).orderBy(F.col("both_users").desc(), F.col("country")).limit(k)
    # ``top`` has k rows at most, so an unpartitioned window over it is cheap.
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(F.col("both_users").desc(), F.col("country"))))
    top_rows = _rows(ranked, "top_countries", ["both_users"], F.concat_ws(":", F.col("rank").cast("string"), F.col("country")))
    ages = _split(rollup_flags(fine, ["age"]).withColumn("age_group", age_band_bot("age")), ["age_group"])
    by_age = _rows(ages, "age", ["both_users"], F.col("age_group"))
    return split.unionByName(change).unionByName(by_os).unionByName(top_rows).unionByName(by_age)
