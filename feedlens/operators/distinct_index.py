"""Distinct users over any range of days from a kept daily index.

Two indexes, each one small table that grows by a partition a day, so a week or a
quarter is counted without a scan of events:

* bitmaps: a row for each day, segment and block of 32,768 user ids, one bit a user.
  OR over days is the union, counts are exact, and AND of a cohort's bitmaps with
  those of a later week counts who came back.
* sketches: a HyperLogLog row for each day and segment, whatever the number of users.
  The union of days is the sketch of the range; counts are estimates.

Blocks spread a segment's users over tasks, and both kinds are merged map-side, so a
day or a segment with a third of all events is no hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedlens.functions.columns import as_date, safe_ratio, to_day, week_start

#: Registers of a sketch are 2 ** SKETCH_LOG2; the relative standard error of an
#: estimate is about 1.04 / sqrt(2 ** SKETCH_LOG2), 0.8 percent.
SKETCH_LOG2 = 14


def sketch_error(log2: int = SKETCH_LOG2) -> float:
    """Relative standard error of a sketch's estimate."""
    return 1.04 / 2 ** (log2 / 2)


# --------------------------------------------------------------------- building
def bitmap_index(feed: DataFrame, by: tuple[str, ...] = (), user: str = "user_id") -> DataFrame:
    """(day, *by, block, bits): users active that day.  ``user`` is a whole number;
    rows without one count for nobody."""
    rows = feed.where(F.col(user).isNotNull())
    return rows.groupBy(to_day("time").alias("day"), *by, F.bitmap_bucket_number(user).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(user)).alias("bits")
    )


def sketch_index(feed: DataFrame, by: tuple[str, ...] = (), user: str = "user_id", log2: int = SKETCH_LOG2) -> DataFrame:
    """(day, *by, sketch): a HyperLogLog sketch of the users active that day."""
    rows = feed.where(F.col(user).isNotNull())
    return rows.groupBy(to_day("time").alias("day"), *by).agg(F.hll_sketch_agg(user, log2).alias("sketch"))


def keep_days(index: DataFrame, path: str) -> None:
    """Adds the days of ``index`` to the table under ``path``; a day that is there is
    replaced, so a run may be repeated."""
    index.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# --------------------------------------------------------------------- counting
def _users(bits: str = "bits") -> Column:
    return F.coalesce(F.sum(F.bitmap_count(bits)), F.lit(0)).alias("users")


def _merged(index: DataFrame, keys: list) -> DataFrame:
    return index.groupBy(*keys, "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def _in_range(index: DataFrame, start, end) -> DataFrame:
    return index.where(F.col("day").between(as_date(start), as_date(end)))


def distinct_users(index: DataFrame, start, end, by: tuple[str, ...] = ()) -> DataFrame:
    """A6 over the closed range of days, for each value of ``by``, which may be any
    of the index's segments (the others are merged)."""
    return _merged(_in_range(index, start, end), list(by)).groupBy(*by).agg(_users())


def approx_users(index: DataFrame, start, end, by: tuple[str, ...] = ()) -> DataFrame:
    """A7 over the closed range of days: the estimate of the union of its sketches."""
    merged = _in_range(index, start, end).groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*by, F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).alias("users"))


def _reaching(index: DataFrame, days: int) -> DataFrame:
    """Every row for each day (``to``) whose trailing ``days`` days hold it, up to the
    index's last day."""
    last = index.agg(F.max("day")).scalar()
    to = F.sequence("day", F.least(F.date_add("day", days - 1), last))
    return index.withColumn("to", F.explode(to))


def active_users(index: DataFrame, days: int = 1, by: tuple[str, ...] = ()) -> DataFrame:
    """(day, *by, users): distinct users of the ``days`` days up to and with each day.
    Days without events of their own have a row if one of the days before has."""
    merged = _merged(_reaching(index, days), ["to", *by])
    return merged.groupBy(F.col("to").alias("day"), *by).agg(_users())


def approx_active_users(index: DataFrame, days: int = 1, by: tuple[str, ...] = ()) -> DataFrame:
    """``active_users`` by sketches."""
    merged = _reaching(index, days).groupBy(F.col("to").alias("day"), *by).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("day", *by, F.hll_sketch_estimate("sketch").alias("users"))


def cohort_retention(index: DataFrame) -> DataFrame:
    """R5 from bitmaps: weekly cohorts by first active week, active users and share of
    the cohort per week offset.

    With P(c) the users of all weeks up to c, the cohort of c is P(c) without P(c - 1),
    so its users of week w are those of P(c) in w less those of P(c - 1) in w.  Weeks
    meet weeks (a calendar-sized list) within a block of ids, never users."""
    weeks = _merged(index.withColumn("week", week_start("day")), ["week"])
    weeks = weeks.withColumn("calendar", weeks.agg(F.sort_array(F.collect_set("week"))).scalar())
    later = weeks.select("block", "bits", "calendar", F.explode(F.filter("calendar", lambda w: w >= F.col("week"))).alias("cohort"))
    upto = later.groupBy("cohort", "block").agg(F.bitmap_or_agg("bits").alias("bits"), F.first("calendar").alias("calendar"))
    # The users so far, each for the weeks from there on; weeks for the cohorts up to them.
    both = upto.select("cohort", F.explode(F.filter("calendar", lambda w: w >= F.col("cohort"))).alias("week"), "block", "bits").unionByName(
        weeks.select(F.explode(F.filter("calendar", lambda w: w <= F.col("week"))).alias("cohort"), "week", "block", "bits")
    )
    met = both.groupBy("cohort", "week", "block").agg(F.bitmap_and_agg("bits").alias("bits"), F.count("*").alias("sides")).where("sides = 2")
    inside = met.groupBy("cohort", "week").agg(_users())
    earlier = F.lag("users", 1, 0).over(Window.partitionBy("week").orderBy("cohort"))
    active = inside.withColumn("active_users", F.col("users") - earlier).where("active_users > 0")
    active = active.select(F.col("cohort").alias("cohort_week"), (F.datediff("week", "cohort") / 7).cast("int").alias("week_offset"), "active_users")
    size = F.max(F.when(F.col("week_offset") == 0, F.col("active_users"))).over(Window.partitionBy("cohort_week"))
    return active.withColumn("cohort_users", size).withColumn("retention", safe_ratio("active_users", "cohort_users"))
