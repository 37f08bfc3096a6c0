"""Upkeep of the published cube by signed deltas, and its checked publication.

A profile tuple that arrives after a day was published changes that day: the user's
messages of all earlier days count under the new tuple too (``"all"``), or move to it
(``"latest"``).  The marginals are sums, so the change is a sum as well:

1. the tuples that arrived are compared with the kept ones of the same users, which
   gives the profile rows to add (+1) and to take back (-1);
2. joined to the users' message user-days, they give signed measures by day,
   dimension and value;
3. the days that these meet are read, added up and published; no other day is read
   or written, and no message of the history is.

A publication is staged: the new days are written beside the table, checked there, and
only then swapped in.  A failed check leaves the old days as they are, and a run that
was cut short goes on from what it had staged, so no delta counts twice.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.columns import ETL_AGE_LABELS, age_band_etl
from feedlens.operators.cube import DIMENSIONS, MESSAGE_MEASURES, PROFILE, merge_profiles, publish_cube, read_cube, sender_profile
from feedlens.sources.schemas import MEASURES

KEYS = ["event_date", "dimension", "dimension_value"]


def profile_changes(before: DataFrame, arrived: DataFrame, profile: str = "all") -> DataFrame:
    """(user_id, os, age, gender, sign): profile rows that the ``arrived`` tuples add to
    (+1) or take from (-1) those of the kept tuples ``before``.  Only users with an
    arrived tuple are looked at."""
    kept = before.join(arrived.select("user_id").distinct(), "user_id", "left_semi")
    old = sender_profile(None, profile, tuples=kept).withColumn("sign", F.lit(-1))
    new = sender_profile(None, profile, tuples=merge_profiles(kept, arrived)).withColumn("sign", F.lit(1))
    return old.unionByName(new).groupBy("user_id", *PROFILE).agg(F.sum("sign").alias("sign")).where("sign <> 0")


def _pairs() -> Column:
    values = {"gender": F.col("gender").cast("string"), "os": F.col("os"), "age": age_band_etl("age")}
    return F.array(*[F.struct(F.lit(d).alias("dimension"), values[d].alias("dimension_value")) for d in DIMENSIONS])


def cube_delta(message_days: DataFrame, changes: DataFrame) -> DataFrame:
    """Signed marginals of the changed profiles: ``message_days`` are kept message
    user-days (C3).  Values without a change are left out."""
    rows = message_days.join(changes, "user_id").select("event_date", *[(F.col(m) * F.col("sign")).alias(m) for m in MESSAGE_MEASURES], F.inline(_pairs()))
    summed = rows.where(F.col("dimension_value").isNotNull()).groupBy(*KEYS).agg(*[F.sum(m).cast("bigint").alias(m) for m in MESSAGE_MEASURES])
    changed = reduce(lambda a, b: a | b, [F.col(m) != 0 for m in MESSAGE_MEASURES])
    zero = F.lit(0).cast("bigint")
    return summed.where(changed).select(*KEYS, *[F.col(m) if m in MESSAGE_MEASURES else zero.alias(m) for m in MEASURES])


def add_delta(days: DataFrame, delta: DataFrame) -> DataFrame:
    """The marginals with the delta added.  Days that are not there are not begun; a
    value whose measures all fall to 0 leaves, but for age labels, which every day has."""
    there = days.select("event_date").distinct()
    both = days.select(*KEYS, *MEASURES).unionByName(delta.join(there, "event_date", "left_semi").select(*KEYS, *MEASURES))
    out = both.groupBy(*KEYS).agg(*[F.sum(m).cast("bigint").alias(m) for m in MEASURES])
    left = reduce(lambda a, b: a | b, [F.col(m) != 0 for m in MEASURES])
    return out.where(left | (F.col("dimension") == "age"))


# ------------------------------------------------------------------ publication
class CheckFailed(ValueError):
    """Rows that a check found; the published days are as they were."""


Check = Callable[[DataFrame], DataFrame]


def no_null_keys(cube: DataFrame) -> DataFrame:
    """Rows without a day, a dimension or a value."""
    return cube.where(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in KEYS]))


def no_repeated_keys(cube: DataFrame) -> DataFrame:
    return cube.groupBy(*KEYS).count().where("count > 1")


def no_negative_measures(cube: DataFrame) -> DataFrame:
    return cube.where(reduce(lambda a, b: a | b, [F.col(m) < 0 for m in MEASURES]))


def every_age_label(cube: DataFrame) -> DataFrame:
    ages = F.sort_array(F.collect_set(F.when(F.col("dimension") == "age", F.col("dimension_value"))))
    wanted = F.sort_array(F.array(*[F.lit(x) for x in ETL_AGE_LABELS]))
    return cube.groupBy("event_date").agg(ages.alias("ages")).where(F.col("ages") != wanted)


def totals_of(user_days: DataFrame) -> Check:
    """Days and dimensions whose measures do not add up to those of the user-day cube
    (C5) over the rows that have the dimension."""
    known = user_days.select("event_date", *MEASURES, F.inline(_pairs())).where(F.col("dimension_value").isNotNull())
    total = known.groupBy("event_date", "dimension").agg(*[F.sum(m).alias(f"want_{m}") for m in MEASURES])

    def check(cube: DataFrame) -> DataFrame:
        got = cube.groupBy("event_date", "dimension").agg(*[F.sum(m).alias(m) for m in MEASURES])
        met = got.join(total, ["event_date", "dimension"], "full_outer")
        differs = [~F.coalesce(F.col(m), F.lit(0)).eqNullSafe(F.coalesce(F.col(f"want_{m}"), F.lit(0))) for m in MEASURES]
        return met.where(reduce(lambda a, b: a | b, differs))

    return check


CHECKS: dict[str, Check] = {
    "null keys": no_null_keys,
    "repeated keys": no_repeated_keys,
    "negative measures": no_negative_measures,
    "age labels": every_age_label,
}


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def publish_checked(cube: DataFrame, target: str, batch: str, checks: dict[str, Check] | None = None) -> None:
    """Stages the days of ``cube``, checks them and swaps them into ``target``.

    ``batch`` names the run: a run under a name that is staged already, because it was
    cut short, publishes what was staged and does not read ``cube``.  Raises
    ``CheckFailed`` and leaves the table alone when a check finds rows; mended rows
    come under another name."""
    spark = cube.sparkSession
    staged = f"{target}/_staged/{batch}"  # readers of the table skip names with an underscore
    if not _exists(spark, f"{staged}/_SUCCESS"):
        cube.select("dimension", "dimension_value", *MEASURES, "event_date").write.mode("overwrite").parquet(staged)
    ready = spark.read.parquet(staged)
    for name, check in (CHECKS if checks is None else checks).items():
        found = check(ready).limit(5).collect()  # a report, whatever was found
        if found:
            raise CheckFailed(f"{name}: {found}")
    publish_cube(ready, target)


def apply_late_profiles(target: str, message_days: DataFrame, before: DataFrame, arrived: DataFrame, batch: str, profile: str = "all") -> list:
    """Brings the published days of ``target`` up to date with the ``arrived`` profile
    tuples; returns the days that were rewritten (a calendar-sized list).

    Equal to publishing all days anew, but that values without any measure left are
    not kept.  ``batch`` must name one arrival: a second run of it changes nothing."""
    spark = before.sparkSession
    staged = f"{target}/_staged/{batch}"
    if _exists(spark, f"{staged}/_SUCCESS"):
        days = spark.read.parquet(staged)
        publish_checked(days, target, batch)
    else:
        published = read_cube(spark, target)
        delta = cube_delta(message_days, profile_changes(before, arrived, profile))
        touched = [r.event_date for r in delta.select("event_date").distinct().join(published.select("event_date").distinct(), "event_date", "left_semi").collect()]
        if not touched:
            return []
        days = add_delta(published.where(F.col("event_date").isin(touched)), delta)
        publish_checked(days, target, batch)
        days = spark.read.parquet(staged)
    return sorted(r.event_date for r in days.select("event_date").distinct().collect())
