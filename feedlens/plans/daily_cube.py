"""The daily metric-cube job: extract, combine, marginals and publish as one
Spark plan with a single action (the write)."""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.columns import to_day
from feedlens.operators.cube import build_cube, merge_profiles, profile_tuples, publish_cube
from feedlens.operators.engagement import _in_days
from feedlens.sources.schemas import PART_DAY


def _day_before(as_of) -> _dt.date:
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return as_of - _dt.timedelta(days=1)


def advance_profiles(msgs: DataFrame, day: _dt.date, path: str, lateness_days: int = 0) -> DataFrame:
    """Profile tuples of all messages up to ``day``, kept under ``path`` as one
    snapshot per day: yesterday's snapshot and the messages since make today's.

    With a day partition in the frame those are the messages that lie in the
    partitions from ``day`` on, however old they are.  Without one nothing tells
    their arrival, and the last ``lateness_days`` days are read again.

    Without a snapshot of the day before, the history up to ``day`` is reduced anew
    (a backfill).  Running a day again replaces its snapshot."""
    spark = msgs.sparkSession
    dated = msgs.withColumn("day", to_day("time"))
    try:
        previous = spark.read.parquet(f"{path}/day={day - _dt.timedelta(days=1)}")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        tuples = profile_tuples(_in_days(dated, None, day))
    else:
        if PART_DAY in dated.columns:
            new = _in_days(dated, None, day).filter(F.col(PART_DAY) >= F.lit(day))
        else:
            new = _in_days(dated, day - _dt.timedelta(days=lateness_days), day)
        tuples = merge_profiles(previous, profile_tuples(new))
    tuples.write.mode("overwrite").parquet(f"{path}/day={day}")
    return spark.read.parquet(f"{path}/day={day}")


def run_daily_cube(feed: DataFrame, msgs: DataFrame, as_of, target: str, profile: str = "all", profiles: str | None = None, lateness_days: int = 0) -> None:
    """Publish the cube of the day before ``as_of``; re-running replaces that day.

    ``profiles`` names the folder of kept profile tuples: the job then reads the
    new messages and the table instead of the whole message history.  ``lateness_days``
    says how late a message may arrive, for a frame without a day partition."""
    day = _day_before(as_of)
    tuples = advance_profiles(msgs, day, profiles, lateness_days) if profiles else None
    _, marginals = build_cube(feed, msgs, day, day, profile, tuples)
    publish_cube(marginals, target)


def backfill_cube(feed: DataFrame, msgs: DataFrame, start, end, target: str, profile: str = "all") -> None:
    """Publish every day of [start, end] in one job (what catch-up runs do day by day)."""
    _, marginals = build_cube(feed, msgs, start, end, profile)
    publish_cube(marginals, target)
