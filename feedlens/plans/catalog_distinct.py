"""Registered queries over kept daily indexes of users (A6, A7, R5, M7) with DuckDB
oracles that count the events themselves."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from feedlens.operators import distinct_index as D
from feedlens.plans.catalog_services import COHORT_RETENTION_SQL
from feedlens.plans.registry import register
from feedlens.session import shared_path
from feedlens.sources.fixtures import feed_actions, with_fixtures


def _kept(spark, index):
    """The index as it is read back from its table."""
    path = shared_path(spark, f"user-index-{uuid.uuid4().hex}")
    D.keep_days(index, path)
    return D.read_index(spark, path)


def _active_sql(by: str = "") -> str:
    """Distinct users of the day and of the 7 days up to it, for every day that one of
    these 7 has events, up to the last."""
    more, same = (f", {by}", f" AND e.{by} IS NOT DISTINCT FROM c.{by}") if by else ("", "")
    return f"""
ev AS (SELECT DISTINCT CAST(time AS DATE) AS day, user_id{more} FROM feed_actions WHERE user_id IS NOT NULL),
cal AS (SELECT DISTINCT CAST(unnest(generate_series(day, least(day + 6, (SELECT max(day) FROM ev)), INTERVAL 1 DAY)) AS DATE) AS day{more} FROM ev)
SELECT c.day{more.replace(', ', ', c.')}, count(DISTINCT e.user_id) FILTER (WHERE e.day = c.day) AS dau, count(DISTINCT e.user_id) AS wau
FROM cal c JOIN ev e ON e.day BETWEEN c.day - 6 AND c.day{same} GROUP BY c.day{more.replace(', ', ', c.')}
"""


def _day_and_week(active, index, by=()):
    week = active(index, 7, by).withColumnRenamed("users", "wau").alias("w")
    day = active(index, 1, by).withColumnRenamed("users", "dau").alias("d")
    on = F.col("w.day") == F.col("d.day")
    for c in by:
        on &= F.col(f"w.{c}").eqNullSafe(F.col(f"d.{c}"))
    return week.join(day, on, "left").select("w.day", *[f"w.{c}" for c in by], F.coalesce("dau", F.lit(0)).alias("dau"), "wau")


@register("bitmap_active_users", with_fixtures("WITH " + _active_sql().strip()))
def q_bitmap_active_users(spark, sf_dir):
    """DAU and WAU of every day from the kept bitmaps."""
    return _day_and_week(D.active_users, _kept(spark, D.bitmap_index(feed_actions(spark, sf_dir))))


@register("bitmap_active_users_by_os", with_fixtures("WITH " + _active_sql("os").strip()))
def q_bitmap_active_users_by_os(spark, sf_dir):
    """DAU and WAU by OS; the index has the source too, which is merged."""
    return _day_and_week(D.active_users, _kept(spark, D.bitmap_index(feed_actions(spark, sf_dir), ("os", "source"))), ("os",))


@register("bitmap_cohort_retention", with_fixtures(COHORT_RETENTION_SQL))
def q_bitmap_cohort_retention(spark, sf_dir):
    """R5 from the kept bitmaps."""
    return D.cohort_retention(_kept(spark, D.bitmap_index(feed_actions(spark, sf_dir))))


#: An estimate may be off by four standard errors.
_CLOSE = 4 * D.sketch_error()


@register(
    "approx_active_users",
    with_fixtures("WITH " + _active_sql().strip().replace("\nSELECT c.day, ", "\nSELECT c.day, true AS dau_close, true AS wau_close, ")),
)
def q_approx_active_users(spark, sf_dir):
    """DAU and WAU by the kept sketches, held against the exact counts: the exact
    numbers, and whether the estimates lie within four standard errors of them."""
    feed = feed_actions(spark, sf_dir)
    near = _day_and_week(D.approx_active_users, _kept(spark, D.sketch_index(feed))).toDF("day", "dau_near", "wau_near")
    exact = _day_and_week(D.active_users, _kept(spark, D.bitmap_index(feed)))
    close = [(F.abs(F.col(f"{c}_near") - F.col(c)) <= F.col(c) * _CLOSE).alias(f"{c}_close") for c in ("dau", "wau")]
    return exact.join(near, "day").select("day", *close, "dau", "wau")
