"""Registered report queries (B1, B2) and the published cube."""

from __future__ import annotations

import uuid

from feedlens.operators import cube as C
from feedlens.operators import report as B
from feedlens.plans.catalog_cube import METRICS_CUBE_SQL
from feedlens.plans.catalog_services import _BOT_BAND, _SPLIT, _WEEK, _YESTERDAY, SPLIT_DAILY_SQL, _flags_sql
from feedlens.plans.params import AS_OF
from feedlens.plans.registry import register
from feedlens.session import materialize, shared_path
from feedlens.sources.fixtures import feed_actions, message_actions, with_fixtures


@register(
    "feed_report",
    with_fixtures(
        f"""
WITH s AS (
  SELECT count(DISTINCT user_id) AS dau,
         count(*) FILTER (WHERE action = 'view') AS views,
         count(*) FILTER (WHERE action = 'like') AS likes
  FROM feed_actions WHERE CAST(time AS DATE) = DATE '{AS_OF}' - 1)
SELECT 'feed' AS section, metric, CAST(DATE '{AS_OF}' - 1 AS VARCHAR) AS key, value FROM (
  SELECT CAST(dau AS DOUBLE) AS dau, CAST(views AS DOUBLE) AS views, CAST(likes AS DOUBLE) AS likes,
         CAST(likes AS DOUBLE) / NULLIF(views, 0) AS ctr FROM s) w
UNPIVOT INCLUDE NULLS (value FOR metric IN (dau, views, likes, ctr))
"""
    ),
)
def q_feed_report(spark, sf_dir):
    return B.feed_report(feed_actions(spark, sf_dir), AS_OF)


_LONG = """SELECT day, metric, value FROM (
    SELECT day, CAST(both_users AS DOUBLE) AS both_users,
           CAST(messenger_only_users AS DOUBLE) AS messenger_only_users,
           CAST(feed_only_users AS DOUBLE) AS feed_only_users FROM split) w
  UNPIVOT INCLUDE NULLS (value FOR metric IN (both_users, messenger_only_users, feed_only_users))"""


@register(
    "service_report",
    with_fixtures(
        f"""
WITH split AS ({SPLIT_DAILY_SQL}),
long AS ({_LONG}),
dod AS (SELECT a.day, a.metric, a.value, (a.value / NULLIF(b.value, 0) - 1.0) * 100.0 AS pct_change
        FROM long a LEFT JOIN long b ON b.day = a.day - 1 AND b.metric = a.metric
        WHERE a.day = DATE '{AS_OF}' - 1),
os_split AS (SELECT os, {_SPLIT} FROM ({_flags_sql('user_id, os', f'WHERE {_YESTERDAY}')}) f GROUP BY os),
top AS (SELECT country, {_SPLIT} FROM ({_flags_sql('user_id, country', f'WHERE {_YESTERDAY}')}) f
        GROUP BY country ORDER BY both_users DESC, country ASC LIMIT 3),
ranked AS (SELECT *, row_number() OVER (ORDER BY both_users DESC, country ASC) AS rk FROM top)
SELECT 'split' AS section, metric, CAST(day AS VARCHAR) AS key, value FROM dod
UNION ALL SELECT 'change_pct', metric, CAST(day AS VARCHAR), pct_change FROM dod
UNION ALL SELECT 'os', metric, os, value FROM (
  SELECT os, CAST(both_users AS DOUBLE) AS both_users, CAST(messenger_only_users AS DOUBLE) AS messenger_only_users,
         CAST(feed_only_users AS DOUBLE) AS feed_only_users FROM os_split) w
  UNPIVOT INCLUDE NULLS (value FOR metric IN (both_users, messenger_only_users, feed_only_users))
UNION ALL SELECT 'top_countries', 'both_users', CAST(rk AS VARCHAR) || ':' || country, CAST(both_users AS DOUBLE) FROM ranked
UNION ALL SELECT 'age', 'both_users', age_group, CAST(both_users AS DOUBLE) FROM (
  SELECT {_BOT_BAND} AS age_group, {_SPLIT} FROM ({_flags_sql('user_id, age', f'WHERE {_WEEK}')}) f GROUP BY 1) a
""",
        feed=True,
        messages=True,
    ),
)
def q_service_report(spark, sf_dir):
    return B.service_report(feed_actions(spark, sf_dir), message_actions(spark, sf_dir), AS_OF)


@register("published_cube", with_fixtures(METRICS_CUBE_SQL, feed=True, messages=True))
def q_published_cube(spark, sf_dir):
    """Publish every day's cube twice to a fresh table under the shared
    checkpoint folder and read it back; a re-run must not duplicate rows."""
    target = shared_path(spark, f"feedlens-cube-{uuid.uuid4().hex}")
    _, marginals = C.build_cube(feed_actions(spark, sf_dir), message_actions(spark, sf_dir))
    marginals = materialize(marginals)  # the same rows published twice, computed once
    C.publish_cube(marginals, target)
    C.publish_cube(marginals, target)
    return C.read_cube(spark, target)
