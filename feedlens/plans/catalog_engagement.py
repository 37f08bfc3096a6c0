"""Registered engagement queries (E1-E5) with their DuckDB oracles."""

from __future__ import annotations

from feedlens.operators import engagement as E
from feedlens.plans.params import AS_OF, EXP_END, EXP_START
from feedlens.plans.registry import register
from feedlens.sources.fixtures import feed_actions, with_fixtures

_DAILY_SQL = """
  SELECT CAST(time AS DATE) AS day,
         count(DISTINCT user_id) AS dau,
         count(*) FILTER (WHERE action = 'view') AS views,
         count(*) FILTER (WHERE action = 'like') AS likes
  FROM feed_actions {where}
  GROUP BY 1
"""


@register(
    "feed_daily",
    with_fixtures(
        f"SELECT day, dau, views, likes, CAST(likes AS DOUBLE) / NULLIF(views, 0) AS ctr FROM ({_DAILY_SQL.format(where='')}) d"
    ),
)
def q_feed_daily(spark, sf_dir):
    return E.feed_daily(feed_actions(spark, sf_dir))


@register(
    "feed_summary",
    with_fixtures(
        f"""
  SELECT DATE '{AS_OF}' - 1 AS day,
         count(DISTINCT user_id) AS dau,
         count(*) FILTER (WHERE action = 'view') AS views,
         count(*) FILTER (WHERE action = 'like') AS likes,
         CAST(count(*) FILTER (WHERE action = 'like') AS DOUBLE)
           / NULLIF(count(*) FILTER (WHERE action = 'view'), 0) AS ctr
  FROM feed_actions WHERE CAST(time AS DATE) = DATE '{AS_OF}' - 1
"""
    ),
)
def q_feed_summary(spark, sf_dir):
    return E.feed_summary(feed_actions(spark, sf_dir), AS_OF)


_USER_CTR_SQL = f"""
  SELECT user_id, exp_group,
         count(*) FILTER (WHERE action = 'like') AS likes,
         count(*) FILTER (WHERE action = 'view') AS views
  FROM feed_actions
  WHERE CAST(time AS DATE) BETWEEN DATE '{EXP_START}' AND DATE '{EXP_END}' AND exp_group IN (1, 2)
  GROUP BY user_id, exp_group
"""
USER_CTR_SQL = f"SELECT user_id, exp_group, likes, views, CAST(likes AS DOUBLE) / NULLIF(views, 0) AS ctr FROM ({_USER_CTR_SQL}) u"


@register("user_ctr", with_fixtures(USER_CTR_SQL))
def q_user_ctr(spark, sf_dir):
    return E.user_ctr(feed_actions(spark, sf_dir), EXP_START, EXP_END)


@register(
    "feed_user_day",
    with_fixtures(
        """
  SELECT CAST(time AS DATE) AS event_date, user_id, gender, age, os,
         count(*) FILTER (WHERE action = 'like') AS likes,
         count(*) FILTER (WHERE action = 'view') AS views
  FROM feed_actions
  GROUP BY 1, 2, 3, 4, 5
"""
    ),
)
def q_feed_user_day(spark, sf_dir):
    return E.feed_user_day(feed_actions(spark, sf_dir))


@register(
    "feed_trend",
    with_fixtures(
        f"""
  SELECT day, metric, value FROM (
    SELECT day, CAST(dau AS DOUBLE) AS dau, CAST(views AS DOUBLE) AS views,
           CAST(likes AS DOUBLE) AS likes, CAST(likes AS DOUBLE) / NULLIF(views, 0) AS ctr
    FROM ({_DAILY_SQL.format(where=f"WHERE CAST(time AS DATE) >= DATE '{AS_OF}' - 8 AND CAST(time AS DATE) <> DATE '{AS_OF}'")}) d
  ) w
  UNPIVOT INCLUDE NULLS (value FOR metric IN (dau, views, likes, ctr))
"""
    ),
)
def q_feed_trend(spark, sf_dir):
    return E.feed_trend(feed_actions(spark, sf_dir), AS_OF)
