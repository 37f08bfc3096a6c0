"""Registered messenger and metric-cube queries (C1-C6) with DuckDB oracles.

The cube is built for every day in the data at once (a full backfill); the
daily job is the same plan restricted to one day.
"""

from __future__ import annotations

import datetime as _dt

from feedlens.operators import cube as C
from feedlens.operators.engagement import feed_user_day
from feedlens.plans.params import AS_OF
from feedlens.plans.registry import register
from feedlens.sources.fixtures import feed_actions, message_actions, with_fixtures

SENT_SQL = """
  SELECT CAST(time AS DATE) AS event_date, user_id,
         count(receiver_id) AS messages_sent, count(DISTINCT receiver_id) AS users_sent
  FROM message_actions GROUP BY 1, 2
"""
RECV_SQL = """
  SELECT CAST(time AS DATE) AS event_date, receiver_id AS user_id,
         count(user_id) AS messages_received, count(DISTINCT user_id) AS users_received
  FROM message_actions GROUP BY 1, 2
"""
MUD_SQL = f"""
  SELECT coalesce(s.event_date, r.event_date) AS event_date,
         coalesce(s.user_id, r.user_id) AS user_id,
         coalesce(s.messages_sent, 0) AS messages_sent,
         coalesce(s.users_sent, 0) AS users_sent,
         coalesce(r.messages_received, 0) AS messages_received,
         coalesce(r.users_received, 0) AS users_received
  FROM ({SENT_SQL}) s FULL OUTER JOIN ({RECV_SQL}) r
    ON s.event_date = r.event_date AND s.user_id = r.user_id
"""
MSG_PROFILE_SQL = f"""
  SELECT m.*, p.os, p.age, p.gender
  FROM ({MUD_SQL}) m
  LEFT JOIN (SELECT DISTINCT user_id, os, age, gender FROM message_actions) p USING (user_id)
"""
FEED_UD_SQL = """
  SELECT CAST(time AS DATE) AS event_date, user_id, gender, age, os,
         count(*) FILTER (WHERE action = 'like') AS likes,
         count(*) FILTER (WHERE action = 'view') AS views
  FROM feed_actions GROUP BY 1, 2, 3, 4, 5
"""
CUBE_SQL = f"""
  SELECT coalesce(f.user_id, m.user_id) AS user_id,
         coalesce(f.event_date, m.event_date) AS event_date,
         coalesce(f.gender, m.gender) AS gender,
         coalesce(f.age, m.age) AS age,
         coalesce(f.os, m.os) AS os,
         coalesce(f.likes, 0) AS likes, coalesce(f.views, 0) AS views,
         coalesce(m.messages_sent, 0) AS messages_sent, coalesce(m.users_sent, 0) AS users_sent,
         coalesce(m.messages_received, 0) AS messages_received,
         coalesce(m.users_received, 0) AS users_received
  FROM ({FEED_UD_SQL}) f
  FULL OUTER JOIN ({MSG_PROFILE_SQL}) m
    ON f.user_id IS NOT DISTINCT FROM m.user_id
   AND f.event_date IS NOT DISTINCT FROM m.event_date
   AND f.gender IS NOT DISTINCT FROM m.gender
   AND f.age IS NOT DISTINCT FROM m.age
   AND f.os IS NOT DISTINCT FROM m.os
"""
_SUMS = ", ".join(
    f"CAST(sum({m}) AS BIGINT) AS {m}"
    for m in ["views", "likes", "messages_sent", "users_sent", "messages_received", "users_received"]
)
_AGE_BAND = """CASE WHEN age >= 0 AND age < 18 THEN '<18'
       WHEN age >= 18 AND age < 25 THEN '18-24'
       WHEN age >= 25 AND age < 35 THEN '25-34'
       WHEN age >= 35 AND age < 45 THEN '35-44'
       WHEN age >= 45 AND age < 61 THEN '45-60'
       WHEN age >= 61 THEN 'старше 60' END"""
METRICS_CUBE_SQL = f"""
WITH cube AS ({CUBE_SQL}),
gender_m AS (
  SELECT event_date, 'gender' AS dimension, CAST(gender AS VARCHAR) AS dimension_value, {_SUMS}
  FROM cube WHERE gender IS NOT NULL GROUP BY 1, 2, 3),
os_m AS (
  SELECT event_date, 'os' AS dimension, os AS dimension_value, {_SUMS}
  FROM cube WHERE os IS NOT NULL GROUP BY 1, 2, 3),
age_m AS (
  SELECT event_date, {_AGE_BAND} AS band, {_SUMS}
  FROM cube GROUP BY 1, 2),
labels AS (
  SELECT d.event_date, l.band
  FROM (SELECT DISTINCT event_date FROM cube) d,
       (VALUES ('<18'), ('18-24'), ('25-34'), ('35-44'), ('45-60'), ('старше 60')) l(band)),
age_dense AS (
  SELECT l.event_date, 'age' AS dimension, l.band AS dimension_value,
         coalesce(a.views, 0) AS views, coalesce(a.likes, 0) AS likes,
         coalesce(a.messages_sent, 0) AS messages_sent, coalesce(a.users_sent, 0) AS users_sent,
         coalesce(a.messages_received, 0) AS messages_received,
         coalesce(a.users_received, 0) AS users_received
  FROM labels l LEFT JOIN age_m a ON a.event_date = l.event_date AND a.band = l.band)
SELECT * FROM gender_m UNION ALL SELECT * FROM os_m UNION ALL SELECT * FROM age_dense
"""


@register("sent_user_day", with_fixtures(SENT_SQL, feed=False, messages=True))
def q_sent_user_day(spark, sf_dir):
    return C.sent_user_day(message_actions(spark, sf_dir))


@register("received_user_day", with_fixtures(RECV_SQL, feed=False, messages=True))
def q_received_user_day(spark, sf_dir):
    return C.received_user_day(message_actions(spark, sf_dir))


@register("message_user_day", with_fixtures(MUD_SQL, feed=False, messages=True))
def q_message_user_day(spark, sf_dir):
    return C.message_user_day(message_actions(spark, sf_dir))


@register("message_profile", with_fixtures(MSG_PROFILE_SQL, feed=False, messages=True))
def q_message_profile(spark, sf_dir):
    msgs = message_actions(spark, sf_dir)
    return C.with_profile(C.message_user_day(msgs), msgs, "all")


@register(
    "message_profile_latest",
    with_fixtures(
        f"""
  SELECT m.*, p.os, p.age, p.gender
  FROM ({MUD_SQL}) m
  LEFT JOIN (
    SELECT user_id, os, age, gender FROM (
      SELECT user_id, os, age, gender,
             row_number() OVER (PARTITION BY user_id ORDER BY time DESC, os DESC, age DESC, gender DESC) AS rn
      FROM message_actions) t
    WHERE rn = 1) p USING (user_id)
""",
        feed=False,
        messages=True,
    ),
)
def q_message_profile_latest(spark, sf_dir):
    msgs = message_actions(spark, sf_dir)
    return C.with_profile(C.message_user_day(msgs), msgs, "latest")


@register("user_day_cube", with_fixtures(CUBE_SQL, feed=True, messages=True))
def q_user_day_cube(spark, sf_dir):
    feed, msgs = feed_actions(spark, sf_dir), message_actions(spark, sf_dir)
    return C.user_day_cube(feed_user_day(feed), C.with_profile(C.message_user_day(msgs), msgs, "all"))


@register("metrics_cube", with_fixtures(METRICS_CUBE_SQL, feed=True, messages=True))
def q_metrics_cube(spark, sf_dir):
    _, marginals = C.build_cube(feed_actions(spark, sf_dir), message_actions(spark, sf_dir))
    return marginals


@register(
    "cube_null_keys",
    with_fixtures(
        f"""
  SELECT event_date, count(*) AS rows, {_SUMS}
  FROM ({CUBE_SQL}) c
  WHERE gender IS NULL OR age IS NULL OR os IS NULL
  GROUP BY 1
""",
        feed=True,
        messages=True,
    ),
)
def q_cube_null_keys(spark, sf_dir):
    cube, _ = C.build_cube(feed_actions(spark, sf_dir), message_actions(spark, sf_dir))
    return C.cube_null_keys(cube)


@register(
    "metrics_cube_day",
    with_fixtures(
        f"SELECT * FROM ({METRICS_CUBE_SQL}) c WHERE event_date = DATE '{AS_OF}' - 1",
        feed=True,
        messages=True,
    ),
)
def q_metrics_cube_day(spark, sf_dir):
    """The daily job's plan: the cube of the day before ``as_of`` (day filters
    pushed to the scans, age labels from the calendar, profile semi-joined to
    that day's senders and receivers)."""
    day = _dt.date.fromisoformat(AS_OF) - _dt.timedelta(days=1)
    _, marginals = C.build_cube(feed_actions(spark, sf_dir), message_actions(spark, sf_dir), day, day)
    return marginals
