"""Registered service-mix (M1-M7) and retention (R1-R7) queries with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlens.functions.columns import as_date
from feedlens.operators import retention as R
from feedlens.operators import services as M
from feedlens.plans.params import AS_OF, MONTH_END, MONTH_START
from feedlens.plans.registry import register
from feedlens.sources.fixtures import feed_actions, message_actions, with_fixtures


def _flags_sql(keys: str, where: str, receivers: bool = False) -> str:
    """Distinct keys of either service, met in a full outer join; which sides a key
    stands on gives the flags."""
    names = [k.split(" AS ")[-1].strip() for k in keys.split(", ")]
    receivers_sql = f"UNION SELECT {keys.replace('user_id', 'receiver_id AS user_id')} FROM message_actions {where}" if receivers else ""
    same = " AND ".join(f"f.{n} IS NOT DISTINCT FROM m.{n}" for n in names)
    both = ", ".join(f"CASE WHEN f.here THEN f.{n} ELSE m.{n} END AS {n}" for n in names)
    return f"""
  SELECT {both}, CASE WHEN f.here THEN 1 ELSE 0 END AS used_feed, CASE WHEN m.here THEN 1 ELSE 0 END AS used_message
  FROM (SELECT DISTINCT {keys}, true AS here FROM feed_actions {where}) f
  FULL OUTER JOIN (SELECT *, true AS here FROM (SELECT DISTINCT {keys} FROM message_actions {where} {receivers_sql}) d) m ON {same}
"""


_SPLIT = """
  count(user_id) FILTER (WHERE used_feed = 1 AND used_message = 1) AS both_users,
  count(user_id) FILTER (WHERE used_feed = 0 AND used_message = 1) AS messenger_only_users,
  count(user_id) FILTER (WHERE used_feed = 1 AND used_message = 0) AS feed_only_users
"""
_YESTERDAY = f"CAST(time AS DATE) = DATE '{AS_OF}' - 1"
_WEEK = f"CAST(time AS DATE) BETWEEN DATE '{AS_OF}' - 7 AND DATE '{AS_OF}' - 1"
_FLAGS_DAILY = _flags_sql("user_id, CAST(time AS DATE) AS dt", f"WHERE {_WEEK}")
SPLIT_DAILY_SQL = f"SELECT dt AS day, {_SPLIT} FROM ({_FLAGS_DAILY}) f GROUP BY dt"


@register("service_split_daily", with_fixtures(SPLIT_DAILY_SQL, feed=True, messages=True))
def q_service_split_daily(spark, sf_dir):
    return M.service_split_daily(feed_actions(spark, sf_dir), message_actions(spark, sf_dir), AS_OF)


@register(
    "service_split_os",
    with_fixtures(
        f"SELECT os, {_SPLIT} FROM ({_flags_sql('user_id, os', f'WHERE {_YESTERDAY}')}) f GROUP BY os",
        feed=True,
        messages=True,
    ),
)
def q_service_split_os(spark, sf_dir):
    return M.service_split_os(feed_actions(spark, sf_dir), message_actions(spark, sf_dir), AS_OF)


@register(
    "service_top_countries",
    with_fixtures(
        f"""SELECT DATE '{AS_OF}' - 1 AS day, country, {_SPLIT}
  FROM ({_flags_sql('user_id, country', f'WHERE {_YESTERDAY}')}) f
  GROUP BY country ORDER BY both_users DESC, country ASC LIMIT 3""",
        feed=True,
        messages=True,
    ),
)
def q_service_top_countries(spark, sf_dir):
    return M.service_top_countries(feed_actions(spark, sf_dir), message_actions(spark, sf_dir), AS_OF)


_BOT_BAND = """CASE WHEN age < 18 THEN '<18' WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34'
       WHEN age < 45 THEN '35-44' WHEN age < 65 THEN '45-64' WHEN age IS NOT NULL THEN '65+' END"""


@register(
    "service_split_age",
    with_fixtures(
        f"SELECT {_BOT_BAND} AS age_group, {_SPLIT} FROM ({_flags_sql('user_id, age', f'WHERE {_WEEK}')}) f GROUP BY 1",
        feed=True,
        messages=True,
    ),
)
def q_service_split_age(spark, sf_dir):
    return M.service_split_age(feed_actions(spark, sf_dir), message_actions(spark, sf_dir), AS_OF)


@register(
    "service_day_over_day",
    with_fixtures(
        f"""
WITH split AS ({SPLIT_DAILY_SQL}),
long AS (
  SELECT day, metric, value FROM (
    SELECT day, CAST(both_users AS DOUBLE) AS both_users,
           CAST(messenger_only_users AS DOUBLE) AS messenger_only_users,
           CAST(feed_only_users AS DOUBLE) AS feed_only_users FROM split) w
  UNPIVOT INCLUDE NULLS (value FOR metric IN (both_users, messenger_only_users, feed_only_users)))
SELECT a.day, a.metric, a.value, b.value AS prev_value,
       (a.value / NULLIF(b.value, 0) - 1.0) * 100.0 AS pct_change
FROM long a LEFT JOIN long b ON b.day = a.day - 1 AND b.metric = a.metric
""",
        feed=True,
        messages=True,
    ),
)
def q_service_day_over_day(spark, sf_dir):
    split = M.service_split_daily(feed_actions(spark, sf_dir), message_actions(spark, sf_dir), AS_OF)
    return M.day_over_day(split, M.SPLIT)


_WEEKLY_KEYS = "CAST(time AS DATE) AS dt, user_id, gender, age, country, city, os, source"
_WEEKLY_FLAGS = _flags_sql(
    _WEEKLY_KEYS, f"WHERE CAST(time AS DATE) >= DATE '{MONTH_START}' AND CAST(time AS DATE) < DATE '{MONTH_END}'", receivers=True
)


@register(
    "both_service_weekly",
    with_fixtures(
        f"""SELECT CAST(date_trunc('week', dt) AS DATE) AS week,
  count(user_id) FILTER (WHERE used_feed = 1 AND used_message = 1) AS both_service_user_days
  FROM ({_WEEKLY_FLAGS}) f GROUP BY 1""",
        feed=True,
        messages=True,
    ),
)
def q_both_service_weekly(spark, sf_dir):
    return M.both_service_weekly(feed_actions(spark, sf_dir), message_actions(spark, sf_dir), MONTH_START, MONTH_END)


@register(
    "both_service_wau",
    with_fixtures(
        f"""SELECT CAST(date_trunc('week', dt) AS DATE) AS week,
  count(DISTINCT user_id) FILTER (WHERE used_feed = 1 AND used_message = 1) AS both_service_wau
  FROM ({_WEEKLY_FLAGS}) f GROUP BY 1""",
        feed=True,
        messages=True,
    ),
)
def q_both_service_wau(spark, sf_dir):
    return M.both_service_wau(feed_actions(spark, sf_dir), message_actions(spark, sf_dir), MONTH_START, MONTH_END)


# ------------------------------------------------------------------ retention
UW_SQL = "SELECT DISTINCT user_id, CAST(date_trunc('week', CAST(time AS DATE)) AS DATE) AS week FROM feed_actions"
NEW_RET_SQL = f"""
  SELECT c.week, CASE WHEN p.user_id IS NULL THEN 'new' ELSE 'retained' END AS status,
         count(DISTINCT c.user_id) AS users
  FROM ({UW_SQL}) c LEFT JOIN ({UW_SQL}) p ON p.user_id = c.user_id AND p.week = c.week - 7
  GROUP BY 1, 2
"""
GONE_SQL = f"""
  SELECT c.week + 7 AS week, 'gone' AS status, -count(DISTINCT c.user_id) AS users
  FROM ({UW_SQL}) c
  WHERE NOT EXISTS (SELECT 1 FROM ({UW_SQL}) n WHERE n.user_id = c.user_id AND n.week = c.week + 7)
  GROUP BY 1
"""


@register("user_weeks", with_fixtures(UW_SQL))
def q_user_weeks(spark, sf_dir):
    return R.user_weeks(feed_actions(spark, sf_dir))


@register("weekly_new_retained", with_fixtures(NEW_RET_SQL))
def q_weekly_new_retained(spark, sf_dir):
    return R.weekly_new_retained(feed_actions(spark, sf_dir))


@register("weekly_gone", with_fixtures(GONE_SQL))
def q_weekly_gone(spark, sf_dir):
    return R.weekly_gone(feed_actions(spark, sf_dir))


@register(
    "weekly_user_flow",
    with_fixtures(
        f"""SELECT week, status, CAST(sum(users) AS BIGINT) AS users
  FROM ({NEW_RET_SQL} UNION ALL {GONE_SQL}) f
  GROUP BY week, status ORDER BY users, week, status"""
    ),
)
def q_weekly_user_flow(spark, sf_dir):
    return R.weekly_user_flow(feed_actions(spark, sf_dir))


COHORT_RETENTION_SQL = f"""
WITH uw AS ({UW_SQL}),
first AS (SELECT user_id, min(week) AS cohort_week FROM uw GROUP BY 1),
act AS (SELECT f.cohort_week, CAST((u.week - f.cohort_week) / 7 AS INTEGER) AS week_offset, count(*) AS active_users
        FROM uw u JOIN first f USING (user_id) GROUP BY 1, 2)
SELECT a.*, s.active_users AS cohort_users,
       CAST(a.active_users AS DOUBLE) / NULLIF(s.active_users, 0) AS retention
FROM act a LEFT JOIN act s ON s.cohort_week = a.cohort_week AND s.week_offset = 0
"""


@register("cohort_retention", with_fixtures(COHORT_RETENTION_SQL))
def q_cohort_retention(spark, sf_dir):
    return R.cohort_retention(feed_actions(spark, sf_dir))


@register(
    "dau_by_segment",
    with_fixtures(
        """
WITH d AS (SELECT DISTINCT user_id, CAST(time AS DATE) AS day, source, os, country FROM feed_actions),
f AS (SELECT user_id, min(day) AS first_day FROM d GROUP BY 1),
x AS (SELECT d.*, CAST(f.first_day AS VARCHAR) AS first_day FROM d JOIN f USING (user_id))
SELECT day, 'source' AS dimension, source AS dimension_value, count(DISTINCT user_id) AS dau FROM x GROUP BY 1, 2, 3
UNION ALL SELECT day, 'os', os, count(DISTINCT user_id) FROM x GROUP BY 1, 2, 3
UNION ALL SELECT day, 'country', country, count(DISTINCT user_id) FROM x GROUP BY 1, 2, 3
UNION ALL SELECT day, 'first_day', first_day, count(DISTINCT user_id) FROM x GROUP BY 1, 2, 3
"""
    ),
)
def q_dau_by_segment(spark, sf_dir):
    return R.dau_by_segment(feed_actions(spark, sf_dir))


COHORT_DAY = MONTH_START


@register(
    "campaign_retention",
    with_fixtures(
        f"""
WITH d AS (SELECT user_id, CAST(time AS DATE) AS day, source FROM feed_actions),
f AS (SELECT user_id, min(day) AS first_day FROM d GROUP BY 1 HAVING min(day) = DATE '{COHORT_DAY}'),
seg AS (SELECT d.user_id, max(CASE WHEN d.source = 'ads' THEN 1 ELSE 0 END) AS is_campaign
        FROM d JOIN f ON f.user_id = d.user_id AND d.day = f.first_day GROUP BY 1),
act AS (SELECT CASE WHEN s.is_campaign = 1 THEN 'campaign' ELSE 'other' END AS segment,
               CAST(x.day - f.first_day AS INTEGER) AS day_offset, count(*) AS active_users
        FROM (SELECT DISTINCT user_id, day FROM d) x JOIN f USING (user_id) JOIN seg s USING (user_id)
        GROUP BY 1, 2)
SELECT a.*, s.active_users AS cohort_users,
       CAST(a.active_users AS DOUBLE) / NULLIF(s.active_users, 0) AS retention
FROM act a LEFT JOIN act s ON s.segment = a.segment AND s.day_offset = 0
"""
    ),
)
def q_campaign_retention(spark, sf_dir):
    return R.campaign_retention(feed_actions(spark, sf_dir), COHORT_DAY, "ads")


@register("service_flags_daily", with_fixtures(_FLAGS_DAILY, feed=True, messages=True))
def q_service_flags_daily(spark, sf_dir):
    """M1 at (user, day) grain over the report week, senders only."""
    end = F.date_sub(as_date(AS_OF), 1)
    start = F.date_sub(as_date(AS_OF), 7)
    return M.service_flags(feed_actions(spark, sf_dir), message_actions(spark, sf_dir), ["user_id", "dt"], False, start, end)


@register("service_flags_dashboard", with_fixtures(_WEEKLY_FLAGS, feed=True, messages=True))
def q_service_flags_dashboard(spark, sf_dir):
    """M1 at the dashboard's grain (day, user, six profile columns), receivers included."""
    return M.service_flags(
        feed_actions(spark, sf_dir), message_actions(spark, sf_dir), M.WEEKLY_KEYS, True, MONTH_START, MONTH_END, end_exclusive=True
    )
