"""Registered power-study queries (Q1-Q4) with DuckDB oracles."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from feedlens.functions.tails import sql_norm_sf
from feedlens.operators import power as Q
from feedlens.plans.params import (
    EFFECT_PROBABILITY,
    EFFECT_VIEWS_THRESHOLD,
    PRE_END,
    PRE_START,
    SIGNIFICANCE,
)
from feedlens.plans.registry import register
from feedlens.sources.fixtures import feed_actions, with_fixtures

_PRE = f"CAST(time AS DATE) BETWEEN DATE '{PRE_START}' AND DATE '{PRE_END}'"
_USER_PERIOD = f"""SELECT user_id, count(*) FILTER (WHERE action = 'like') AS likes,
  count(*) FILTER (WHERE action = 'view') AS views FROM feed_actions WHERE {_PRE} GROUP BY 1"""


@register(
    "views_distribution",
    with_fixtures(
        f"""SELECT views, users, CAST(users AS DOUBLE) / sum(users) OVER () AS p
  FROM (SELECT views, count(*) AS users FROM ({_USER_PERIOD}) u GROUP BY 1) d"""
    ),
)
def q_views_distribution(spark, sf_dir):
    return Q.views_distribution(feed_actions(spark, sf_dir), PRE_START, PRE_END)


@register(
    "ctr_distribution",
    with_fixtures(
        f"""SELECT ctr, users, CAST(users AS DOUBLE) / sum(users) OVER () AS p
  FROM (SELECT CAST(floor(raw_ctr * 100) AS DOUBLE) / 100.0 AS ctr, count(*) AS users
        FROM (SELECT user_id, CAST(time AS DATE) AS day,
                     CAST(count(*) FILTER (WHERE action = 'like') AS DOUBLE)
                       / NULLIF(count(*) FILTER (WHERE action = 'view'), 0) AS raw_ctr
              FROM feed_actions WHERE {_PRE} GROUP BY 1, 2) ud
        WHERE raw_ctr IS NOT NULL GROUP BY 1) d"""
    ),
)
def q_ctr_distribution(spark, sf_dir):
    return Q.ctr_distribution(feed_actions(spark, sf_dir), PRE_START, PRE_END)


@register(
    "power_group_size",
    with_fixtures(
        f"SELECT count(DISTINCT user_id) AS users, CAST(count(DISTINCT user_id) // 2 AS BIGINT) AS group_size FROM feed_actions WHERE {_PRE}"
    ),
)
def q_power_group_size(spark, sf_dir):
    return Q.group_size(feed_actions(spark, sf_dir), PRE_START, PRE_END)


@register(
    "joint_distribution",
    with_fixtures(
        f"""SELECT views, ctr, users, CAST(users AS DOUBLE) / sum(users) OVER () AS p
  FROM (SELECT views, coalesce(CAST(floor(CAST(likes AS DOUBLE) / NULLIF(views, 0) * 100) AS DOUBLE) / 100.0, 0.0) AS ctr,
               count(*) AS users
        FROM ({_USER_PERIOD}) u GROUP BY 1, 2) d"""
    ),
)
def q_joint_distribution(spark, sf_dir):
    return Q.joint_distribution(feed_actions(spark, sf_dir), PRE_START, PRE_END)


def _power(spark, sf_dir, joint: bool = False):
    feed = feed_actions(spark, sf_dir)
    out = Q.expected_power(
        Q.views_distribution(feed, PRE_START, PRE_END),
        Q.ctr_distribution(feed, PRE_START, PRE_END),
        Q.group_size(feed, PRE_START, PRE_END),
        effect_probability=EFFECT_PROBABILITY,
        views_threshold=EFFECT_VIEWS_THRESHOLD,
        alpha=SIGNIFICANCE,
        joint_dist=Q.joint_distribution(feed, PRE_START, PRE_END) if joint else None,
    )
    return out.select("group_size", *[F.round(c, 8).alias(c) for c in out.columns if c != "group_size"])


_Z = NormalDist().inv_cdf(1 - SIGNIFICANCE / 2)
_HIT = f"(CASE WHEN views >= {EFFECT_VIEWS_THRESHOLD} THEN CAST({EFFECT_PROBABILITY} AS DOUBLE) ELSE 0 END)"
_T, _T2 = f"(views + {_HIT} * 1.5)", f"(CAST(views AS DOUBLE) * views + {_HIT} * (3.0 * views + 2.5))"
_RATE = "least(ctr, 1.0)"


def _power_sql(moments: str) -> str:
    """``moments``: a query with n, above, m_a, s_a, m_b, s_b (moments of likes)."""
    return with_fixtures(
        f"""WITH m AS ({moments}),
st AS (SELECT *, s_a - m_a * m_a AS v_a, s_b - m_b * m_b AS v_b FROM m),
sh AS (SELECT *, (m_b - m_a) / sqrt((v_a + v_b) / n) AS d FROM st),
zz AS (SELECT *, {_Z!r} - d AS z1, {_Z!r} + d AS z2 FROM sh)
SELECT n AS group_size, round(above, 8) AS ctr_above_one, round(m_a, 8) AS mean_a, round(m_b, 8) AS mean_b,
       round(v_a, 8) AS var_a, round(v_b, 8) AS var_b, round(d, 8) AS shift, round({sql_norm_sf("z1")} + {sql_norm_sf("z2")}, 8) AS power
FROM zz"""
    )


_SIZE = f"(SELECT CAST(count(DISTINCT user_id) // 2 AS BIGINT) FROM feed_actions WHERE {_PRE})"
_INDEPENDENT = f"""
  SELECT {_SIZE} AS n, r.above, v.v * r.q AS m_a, v.v * (r.q - r.q2) + v.v2 * r.q2 AS s_a,
         v.t * r.q AS m_b, v.t * (r.q - r.q2) + v.t2 * r.q2 AS s_b
  FROM (SELECT avg(views) AS v, avg(CAST(views AS DOUBLE) * views) AS v2, avg({_T}) AS t, avg({_T2}) AS t2 FROM ({_USER_PERIOD}) u) v,
       (SELECT avg({_RATE}) AS q, avg({_RATE} * {_RATE}) AS q2, avg(CASE WHEN ctr > 1 THEN 1.0 ELSE 0.0 END) AS above
        FROM (SELECT floor(CAST(count(*) FILTER (WHERE action = 'like') AS DOUBLE)
                       / NULLIF(count(*) FILTER (WHERE action = 'view'), 0) * 100) / 100.0 AS ctr
              FROM feed_actions WHERE {_PRE} GROUP BY user_id, CAST(time AS DATE)) d WHERE ctr IS NOT NULL) r"""
_JOINT = f"""
  SELECT {_SIZE} AS n, avg(CASE WHEN ctr > 1 THEN 1.0 ELSE 0.0 END) AS above,
         avg(views * {_RATE}) AS m_a, avg(views * {_RATE} * (1 - {_RATE}) + CAST(views AS DOUBLE) * views * {_RATE} * {_RATE}) AS s_a,
         avg({_T} * {_RATE}) AS m_b, avg({_T} * {_RATE} * (1 - {_RATE}) + {_T2} * {_RATE} * {_RATE}) AS s_b
  FROM (SELECT views, coalesce(floor(CAST(likes AS DOUBLE) / NULLIF(views, 0) * 100) / 100.0, 0.0) AS ctr FROM ({_USER_PERIOD}) u) j"""


@register("power_expected", _power_sql(_INDEPENDENT))
def q_power_expected(spark, sf_dir):
    """Q4: power of the planned experiment, views and CTR independent."""
    return _power(spark, sf_dir)


@register("power_expected_joint", _power_sql(_JOINT))
def q_power_expected_joint(spark, sf_dir):
    """Q4 with each user's views and CTR together."""
    return _power(spark, sf_dir, joint=True)
