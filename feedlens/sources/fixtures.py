"""Fixture views: ``feed_actions`` and ``message_actions`` derived from the
driver-generated tables ``events``, ``customer`` and ``nation``.

The DataFrame builders and the SQL CTE text express the same mapping; the CTE
text is inlined in every DuckDB oracle query, which only sees the raw tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture mapping (must agree with the oracle CTEs below).
FEED_EVENT_TYPES = ("view", "click", "signup")  # click -> like, others -> view
MESSAGE_EVENT_TYPES = ("purchase", "error")
RECEIVER_SPREAD = 97


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _profiled_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    return (
        events.join(customer, events.user_id == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "event_id",
            "user_id",
            "event_type",
            F.col("ts").alias("time"),
            (k % 3).cast("int").alias("exp_group"),
            (k % 2).cast("int").alias("gender"),
            (F.lit(10) + (k * 37) % 70).cast("int").alias("age"),
            F.col("n_name").alias("country"),
            F.col("c_mktsegment").alias("city"),
            F.when(F.col("event_id") % 40 == 0, "iOS")
            .when(k % 3 == 0, "iOS")
            .otherwise("Android")
            .alias("os"),
            F.when(k % 4 == 0, "ads").otherwise("organic").alias("source"),
        )
    )


def feed_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _profiled_events(spark, sf_dir).filter(F.col("event_type").isin(*FEED_EVENT_TYPES))
    return ev.select(
        "user_id",
        "event_id",
        "time",
        F.when(F.col("event_type") == "click", "like").otherwise("view").alias("action"),
        "exp_group",
        "gender",
        "age",
        "country",
        "city",
        "os",
        "source",
    )


def message_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    modulus = events.agg(F.max("user_id") + 1).scalar()
    ev = _profiled_events(spark, sf_dir).filter(F.col("event_type").isin(*MESSAGE_EVENT_TYPES))
    receiver = (F.col("user_id") + 1 + F.col("event_id") % RECEIVER_SPREAD) % modulus
    return ev.select(
        "user_id",
        receiver.alias("receiver_id"),
        "time",
        "gender",
        "age",
        "country",
        "city",
        "os",
        "source",
    )


# SQL text of the same two views, for the DuckDB oracle (ANSI SQL).
_PROFILED_SQL = """
  SELECT e.event_id, e.user_id, e.event_type, e.ts AS time,
         CAST(c.c_custkey % 3 AS INTEGER) AS exp_group,
         CAST(c.c_custkey % 2 AS INTEGER) AS gender,
         CAST(10 + (c.c_custkey * 37) % 70 AS INTEGER) AS age,
         n.n_name AS country, c.c_mktsegment AS city,
         CASE WHEN e.event_id % 40 = 0 THEN 'iOS'
              WHEN c.c_custkey % 3 = 0 THEN 'iOS' ELSE 'Android' END AS os,
         CASE WHEN c.c_custkey % 4 = 0 THEN 'ads' ELSE 'organic' END AS source
  FROM events e
  JOIN customer c ON c.c_custkey = e.user_id
  JOIN nation n ON n.n_nationkey = c.c_nationkey
"""

FEED_CTE = f"""feed_actions AS (
  SELECT user_id, event_id, time,
         CASE WHEN event_type = 'click' THEN 'like' ELSE 'view' END AS action,
         exp_group, gender, age, country, city, os, source
  FROM ({_PROFILED_SQL}) pe
  WHERE event_type IN ('view', 'click', 'signup')
)"""

MESSAGES_CTE = f"""message_actions AS (
  SELECT pe.user_id,
         (pe.user_id + 1 + pe.event_id % 97) % mx.modulus AS receiver_id,
         pe.time, pe.gender, pe.age, pe.country, pe.city, pe.os, pe.source
  FROM ({_PROFILED_SQL}) pe
  CROSS JOIN (SELECT max(user_id) + 1 AS modulus FROM events) mx
  WHERE pe.event_type IN ('purchase', 'error')
)"""


def with_fixtures(sql: str, feed: bool = True, messages: bool = False) -> str:
    """Prefix an oracle query with the fixture CTEs it uses."""
    ctes = ([FEED_CTE] if feed else []) + ([MESSAGES_CTE] if messages else [])
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
