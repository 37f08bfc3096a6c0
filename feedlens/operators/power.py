"""Power of a planned experiment (Q1-Q4).

Q1-Q3 are plain aggregates.  Q4 follows from them without drawing anything: a
user's likes are binomial in views and CTR, so their mean and variance in either
group are sums over the two distributions (a binomial mixture, the algorithm's
extra views included), and the power of Welch's test is the normal one at the
standardised difference of the means.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.functions.columns import floor_to_hundredth, safe_ratio, to_day
from feedlens.functions.tails import norm_sf
from feedlens.operators.engagement import _in_days, is_like, is_view


def user_period(feed: DataFrame, start, end) -> DataFrame:
    """Per user likes and views over a closed day range (all groups)."""
    df = _in_days(feed.withColumn("day", to_day("time")), start, end)
    return df.groupBy("user_id").agg(F.count_if(is_like()).alias("likes"), F.count_if(is_view()).alias("views"))


def _with_share(dist: DataFrame) -> DataFrame:
    total = dist.agg(F.sum("users")).scalar()
    return dist.withColumn("p", safe_ratio("users", total))


def views_distribution(feed: DataFrame, start, end) -> DataFrame:
    """Q1: (views, users, p) - how many users had each weekly view count."""
    dist = user_period(feed, start, end).groupBy("views").agg(F.count("*").alias("users"))
    return _with_share(dist)


def ctr_distribution(feed: DataFrame, start, end) -> DataFrame:
    """Q2: (ctr, users, p) over user-days, CTR floored to 0.01; user-days without
    a view (undefined CTR) are left out."""
    df = _in_days(feed.withColumn("day", to_day("time")), start, end)
    ud = df.groupBy("user_id", "day").agg(safe_ratio(F.count_if(is_like()), F.count_if(is_view())).alias("raw_ctr"))
    dist = (
        ud.filter(F.col("raw_ctr").isNotNull())
        .groupBy(floor_to_hundredth("raw_ctr").alias("ctr"))
        .agg(F.count("*").alias("users"))
    )
    return _with_share(dist)


def joint_distribution(feed: DataFrame, start, end) -> DataFrame:
    """(views, ctr, users, p) at user grain: weekly views and the user's own CTR
    over the period (floored to 0.01; 0 for a user without views), for the power
    study of users whose views and CTR go together."""
    per_user = user_period(feed, start, end).select(
        "views", F.coalesce(floor_to_hundredth(safe_ratio("likes", "views")), F.lit(0.0)).alias("ctr")
    )
    return _with_share(per_user.groupBy("views", "ctr").agg(F.count("*").alias("users")))


def group_size(feed: DataFrame, start, end) -> DataFrame:
    """Q3: distinct users of the period, halved (integer division)."""
    df = _in_days(feed.withColumn("day", to_day("time")), start, end)
    return df.agg(F.count_distinct("user_id").alias("users")).select(
        "users", F.floor(F.col("users") / 2).cast("bigint").alias("group_size")
    )


def _effect(views: Column, probability: float, threshold: int, extra: tuple[int, int]) -> tuple[Column, Column]:
    """First and second moment of a treated user's views given the views before:
    an equally likely whole number in ``extra`` is added with ``probability`` from
    ``threshold`` views on."""
    sizes = range(extra[0], extra[1] + 1)
    one, two = sum(sizes) / len(sizes), sum(x * x for x in sizes) / len(sizes)
    hit = F.when(views >= threshold, probability).otherwise(0.0)
    return views + hit * one, views * views + hit * (2 * one * views + two)


def _likes(v: Column, v2: Column, q: Column, q2: Column) -> tuple[Column, Column]:
    """Terms of the first and second moment of binomial likes from the moments of
    views and like probability."""
    return v * q, v * (q - q2) + v2 * q2


def expected_power(
    views_dist: DataFrame,
    ctr_dist: DataFrame,
    size: DataFrame,
    effect_probability: float = 0.9,
    views_threshold: int = 50,
    alpha: float = 0.05,
    extra_views: tuple[int, int] = (1, 2),
    joint_dist: DataFrame | None = None,
) -> DataFrame:
    """Q4: one row with the group size, mean and variance of likes per group, the
    standardised difference and the two-sided power at ``alpha``.

    Views and CTR are independent, each from its own distribution; with
    ``joint_dist`` (see ``joint_distribution``) a user has a (views, CTR) pair.  A CTR
    above 1 counts as a like for every view; ``ctr_above_one`` is the share of such
    values.  ``size`` is the frame of ``group_size``."""
    v = F.col("views").cast("double")
    treated, treated2 = _effect(v, effect_probability, views_threshold, extra_views)
    q = F.least(F.col("ctr"), F.lit(1.0))
    share = lambda x: F.sum(F.col("p") * x)
    above = share(F.when(F.col("ctr") > 1, 1.0).otherwise(0.0))
    names = ("m_a", "s_a", "m_b", "s_b")
    if joint_dist is None:
        seen = views_dist.agg(F.struct(share(v).alias("v"), share(v * v).alias("v2"), share(treated).alias("t"), share(treated2).alias("t2"))).scalar()
        rate = ctr_dist.agg(F.struct(share(q).alias("q"), share(q * q).alias("q2"), above.alias("above"))).scalar()
        a = _likes(seen.getField("v"), seen.getField("v2"), rate.getField("q"), rate.getField("q2"))
        b = _likes(seen.getField("t"), seen.getField("t2"), rate.getField("q"), rate.getField("q2"))
        out = size.select("group_size", rate.getField("above").alias("ctr_above_one"), *[x.alias(n) for n, x in zip(names, a + b)])
    else:
        a, b = _likes(v, v * v, q, q * q), _likes(treated, treated2, q, q * q)
        seen = joint_dist.agg(F.struct(above.alias("above"), *[share(x).alias(n) for n, x in zip(names, a + b)])).scalar()
        out = size.select("group_size", seen.getField("above").alias("ctr_above_one"), *[seen.getField(n).alias(n) for n in names])
    out = out.select(
        "group_size",
        "ctr_above_one",
        F.col("m_a").alias("mean_a"),
        F.col("m_b").alias("mean_b"),
        (F.col("s_a") - F.col("m_a") * F.col("m_a")).alias("var_a"),
        (F.col("s_b") - F.col("m_b") * F.col("m_b")).alias("var_b"),
    )
    spread = F.sqrt(F.try_divide(F.col("var_a") + F.col("var_b"), F.col("group_size")))
    out = out.withColumn("shift", F.try_divide(F.col("mean_b") - F.col("mean_a"), spread))
    z = NormalDist().inv_cdf(1 - alpha / 2)
    return out.withColumn("power", norm_sf(z - F.col("shift")) + norm_sf(z + F.col("shift")))
