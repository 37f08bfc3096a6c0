"""A/B-test analysis (X1-X10): balance, histograms, Welch t, Mann-Whitney U,
smoothed CTR, bucket CTR, Poisson bootstrap and its interval.

Every test reduces the data with Spark aggregates to one row of sufficient
statistics; its tail probability is a Spark expression on that row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.columns import hashed_uniform, log_factorial, md5_bucket, poisson_support, safe_ratio, xxhash_bucket
from feedlens.functions.stats import mw_exact_sf
from feedlens.functions.tails import norm_sf, t_two_sided_p, two_sided
from feedlens.operators.engagement import user_ctr
from feedlens.operators.prefix import running_total_below


def group_sizes(users: DataFrame, group: str = "exp_group") -> DataFrame:
    """Distinct users per group (balance check)."""
    return users.groupBy(group).agg(F.count_distinct("user_id").alias("users"))


def histogram(df: DataFrame, value: str, by: str = "exp_group", bins: int = 10) -> DataFrame:
    """Bar counts of ``value`` per ``by`` over ``bins`` equal-width bins spanning
    the overall min..max (last bin closed); every bin of every group is listed.
    NULL values are not counted.  One scalar subquery gives min and max; the
    counts are densified per group (at most ``bins`` entries) without a join."""
    mm = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    lo, hi = mm.getField("lo"), mm.getField("hi")
    width = (hi - lo) / F.lit(float(bins))
    raw = F.floor((F.col(value) - lo) / (hi - lo) * F.lit(float(bins)))
    b = F.when(hi == lo, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")
    counts = df.groupBy(by, F.when(F.col(value).isNotNull(), b).alias("bin")).agg(F.count("*").alias("n"))
    per_group = counts.groupBy(by).agg(
        F.map_from_entries(F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", "n")))).alias("m")
    )
    grid = per_group.select(by, "m", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.select(
        by,
        "bin",
        (lo + F.col("bin") * width).alias("bin_lo"),
        (lo + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.coalesce(F.element_at("m", F.col("bin")), F.lit(0)).cast("bigint").alias("count"),
    )


def global_ctr(users: DataFrame, group: str = "exp_group") -> DataFrame:
    """CTR of sums per group."""
    return (
        users.groupBy(group)
        .agg(F.sum("likes").alias("likes"), F.sum("views").alias("views"))
        .withColumn("global_ctr", safe_ratio("likes", "views"))
    )


def _decide(p: Column, alpha: float) -> Column:
    return F.when(p.isNotNull(), p < F.lit(alpha))


def welch_stats(df: DataFrame, value: str, group: str = "exp_group", a=1, b=2) -> DataFrame:
    """X4 (statistic part): one global aggregate -> n, mean, var_samp per side,
    Welch t and its degrees of freedom; NULL values (undefined CTR) are skipped
    and counted in ``n_undefined``."""
    g, v = F.col(group), F.col(value)
    agg = df.agg(
        F.count(F.when(g == a, v)).alias("n_a"),
        F.count(F.when(g == b, v)).alias("n_b"),
        F.avg(F.when(g == a, v)).alias("mean_a"),
        F.avg(F.when(g == b, v)).alias("mean_b"),
        F.var_samp(F.when(g == a, v)).alias("var_a"),
        F.var_samp(F.when(g == b, v)).alias("var_b"),
        F.count(F.when(g.isin(a, b) & v.isNull(), 1)).alias("n_undefined"),
    )
    se_a = F.col("var_a") / F.col("n_a")
    se_b = F.col("var_b") / F.col("n_b")
    se2 = se_a + se_b
    dof_den = se_a * se_a / (F.col("n_a") - 1) + se_b * se_b / (F.col("n_b") - 1)
    return agg.select(
        "*",
        F.try_divide(F.col("mean_a") - F.col("mean_b"), F.sqrt(se2)).alias("t_stat"),
        F.try_divide(se2 * se2, dof_den).alias("dof"),
    )


def welch_ttest(df: DataFrame, value: str, group: str = "exp_group", a=1, b=2, alpha: float = 0.05) -> DataFrame:
    """X4 + X6: Welch's unequal-variance t-test of ``a`` against ``b``, two-sided
    p-value and the decision at ``alpha``; both NULL where t is undefined (no
    spread, or fewer than two values in a group)."""
    s = welch_stats(df, value, group, a, b).withColumn("p_value", t_two_sided_p(F.col("t_stat"), F.col("dof")))
    return s.withColumn("significant", _decide(F.col("p_value"), alpha))


def mann_whitney_stats(df: DataFrame, value: str, group: str = "exp_group", a=1, b=2, ranges: int | None = None, tied: bool = False) -> DataFrame:
    """X5 (statistic part): U of ``a``, U of ``b``, tie term, sigma; with ``tied`` the
    sizes of the groups of equal values in ascending order, as an array.

    Ranks are never materialised per row: rows are grouped to distinct values
    with per-side counts, and the count of ``b`` values below each value is a
    distributed running total.  U_a = sum over values of n_a(v) * (b below v +
    n_b(v) / 2), which equals the rank-sum form with average ranks for ties.
    """
    g, v = F.col(group), F.col(value)
    vals = (
        df.filter(g.isin(a, b) & v.isNotNull())
        .groupBy(v.cast("double").alias("v"))
        .agg(F.count_if(g == a).alias("cnt_a"), F.count_if(g == b).alias("cnt_b"))
    )
    cum = running_total_below(vals, "v", ["cnt_b"], ranges)
    t = F.col("cnt_a") + F.col("cnt_b")
    agg = cum.agg(
        F.sum("cnt_a").alias("n_a"),
        F.sum("cnt_b").alias("n_b"),
        F.sum(F.col("cnt_a") * (F.col("cnt_b_below") + F.col("cnt_b") / 2.0)).alias("u_a"),
        F.sum(t.cast("double") * t * t - t).alias("tie_term"),
        *([F.transform(F.sort_array(F.collect_list(F.struct("v", t.alias("t")))), lambda x: x["t"]).alias("tied")] if tied else []),
    )
    n_a, n_b = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    n = n_a + n_b
    sigma = F.sqrt(n_a * n_b / 12.0 * ((n + 1.0) - F.try_divide(F.col("tie_term"), n * (n - 1.0))))
    return agg.select(
        "n_a",
        "n_b",
        "u_a",
        (n_a * n_b - F.col("u_a")).alias("u_b"),
        "tie_term",
        sigma.alias("sigma"),
        *(["tied"] if tied else []),
    )


def mann_whitney(
    df: DataFrame,
    value: str,
    group: str = "exp_group",
    a=1,
    b=2,
    alternative: str = "two-sided",
    alpha: float = 0.05,
    ranges: int | None = None,
    method: str = "asymptotic",
) -> DataFrame:
    """X5 + X6: Mann-Whitney U test of ``a`` against ``b``.  ``alternative`` is
    'two-sided', 'less' (a tends to be smaller) or 'greater'.

    ``method="asymptotic"`` is the normal approximation with tie and continuity
    correction; ``"exact"`` takes the exact null distribution of U given the ties
    (for small groups: the sizes of all groups of equal values meet in one row, and
    time grows with their number and the cube of the sample sizes).  p-value and
    decision are NULL where the test is undefined: an empty group, or no spread under
    ``"asymptotic"``; without spread the exact p-value is 1."""
    s = mann_whitney_stats(df, value, group, a, b, ranges, tied=method == "exact")
    mu = F.col("n_a").cast("double") * F.col("n_b") / 2.0
    if alternative == "two-sided":
        u = F.greatest("u_a", "u_b")
    elif alternative == "less":
        u = F.col("u_b")
    elif alternative == "greater":
        u = F.col("u_a")
    else:
        raise ValueError(f"unknown alternative {alternative!r}")
    out = s.withColumn("z", F.try_divide(u - mu - 0.5, F.col("sigma")))
    if method == "asymptotic":
        tail = norm_sf(F.col("z"))
    elif method == "exact":
        # Given the ties the law of U is not symmetric: the group whose U it is comes first.
        of_a = {"two-sided": F.col("u_a") >= F.col("u_b"), "less": F.lit(False), "greater": F.lit(True)}[alternative]
        first, second = (F.when(of_a, F.col(x)).otherwise(F.col(y)) for x, y in (("n_a", "n_b"), ("n_b", "n_a")))
        tail = F.when(F.least("n_a", "n_b") > 0, mw_exact_sf(u, first, second, F.col("tied")))
    else:
        raise ValueError(f"unknown method {method!r}")
    return (
        out.withColumn("p_value", two_sided(tail) if alternative == "two-sided" else tail)
        .drop("tied")
        .withColumn("method", F.lit(method))
        .withColumn("alternative", F.lit(alternative))
        .withColumn("significant", _decide(F.col("p_value"), alpha))
    )


def smoothed_ctr(users: DataFrame, alpha: float = 5.0, group: str = "exp_group") -> DataFrame:
    """(likes + alpha * global CTR of the user's group) / (views + alpha).

    The per-group CTR has one row per group; no hint is given, so the planner
    broadcasts it after checking its size (AQE does so at run time)."""
    g = global_ctr(users, group).select(group, "global_ctr")
    return users.join(g, group).withColumn(
        "smoothed_ctr",
        safe_ratio(F.col("likes") + F.lit(alpha) * F.col("global_ctr"), F.col("views") + F.lit(alpha)),
    )


def bucket_ctr(users: DataFrame, n: int = 50, method: str = "md5", group: str = "exp_group") -> DataFrame:
    """Per (group, bucket) the CTR of sums and the upper median of user CTR.

    Buckets: ``md5`` (first 8 hex digits of md5 of the user id, portable) or
    ``xxhash64`` (faster, Spark-only membership).  Users are first counted by
    distinct CTR, so a bucket's median needs no buffer of its users."""
    bucket = md5_bucket("user_id", n) if method == "md5" else xxhash_bucket("user_id", n)
    values = (
        users.withColumn("bucket", bucket)
        .groupBy(group, "bucket", "ctr")
        .agg(F.sum("likes").alias("likes"), F.sum("views").alias("views"), F.count("*").alias("n"))
    )
    keys = Window.partitionBy(group, "bucket")
    known = F.when(F.col("ctr").isNotNull(), F.col("n")).otherwise(0)
    upto = F.sum(known).over(keys.orderBy("ctr").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    values = values.withColumns({"_upto": upto, "_half": F.floor(F.sum(known).over(keys) / 2)})
    return values.groupBy(group, "bucket").agg(
        safe_ratio(F.sum("likes"), F.sum("views")).alias("bucket_ctr"),
        F.min(F.when(F.col("_upto") > F.col("_half"), F.col("ctr"))).alias("median_ctr"),
    )


#: Replicates that one row is expanded to within a task.
REPLICATE_BLOCK = 50


def poisson_bootstrap(users: DataFrame, n: int = 2000, seed: int = 42, group: str = "exp_group") -> DataFrame:
    """Poisson(1) bootstrap of the CTR of sums per group.

    Users with equal likes and views are interchangeable, and the sum of c
    independent Poisson(1) weights is Poisson(c).  So users are counted by
    (group, likes, views) first, and each replicate draws one Poisson(c) weight for
    each tuple: the work grows with the distinct tuples, not with the users.  A
    draw inverts the distribution function (a running sum over the counts around
    c) at a uniform hashed from (seed, replicate, tuple), so results do not depend
    on partitioning or retries.  The weighted sums are aggregated right after the
    expansion; the expanded rows never cross a shuffle."""
    tuples = users.groupBy(group, "likes", "views").agg(F.count("*").alias("c"))
    mean = F.col("c").cast("double")
    low, high = poisson_support(mean)
    steps = tuples.select("*", low.alias("low"), F.explode(F.sequence(low, high)).alias("k"))
    steps = steps.withColumn("p", F.exp(F.col("k") * F.log(mean) - mean - log_factorial(F.col("k"))))
    by_tuple = Window.partitionBy(group, "likes", "views").orderBy("k")
    steps = steps.withColumn("cdf", F.sum("p").over(by_tuple.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    tuples = steps.groupBy(group, "likes", "views", "low").agg(F.sort_array(F.collect_list("cdf")).alias("cdf"))
    # Blocks of replicates are dealt over the tasks before they are expanded.
    tasks = int(users.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = tuples.select("*", F.explode(F.sequence(F.lit(0), F.lit((n - 1) // REPLICATE_BLOCK))).alias("block"))
    first = F.col("block") * REPLICATE_BLOCK
    ids = F.sequence(first, F.least(first + REPLICATE_BLOCK, F.lit(n)) - 1)
    rows = blocks.repartition(tasks, group, "likes", "views", "block").select("*", F.explode(ids).alias("boot_id"))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    u = hashed_uniform(F.col("boot_id"), text(group), text("likes"), text("views"), seed=seed, method="md5")
    # The uniform is bound to q once for a row; as a column it would be hashed again at every step.
    w = F.transform(F.array(u), lambda q: F.col("low") + F.size(F.filter("cdf", lambda x: x <= q)))[0]
    rows = rows.withColumn("w", w)
    return (
        rows.groupBy("boot_id", group)
        .agg(F.sum(F.col("w") * F.col("likes")).alias("likes"), F.sum(F.col("w") * F.col("views")).alias("views"))
        .withColumn("ctr", safe_ratio("likes", "views"))
    )


def bootstrap_ci(boot: DataFrame, a=1, b=2, lo: float = 0.025, hi: float = 0.975, group: str = "exp_group") -> DataFrame:
    """Difference of replicate CTRs (b - a), its interpolated percentiles
    and whether the interval contains zero."""
    g = F.col(group)
    per = boot.groupBy("boot_id").agg(
        F.max(F.when(g == a, F.col("ctr"))).alias("ctr_a"), F.max(F.when(g == b, F.col("ctr"))).alias("ctr_b")
    )
    diff = per.select((F.col("ctr_b") - F.col("ctr_a")).alias("diff"))
    out = diff.agg(
        F.count("diff").alias("n_boot"),
        F.avg("diff").alias("mean_diff"),
        F.percentile("diff", lo).alias("ci_lo"),
        F.percentile("diff", hi).alias("ci_hi"),
    )
    return out.withColumn("contains_zero", (F.col("ci_lo") <= 0) & (F.col("ci_hi") >= 0))


def experiment_users(feed: DataFrame, start, end, groups=(1, 2)) -> DataFrame:
    """E3 restricted to the experiment groups and period."""
    return user_ctr(feed, start, end, groups)
