"""The A/B analysis as one job: every test of the experiment on the same
per-user table, one summary row per approach.

The per-user table is read by six tests, so it is checkpointed once in the
shared folder (a reliable checkpoint, not recomputed from the feed per test).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.operators import experiments as X
from feedlens.operators.engagement import user_ctr
from feedlens.session import materialize

_COLUMNS = ["test", "statistic", "p_value", "significant", "ci_lo", "ci_hi"]


def _row(df: DataFrame, name: str, statistic: str) -> DataFrame:
    return df.select(
        F.lit(name).alias("test"),
        F.col(statistic).cast("double").alias("statistic"),
        F.col("p_value").cast("double").alias("p_value"),
        F.col("significant"),
        F.lit(None).cast("double").alias("ci_lo"),
        F.lit(None).cast("double").alias("ci_hi"),
    )


def ab_summary(
    feed: DataFrame,
    start,
    end,
    control: int = 1,
    treatment: int = 2,
    alpha: float = 0.05,
    smoothing: float = 5.0,
    n_bootstrap: int = 2000,
    n_buckets: int = 50,
    seed: int = 42,
) -> DataFrame:
    """(test, statistic, p_value, significant, ci_lo, ci_hi) for: Welch and
    Mann-Whitney on user CTR, Welch on smoothed CTR, the Poisson-bootstrap
    interval of the CTR difference (significant = interval excludes 0), Welch
    on bucket CTR and a one-sided Mann-Whitney (treatment less than control)
    on bucket CTR."""
    users = materialize(user_ctr(feed, start, end, (control, treatment)))
    smoothed = X.smoothed_ctr(users, smoothing)
    buckets = X.bucket_ctr(users, n_buckets)
    ci = X.bootstrap_ci(X.poisson_bootstrap(users, n_bootstrap, seed), control, treatment)
    boot_row = ci.select(
        F.lit("bootstrap_ctr_difference").alias("test"),
        F.col("mean_diff").alias("statistic"),
        F.lit(None).cast("double").alias("p_value"),
        (~F.col("contains_zero")).alias("significant"),
        "ci_lo",
        "ci_hi",
    )
    parts = [
        _row(X.welch_ttest(users, "ctr", "exp_group", control, treatment, alpha), "welch_ctr", "t_stat"),
        _row(X.mann_whitney(users, "ctr", "exp_group", control, treatment, "two-sided", alpha), "mann_whitney_ctr", "u_a"),
        _row(X.welch_ttest(smoothed, "smoothed_ctr", "exp_group", control, treatment, alpha), "welch_smoothed_ctr", "t_stat"),
        boot_row,
        _row(X.welch_ttest(buckets, "bucket_ctr", "exp_group", control, treatment, alpha), "welch_bucket_ctr", "t_stat"),
        _row(
            X.mann_whitney(buckets, "bucket_ctr", "exp_group", treatment, control, "less", alpha),
            "mann_whitney_bucket_ctr_less",
            "u_a",
        ),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*_COLUMNS)
