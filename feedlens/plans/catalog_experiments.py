"""Registered A/B-test queries (X1-X10) with DuckDB oracles.

Tests come in pairs: ``<name>`` returns statistic, p-value and decision, and
``<name>_stat`` the statistic part alone, rounded to 10 decimals on both sides.
The oracles of p-values integrate the density in their own way (see
``functions.tails``); p-values are rounded to 8 decimals on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.tails import sql_norm_sf, sql_t_two_sided
from feedlens.operators import experiments as X
from feedlens.operators.engagement import user_ctr
from feedlens.plans.catalog_engagement import USER_CTR_SQL
from feedlens.plans.params import EXP_END, EXP_START, N_BOOTSTRAP, N_BUCKETS, SEED, SIGNIFICANCE, SMOOTHING_ALPHA
from feedlens.plans.registry import register
from feedlens.sources.fixtures import feed_actions, with_fixtures

ROUND = 10
P_ROUND = 8


def _users(spark, sf_dir) -> DataFrame:
    return user_ctr(feed_actions(spark, sf_dir), EXP_START, EXP_END, (1, 2))


def _rounded(df: DataFrame, cols: list[str], p: str = "p_value") -> DataFrame:
    digits = {c: P_ROUND if c == p else ROUND for c in (*cols, p)}
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


def _users_sql(body: str) -> str:
    return with_fixtures(f"WITH users AS ({USER_CTR_SQL})\n{body}")


@register("group_sizes", _users_sql("SELECT exp_group, count(DISTINCT user_id) AS users FROM users GROUP BY 1"))
def q_group_sizes(spark, sf_dir):
    return X.group_sizes(_users(spark, sf_dir))


def _histogram_sql(source: str, value: str, by: str = "exp_group", bins: int = 10) -> str:
    """Oracle of ``experiments.histogram``: ``source`` is a CTE name."""
    return f"""
, mm AS (SELECT min({value}) AS lo, max({value}) AS hi FROM {source}),
grid AS (SELECT g.{by}, b.bin FROM (SELECT DISTINCT {by} FROM {source}) g,
         (SELECT CAST(range AS INTEGER) AS bin FROM range(0, {bins})) b),
cnt AS (SELECT {by},
               CAST(CASE WHEN mm.hi = mm.lo THEN 0
                         ELSE least(floor(({value} - mm.lo) / (mm.hi - mm.lo) * {float(bins)}), {bins - 1}) END AS INTEGER) AS bin,
               count(*) AS n
        FROM {source}, mm WHERE {value} IS NOT NULL GROUP BY 1, 2)
SELECT grid.{by}, grid.bin,
       mm.lo + grid.bin * ((mm.hi - mm.lo) / {float(bins)}) AS bin_lo,
       mm.lo + (grid.bin + 1) * ((mm.hi - mm.lo) / {float(bins)}) AS bin_hi,
       coalesce(cnt.n, 0) AS count
FROM grid CROSS JOIN mm LEFT JOIN cnt ON cnt.{by} = grid.{by} AND cnt.bin = grid.bin"""


@register("ctr_histogram", _users_sql(_histogram_sql("users", "ctr")))
def q_ctr_histogram(spark, sf_dir):
    return X.histogram(_users(spark, sf_dir), "ctr", "exp_group", 10)


GLOBAL_CTR_BODY = """SELECT exp_group, CAST(sum(likes) AS BIGINT) AS likes, CAST(sum(views) AS BIGINT) AS views,
  CAST(sum(likes) AS DOUBLE) / NULLIF(sum(views), 0) AS global_ctr FROM users GROUP BY 1"""


@register("global_ctr", _users_sql(GLOBAL_CTR_BODY))
def q_global_ctr(spark, sf_dir):
    return X.global_ctr(_users(spark, sf_dir))


def _welch_sql(source: str, value: str, group: str, a, b) -> str:
    return f"""
SELECT n_a, n_b, round(mean_a, {ROUND}) AS mean_a, round(mean_b, {ROUND}) AS mean_b,
       round(var_a, {ROUND}) AS var_a, round(var_b, {ROUND}) AS var_b, n_undefined,
       round((mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b), {ROUND}) AS t_stat,
       round(power(var_a / n_a + var_b / n_b, 2)
             / (power(var_a / n_a, 2) / (n_a - 1) + power(var_b / n_b, 2) / (n_b - 1)), {ROUND}) AS dof
FROM (
  SELECT count({value}) FILTER (WHERE {group} = {a}) AS n_a,
         count({value}) FILTER (WHERE {group} = {b}) AS n_b,
         avg({value}) FILTER (WHERE {group} = {a}) AS mean_a,
         avg({value}) FILTER (WHERE {group} = {b}) AS mean_b,
         var_samp({value}) FILTER (WHERE {group} = {a}) AS var_a,
         var_samp({value}) FILTER (WHERE {group} = {b}) AS var_b,
         count(*) FILTER (WHERE {group} IN ({a}, {b}) AND {value} IS NULL) AS n_undefined
  FROM {source}) s
"""


def _welch_p_sql(source: str, value: str, group: str, a, b) -> str:
    """The test with its p-value; t and dof unrounded inside."""
    return f"""
, stat AS (
  SELECT *, (mean_a - mean_b) / nullif(sqrt(var_a / n_a + var_b / n_b), 0) AS t,
         power(var_a / n_a + var_b / n_b, 2)
           / nullif(power(var_a / n_a, 2) / (n_a - 1) + power(var_b / n_b, 2) / (n_b - 1), 0) AS f
  FROM (
    SELECT count({value}) FILTER (WHERE {group} = {a}) AS n_a,
           count({value}) FILTER (WHERE {group} = {b}) AS n_b,
           avg({value}) FILTER (WHERE {group} = {a}) AS mean_a,
           avg({value}) FILTER (WHERE {group} = {b}) AS mean_b,
           var_samp({value}) FILTER (WHERE {group} = {a}) AS var_a,
           var_samp({value}) FILTER (WHERE {group} = {b}) AS var_b,
           count(*) FILTER (WHERE {group} IN ({a}, {b}) AND {value} IS NULL) AS n_undefined
    FROM {source}) s),
tail AS (SELECT *, {sql_t_two_sided("t", "f")} AS p FROM stat)
SELECT n_a, n_b, round(mean_a, {ROUND}) AS mean_a, round(mean_b, {ROUND}) AS mean_b,
       round(var_a, {ROUND}) AS var_a, round(var_b, {ROUND}) AS var_b, n_undefined,
       round(t, {ROUND}) AS t_stat, round(f, {ROUND}) AS dof, round(p, {P_ROUND}) AS p_value, p < {SIGNIFICANCE} AS significant
FROM tail
"""


_WELCH_ROUND = ["mean_a", "mean_b", "var_a", "var_b", "t_stat", "dof"]


def _mw_sql(source: str, value: str, group: str, a, b) -> str:
    return f"""
, vals AS (
  SELECT CAST({value} AS DOUBLE) AS v,
         count(*) FILTER (WHERE {group} = {a}) AS cnt_a,
         count(*) FILTER (WHERE {group} = {b}) AS cnt_b
  FROM {source} WHERE {group} IN ({a}, {b}) AND {value} IS NOT NULL GROUP BY 1),
cum AS (
  SELECT *, coalesce(sum(cnt_b) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cnt_b_below
  FROM vals),
agg AS (
  SELECT CAST(sum(cnt_a) AS BIGINT) AS n_a, CAST(sum(cnt_b) AS BIGINT) AS n_b,
         CAST(sum(cnt_a * (cnt_b_below + cnt_b / 2.0)) AS DOUBLE) AS u_a,
         CAST(sum(CAST(cnt_a + cnt_b AS DOUBLE) * (cnt_a + cnt_b) * (cnt_a + cnt_b) - (cnt_a + cnt_b)) AS DOUBLE) AS tie_term
  FROM cum)
SELECT n_a, n_b, u_a, CAST(n_a AS DOUBLE) * n_b - u_a AS u_b, tie_term,
       round(sqrt(CAST(n_a AS DOUBLE) * n_b / 12.0 * ((n_a + n_b + 1.0)
             - tie_term / (CAST(n_a + n_b AS DOUBLE) * (n_a + n_b - 1.0)))), {ROUND}) AS sigma
FROM agg
"""


def _mw_p_sql(source: str, value: str, group: str, a, b, alternative: str) -> str:
    """The asymptotic test with its p-value."""
    u, factor = {"two-sided": ("greatest(u_a, u_b)", 2), "less": ("u_b", 1), "greater": ("u_a", 1)}[alternative]
    stat = _mw_sql(source, value, group, a, b)
    head, _, tail = stat.rpartition("SELECT n_a, n_b, u_a,")
    tail = tail.replace("round(sqrt(", "(sqrt(").replace(f", {ROUND}) AS sigma", ") AS sigma")
    return f"""{head}, st AS (SELECT n_a, n_b, u_a,{tail}),
zs AS (SELECT *, ({u} - CAST(n_a AS DOUBLE) * n_b / 2 - 0.5) / nullif(sigma, 0) AS z FROM st),
ps AS (SELECT *, {sql_norm_sf("z")} AS sf FROM zs),
pv AS (SELECT *, CASE WHEN sf IS NOT NULL THEN least(1.0, {factor} * sf) END AS p FROM ps)
SELECT n_a, n_b, u_a, u_b, tie_term, round(sigma, {ROUND}) AS sigma, round(z, {ROUND}) AS z, round(p, {P_ROUND}) AS p_value,
       'asymptotic' AS method, '{alternative}' AS alternative, p < {SIGNIFICANCE} AS significant
FROM pv
"""


@register("welch_ctr_stat", _users_sql(_welch_sql("users", "ctr", "exp_group", 1, 2)))
def q_welch_ctr_stat(spark, sf_dir):
    return _rounded(X.welch_stats(_users(spark, sf_dir), "ctr", "exp_group", 1, 2), _WELCH_ROUND)


@register("welch_ctr", _users_sql(_welch_p_sql("users", "ctr", "exp_group", 1, 2)))
def q_welch_ctr(spark, sf_dir):
    return _rounded(X.welch_ttest(_users(spark, sf_dir), "ctr", "exp_group", 1, 2, SIGNIFICANCE), _WELCH_ROUND)


@register("mann_whitney_ctr_stat", _users_sql(_mw_sql("users", "ctr", "exp_group", 1, 2)))
def q_mann_whitney_ctr_stat(spark, sf_dir):
    return _rounded(X.mann_whitney_stats(_users(spark, sf_dir), "ctr", "exp_group", 1, 2), ["sigma"])


@register("mann_whitney_ctr", _users_sql(_mw_p_sql("users", "ctr", "exp_group", 1, 2, "two-sided")))
def q_mann_whitney_ctr(spark, sf_dir):
    return _rounded(X.mann_whitney(_users(spark, sf_dir), "ctr", "exp_group", 1, 2, "two-sided", SIGNIFICANCE), ["sigma", "z"])


SMOOTHED_SELECT = f"""SELECT u.exp_group, u.user_id, u.likes, u.views, u.ctr, g.global_ctr,
       (u.likes + {SMOOTHING_ALPHA} * g.global_ctr) / (u.views + {SMOOTHING_ALPHA}) AS smoothed_ctr
FROM users u JOIN g USING (exp_group)"""
SMOOTHED_BODY = f""", g AS ({GLOBAL_CTR_BODY})
{SMOOTHED_SELECT}"""


@register("smoothed_ctr", _users_sql(SMOOTHED_BODY))
def q_smoothed_ctr(spark, sf_dir):
    return X.smoothed_ctr(_users(spark, sf_dir), SMOOTHING_ALPHA)


@register(
    "welch_smoothed_stat",
    _users_sql(f", g AS ({GLOBAL_CTR_BODY}), sm AS ({SMOOTHED_SELECT})" + _welch_sql("sm", "smoothed_ctr", "exp_group", 1, 2)),
)
def q_welch_smoothed_stat(spark, sf_dir):
    sm = X.smoothed_ctr(_users(spark, sf_dir), SMOOTHING_ALPHA)
    return _rounded(X.welch_stats(sm, "smoothed_ctr", "exp_group", 1, 2), _WELCH_ROUND)


@register(
    "welch_smoothed",
    _users_sql(f", g AS ({GLOBAL_CTR_BODY}), sm AS ({SMOOTHED_SELECT})" + _welch_p_sql("sm", "smoothed_ctr", "exp_group", 1, 2)),
)
def q_welch_smoothed(spark, sf_dir):
    sm = X.smoothed_ctr(_users(spark, sf_dir), SMOOTHING_ALPHA)
    return _rounded(X.welch_ttest(sm, "smoothed_ctr", "exp_group", 1, 2, SIGNIFICANCE), _WELCH_ROUND)


BUCKET_BODY = f"""SELECT exp_group, CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8))::BIGINT % {N_BUCKETS} AS INTEGER) AS bucket,
       CAST(sum(likes) AS DOUBLE) / NULLIF(sum(views), 0) AS bucket_ctr,
       percentile_disc(0.5) WITHIN GROUP (ORDER BY ctr DESC) AS median_ctr
FROM users GROUP BY 1, 2"""


def _buckets(spark, sf_dir) -> DataFrame:
    return X.bucket_ctr(_users(spark, sf_dir), N_BUCKETS, "md5")


EXACT_BUCKETS = 12
# The groups of equal values are dealt out from the least up: of the c members of group
# j, i go to the treatment, whose doubled U grows by 2 i (others below) + i (c - i).
_EXACT_SQL = f"""
, bk AS ({BUCKET_BODY.replace(f"% {N_BUCKETS}", f"% {EXACT_BUCKETS}")})
, g AS (SELECT row_number() OVER (ORDER BY bucket_ctr) AS j, count(*) AS c, count(*) FILTER (WHERE exp_group = 2) AS own,
               coalesce(sum(count(*)) OVER (ORDER BY bucket_ctr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
               coalesce(sum(count(*) FILTER (WHERE exp_group = 1)) OVER (ORDER BY bucket_ctr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS others
        FROM bk WHERE bucket_ctr IS NOT NULL AND exp_group IN (1, 2) GROUP BY bucket_ctr)
, s AS (SELECT sum(own) AS n_a, sum(c - own) AS n_b, sum(own * others + own * (c - own) / 2.0) AS u_a, max(j) AS last FROM g)
, dp AS (
  SELECT 0::BIGINT AS j, 0::BIGINT AS k, 0::BIGINT AS u2, 1.0::DOUBLE AS ways
  UNION ALL
  SELECT j, k, u2, sum(ways) FROM (
    SELECT g.j AS j, dp.k + r.i AS k, (dp.u2 + 2 * r.i * (g.below - dp.k) + r.i * (g.c - r.i))::BIGINT AS u2,
           dp.ways * factorial(g.c::INTEGER)::DOUBLE / (factorial(r.i::INTEGER)::DOUBLE * factorial((g.c - r.i)::INTEGER)::DOUBLE) AS ways
    FROM dp JOIN g ON g.j = dp.j + 1, s, range(0, {2 * EXACT_BUCKETS + 1}) r(i) WHERE r.i <= g.c AND dp.k + r.i <= s.n_a) x
  GROUP BY j, k, u2)
SELECT s.n_a::BIGINT AS n_a, s.n_b::BIGINT AS n_b, s.u_a::DOUBLE AS u_a,
       round(sum(ways) FILTER (WHERE u2 >= 2 * s.u_a) / sum(ways), 10) AS p_value
FROM dp, s WHERE dp.j = s.last AND dp.k = s.n_a GROUP BY ALL"""


@register("mann_whitney_exact_buckets", _users_sql(_EXACT_SQL).replace("WITH ", "WITH RECURSIVE ", 1))
def q_mann_whitney_exact_buckets(spark, sf_dir):
    """Exact one-sided test of the bucket CTRs, treatment against control; few
    buckets a group, so the normal approximation would be poor."""
    buckets = X.bucket_ctr(_users(spark, sf_dir), EXACT_BUCKETS, "md5")
    out = X.mann_whitney(buckets, "bucket_ctr", "exp_group", 2, 1, "greater", SIGNIFICANCE, method="exact")
    return out.select("n_a", "n_b", "u_a", F.round("p_value", 10).alias("p_value"))


@register("bucket_ctr", _users_sql(BUCKET_BODY))
def q_bucket_ctr(spark, sf_dir):
    return _buckets(spark, sf_dir)


@register("welch_bucket_stat", _users_sql(f", bk AS ({BUCKET_BODY})" + _welch_sql("bk", "bucket_ctr", "exp_group", 1, 2)))
def q_welch_bucket_stat(spark, sf_dir):
    return _rounded(X.welch_stats(_buckets(spark, sf_dir), "bucket_ctr", "exp_group", 1, 2), _WELCH_ROUND)


@register("welch_bucket", _users_sql(f", bk AS ({BUCKET_BODY})" + _welch_p_sql("bk", "bucket_ctr", "exp_group", 1, 2)))
def q_welch_bucket(spark, sf_dir):
    return _rounded(X.welch_ttest(_buckets(spark, sf_dir), "bucket_ctr", "exp_group", 1, 2, SIGNIFICANCE), _WELCH_ROUND)


@register("mann_whitney_bucket_less_stat", _users_sql(f", bk AS ({BUCKET_BODY})" + _mw_sql("bk", "bucket_ctr", "exp_group", 2, 1)))
def q_mann_whitney_bucket_less_stat(spark, sf_dir):
    return _rounded(X.mann_whitney_stats(_buckets(spark, sf_dir), "bucket_ctr", "exp_group", 2, 1), ["sigma"])


@register("mann_whitney_bucket_less", _users_sql(f", bk AS ({BUCKET_BODY})" + _mw_p_sql("bk", "bucket_ctr", "exp_group", 2, 1, "less")))
def q_mann_whitney_bucket_less(spark, sf_dir):
    return _rounded(X.mann_whitney(_buckets(spark, sf_dir), "bucket_ctr", "exp_group", 2, 1, "less", SIGNIFICANCE), ["sigma", "z"])


_TWO52 = "CAST(4503599627370496 AS DOUBLE)"
BOOT_BODY = f""", tuples AS (SELECT exp_group, likes, views, CAST(count(*) AS DOUBLE) AS c FROM users GROUP BY 1, 2, 3),
ks AS (
  SELECT *, unnest(range(greatest(0, CAST(floor(c - 12 * sqrt(c) - 20) AS BIGINT)), CAST(ceil(c + 12 * sqrt(c) + 40) AS BIGINT) + 1)) AS k
  FROM tuples),
cdfs AS (
  SELECT exp_group, likes, views, k,
         sum(exp(k * ln(c) - c - lgamma(k + 1.0))) OVER (PARTITION BY exp_group, likes, views ORDER BY k ROWS UNBOUNDED PRECEDING) AS cdf
  FROM ks),
draws AS (
  SELECT b.boot_id, t.*,
         CAST(('0x' || substr(md5(concat_ws('-', '{SEED}', CAST(b.boot_id AS VARCHAR), CAST(t.exp_group AS VARCHAR),
           CAST(t.likes AS VARCHAR), CAST(t.views AS VARCHAR))), 1, 13))::BIGINT AS DOUBLE) / {_TWO52} AS uu
  FROM tuples t CROSS JOIN (SELECT CAST(range AS INTEGER) AS boot_id FROM range(0, {N_BOOTSTRAP})) b),
weighted AS (
  SELECT d.boot_id, d.exp_group, d.likes, d.views, min(f.k) AS w
  FROM draws d JOIN cdfs f ON f.exp_group = d.exp_group AND f.likes = d.likes AND f.views = d.views AND f.cdf > d.uu
  GROUP BY 1, 2, 3, 4),
boot AS (
  SELECT boot_id, exp_group, CAST(sum(w * likes) AS BIGINT) AS likes, CAST(sum(w * views) AS BIGINT) AS views,
         CAST(sum(w * likes) AS DOUBLE) / NULLIF(sum(w * views), 0) AS ctr
  FROM weighted GROUP BY 1, 2)"""
CI_BODY = """per AS (SELECT boot_id, max(ctr) FILTER (WHERE exp_group = 1) AS ctr_a, max(ctr) FILTER (WHERE exp_group = 2) AS ctr_b
        FROM boot GROUP BY 1),
d AS (SELECT ctr_b - ctr_a AS diff FROM per)"""


def _bootstrap(spark, sf_dir) -> DataFrame:
    return X.poisson_bootstrap(_users(spark, sf_dir), N_BOOTSTRAP, SEED)


@register("poisson_bootstrap", _users_sql(BOOT_BODY + "\nSELECT * FROM boot"))
def q_poisson_bootstrap(spark, sf_dir):
    return _bootstrap(spark, sf_dir)


@register(
    "bootstrap_ci",
    _users_sql(
        BOOT_BODY
        + f""",
{CI_BODY}
SELECT count(diff) AS n_boot, round(avg(diff), {ROUND}) AS mean_diff,
       round(quantile_cont(diff, 0.025), {ROUND}) AS ci_lo, round(quantile_cont(diff, 0.975), {ROUND}) AS ci_hi,
       quantile_cont(diff, 0.025) <= 0 AND quantile_cont(diff, 0.975) >= 0 AS contains_zero
FROM d"""
    ),
)
def q_bootstrap_ci(spark, sf_dir):
    return _rounded(X.bootstrap_ci(_bootstrap(spark, sf_dir)), ["mean_diff", "ci_lo", "ci_hi"])


@register(
    "smoothed_ctr_histogram",
    _users_sql(f", g AS ({GLOBAL_CTR_BODY}), sm AS ({SMOOTHED_SELECT})" + _histogram_sql("sm", "smoothed_ctr")),
)
def q_smoothed_ctr_histogram(spark, sf_dir):
    """X2 over the smoothed CTR of each group."""
    return X.histogram(X.smoothed_ctr(_users(spark, sf_dir), SMOOTHING_ALPHA), "smoothed_ctr", "exp_group", 10)


@register("bucket_ctr_histogram", _users_sql(f", bk AS ({BUCKET_BODY})" + _histogram_sql("bk", "bucket_ctr")))
def q_bucket_ctr_histogram(spark, sf_dir):
    """X2 over the bucket CTR of each group."""
    return X.histogram(_buckets(spark, sf_dir), "bucket_ctr", "exp_group", 10)


@register("bootstrap_ctr_histogram", _users_sql(BOOT_BODY + _histogram_sql("boot", "ctr")))
def q_bootstrap_ctr_histogram(spark, sf_dir):
    """X2 over the replicate CTRs of each group."""
    return X.histogram(_bootstrap(spark, sf_dir), "ctr", "exp_group", 10)


@register(
    "bootstrap_diff_histogram",
    _users_sql(
        BOOT_BODY
        + """,
per AS (SELECT boot_id, max(ctr) FILTER (WHERE exp_group = 1) AS ctr_a, max(ctr) FILTER (WHERE exp_group = 2) AS ctr_b
        FROM boot GROUP BY 1),
d AS (SELECT 'diff' AS series, ctr_b - ctr_a AS diff FROM per)"""
        + _histogram_sql("d", "diff", by="series")
    ),
)
def q_bootstrap_diff_histogram(spark, sf_dir):
    """X2 over the replicate differences (group 2 minus group 1)."""
    boot = _bootstrap(spark, sf_dir)
    g = F.col("exp_group")
    per = boot.groupBy("boot_id").agg(
        F.max(F.when(g == 1, F.col("ctr"))).alias("ctr_a"), F.max(F.when(g == 2, F.col("ctr"))).alias("ctr_b")
    )
    diff = per.select(F.lit("diff").alias("series"), (F.col("ctr_b") - F.col("ctr_a")).alias("diff"))
    return X.histogram(diff, "diff", "series", 10)


def _summary_sql() -> str:
    """One row per test, each from the oracle of the single test."""
    tests = (
        ("welch_ctr", "t_stat", _welch_p_sql("users", "ctr", "exp_group", 1, 2)),
        ("mann_whitney_ctr", "u_a", _mw_p_sql("users", "ctr", "exp_group", 1, 2, "two-sided")),
        ("welch_smoothed_ctr", "t_stat", f", g AS ({GLOBAL_CTR_BODY}), sm AS ({SMOOTHED_SELECT})" + _welch_p_sql("sm", "smoothed_ctr", "exp_group", 1, 2)),
        ("welch_bucket_ctr", "t_stat", f", bk AS ({BUCKET_BODY})" + _welch_p_sql("bk", "bucket_ctr", "exp_group", 1, 2)),
        ("mann_whitney_bucket_ctr_less", "u_a", f", bk AS ({BUCKET_BODY})" + _mw_p_sql("bk", "bucket_ctr", "exp_group", 2, 1, "less")),
    )
    rows = [
        f"SELECT '{name}' AS test, CAST({statistic} AS DOUBLE) AS statistic, p_value, significant, NULL::DOUBLE AS ci_lo, NULL::DOUBLE AS ci_hi FROM ({_users_sql(body)}) x"
        for name, statistic, body in tests
    ]
    interval = _users_sql(
        BOOT_BODY
        + f""",
{CI_BODY}
SELECT round(avg(diff), {ROUND}) AS statistic, quantile_cont(diff, 0.025) > 0 OR quantile_cont(diff, 0.975) < 0 AS significant,
       round(quantile_cont(diff, 0.025), {ROUND}) AS ci_lo, round(quantile_cont(diff, 0.975), {ROUND}) AS ci_hi FROM d"""
    )
    rows.append(f"SELECT 'bootstrap_ctr_difference', statistic, NULL::DOUBLE, significant, ci_lo, ci_hi FROM ({interval}) x")
    return "\nUNION ALL\n".join(rows)


@register("ab_summary", _summary_sql())
def q_ab_summary(spark, sf_dir):
    """Every approach of the experiment analysis in one frame."""
    from feedlens.plans.ab_analysis import ab_summary

    out = ab_summary(feed_actions(spark, sf_dir), EXP_START, EXP_END, alpha=SIGNIFICANCE, n_bootstrap=N_BOOTSTRAP, n_buckets=N_BUCKETS, seed=SEED)
    return _rounded(out, ["statistic", "ci_lo", "ci_hi"])
