"""Tail probabilities and test statistics against known values."""

from __future__ import annotations

import math

import numpy as np
import pytest

from pyspark.sql import functions as F

from feedlens.functions import tails
from feedlens.functions.stats import mw_exact_sf_np, mw_exact_ties_sf_np
from feedlens.operators import experiments as X


def _t_tail(t: float, dof: float) -> float:
    """P(T > t) from the density with its gamma constant, by a fine rule on y in
    [0, 1) with x = |t| + y / (1 - y)."""
    y = np.linspace(0, 1, 400001)[:-1]
    x = abs(t) + y / (1 - y)
    log_constant = math.lgamma((dof + 1) / 2) - math.lgamma(dof / 2) - 0.5 * math.log(dof * math.pi)
    f = np.exp(log_constant - (dof + 1) / 2 * np.log1p(x * x / dof)) / (1 - y) ** 2
    w = np.where(np.arange(len(f)) % 2 == 1, 4.0, 2.0)
    w[0] = 1.0
    tail = float((w * f).sum() / 3 / 400000)
    return tail if t >= 0 else 1 - tail


def _tails(spark, rows):
    df = spark.createDataFrame([(float(t), float(d)) for t, d in rows], "t double, dof double")
    return df.select("t", "dof", tails.t_sf(F.col("t"), F.col("dof")).alias("p"), tails.t_two_sided_p(F.col("t"), F.col("dof")).alias("p2")).collect()


def test_known_tail_values(spark):
    (t,) = _tails(spark, [(2.0, 10)])
    assert 1 - t.p == pytest.approx(0.96330598, abs=1e-8)
    z = spark.range(1).select(tails.norm_sf(F.lit(1.96)).alias("p")).first()
    assert 1 - z.p == pytest.approx(0.97500210, abs=1e-8)


def test_t_tail_against_density(spark):
    rng = np.random.default_rng(3)
    rows = [*zip(rng.normal(0, 3, 30), rng.uniform(1, 500, 30)), (0.0, 5.0), (-1.3, 7.0), (1.3, 7.0), (1.96, 2.5)]
    for r in _tails(spark, rows):
        assert r.p == pytest.approx(_t_tail(r.t, r.dof), abs=1e-8)
        assert r.p2 == pytest.approx(2 * _t_tail(abs(r.t), r.dof), abs=1e-8)


def test_t_tail_at_extreme_degrees(spark):
    # one degree of freedom is the Cauchy law, very many are the normal one
    for r in _tails(spark, [(0.5, 1.0), (40.0, 1.0)]):
        assert r.p == pytest.approx(0.5 - math.atan(r.t) / math.pi, abs=1e-10)
    for r in _tails(spark, [(1.96, 1e9), (5.0, 1e9), (1.96, 1e15)]):
        assert r.p == pytest.approx(0.5 * math.erfc(r.t / math.sqrt(2)), rel=1e-7)


def test_norm_tail(spark):
    z = spark.createDataFrame([(float(v),) for v in (-3.0, -0.5, 0.0, 0.7, 1.96, 6.0, 12.0)], "z double")
    for r in z.select("z", tails.norm_sf(F.col("z")).alias("p")).collect():
        assert r.p == pytest.approx(0.5 * math.erfc(r.z / math.sqrt(2)), abs=1e-10)


def test_undefined_tails_are_null(spark):
    df = spark.createDataFrame([(None, 3.0), (float("nan"), 3.0), (1.0, None), (1.0, 0.0)], "t double, dof double")
    got = df.select(tails.t_sf(F.col("t"), F.col("dof")).alias("a"), tails.t_two_sided_p(F.col("t"), F.col("dof")).alias("b")).collect()
    assert all(r.a is None and r.b is None for r in got)


def _two_groups(spark, a, b, col="v"):
    rows = [(1, float(x)) for x in a] + [(2, float(x)) for x in b]
    return spark.createDataFrame(rows, f"g int, {col} double")


def test_welch_fixture(spark):
    df = _two_groups(spark, [1, 2, 3, 4], [2, 4, 6, 8, 10])
    r = X.welch_ttest(df, "v", "g", 1, 2).first()
    assert r.t_stat == pytest.approx(-2.2514363, abs=1e-6)
    assert r.dof == pytest.approx(5.5207877, abs=1e-6)
    assert r.p_value == pytest.approx(0.0691336, abs=1e-6)
    assert r.significant is False


def test_mann_whitney_fixture_two_sided(spark):
    df = _two_groups(spark, [1, 2, 3, 4], [2, 4, 6, 8, 10])
    r = X.mann_whitney(df, "v", "g", 1, 2, "two-sided", ranges=3).first()
    assert (r.u_a, r.u_b) == (3.0, 17.0)
    assert r.sigma == pytest.approx(4.0483193, abs=1e-6)
    assert r.p_value == pytest.approx(0.1083608, abs=1e-6)


def test_mann_whitney_fixture_less(spark):
    df = _two_groups(spark, [1, 2, 3, 4], [2, 4, 6, 8, 10])
    r = X.mann_whitney(df, "v", "g", 1, 2, "less").first()
    assert r.p_value == pytest.approx(0.0541804, abs=1e-6)
    assert r.u_a + r.u_b == r.n_a * r.n_b


def test_mann_whitney_equals_pair_count(spark):
    rng = np.random.default_rng(7)
    a = rng.integers(0, 15, 60)
    b = rng.integers(0, 15, 45)
    df = _two_groups(spark, a, b)
    r = X.mann_whitney_stats(df, "v", "g", 1, 2, ranges=5).first()
    brute = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    assert r.u_a == pytest.approx(brute)


def test_bucket_upper_median(spark):
    users = spark.createDataFrame(
        [(1, i, likes, 10) for i, likes in enumerate([4, 1, 3, 2])] + [(2, 9 + i, likes, 10) for i, likes in enumerate([3, 1, 2, 2])] + [(2, 20, 1, 0)],
        "exp_group int, user_id long, likes long, views long",
    ).withColumn("ctr", F.expr("likes / nullif(views, 0)"))
    got = {r.exp_group: r.median_ctr for r in X.bucket_ctr(users, 1).collect()}
    assert got == {1: 0.3, 2: 0.2}


def test_poisson_bootstrap_agrees_with_users_one_by_one(spark):
    """Mean and variance of the replicate sums: those of one Poisson(1) weight per
    user, sum of x and sum of x squared."""
    rng = np.random.default_rng(5)
    likes, views = rng.integers(0, 4, 600), rng.integers(1, 9, 600)
    users = spark.createDataFrame([(1, i, int(a), int(b)) for i, (a, b) in enumerate(zip(likes, views))], "exp_group int, user_id long, likes long, views long")
    n = 3000
    got = X.poisson_bootstrap(users, n=n, seed=3).toPandas()
    for column, x in (("likes", likes), ("views", views)):
        mean, var = x.sum(), (x * x).sum()
        assert abs(got[column].mean() - mean) < 5 * math.sqrt(var / n)
        assert got[column].var() == pytest.approx(var, rel=0.15)


def test_log_factorial(spark):
    from feedlens.functions.columns import log_factorial

    ns = [0, 1, 2, 5, 20, 1000, 10**8]
    df = spark.createDataFrame([(n,) for n in ns], "n long")
    for r in df.select("n", log_factorial(F.col("n")).alias("x")).collect():
        assert r.x == pytest.approx(math.lgamma(r.n + 1), rel=1e-12, abs=1e-11)


def test_undefined_tests_are_null(spark):
    constant = _two_groups(spark, [2, 2, 2], [2, 2])
    single = _two_groups(spark, [1], [2])
    empty = _two_groups(spark, [1, 2, 3], [])
    for df in (constant, single, empty):
        r = X.welch_ttest(df, "v", "g", 1, 2).first()
        assert r.p_value is None and r.significant is None
    for df in (constant, empty):
        r = X.mann_whitney(df, "v", "g", 1, 2).first()
        assert r.p_value is None and r.significant is None
    tied = X.mann_whitney(constant, "v", "g", 1, 2, method="exact").first()
    assert tied.p_value is None


def test_mann_whitney_few_against_many(spark):
    """Eight values below two thousand others."""
    df = _two_groups(spark, range(8), range(100, 2100))
    r = X.mann_whitney(df, "v", "g", 1, 2).first()
    assert r.method == "asymptotic" and r.significant is True
    assert r.p_value == pytest.approx(1.0e-6, rel=0.1)
    e = X.mann_whitney(df, "v", "g", 1, 2, method="exact").first()
    assert e.p_value == pytest.approx(2 / math.comb(2008, 8), rel=1e-9) and e.significant is True


def test_mann_whitney_exact_forty_against_forty(spark):
    df = _two_groups(spark, range(0, 80, 2), [x + 21 for x in range(0, 80, 2)])
    r = X.mann_whitney(df, "v", "g", 1, 2, method="exact").first()
    a = X.mann_whitney(df, "v", "g", 1, 2).first()
    assert r.p_value == pytest.approx(a.p_value, abs=2e-3) and 0 < r.p_value < 0.01


def test_mw_exact_distribution():
    from itertools import combinations

    # brute force over all arrangements of 3 + 4 distinct values
    m, n = 3, 4
    us = []
    for pick in combinations(range(m + n), m):
        ranks = sum(r + 1 for r in pick)
        us.append(ranks - m * (m + 1) / 2)
    for u in range(0, m * n + 1):
        assert mw_exact_sf_np(u, m, n) == pytest.approx(sum(x >= u for x in us) / len(us))
    assert mw_exact_sf_np(8 * 1000, 8, 1000) == pytest.approx(1 / math.comb(1008, 8), rel=1e-9)


def test_mann_whitney_exact_small(spark):
    df = _two_groups(spark, [1, 2, 3], [4, 5, 6, 7])
    r = X.mann_whitney(df, "v", "g", 1, 2, "two-sided", method="exact").first()
    assert r.method == "exact" and r.u_a == 0.0
    assert r.p_value == pytest.approx(2 / 35)
    assert X.mann_whitney(df, "v", "g", 1, 2, "less", method="exact").first().p_value == pytest.approx(1 / 35)
    assert X.mann_whitney(df, "v", "g", 1, 2, "greater", method="exact").first().p_value == pytest.approx(1.0)
    assert X.mann_whitney(df, "v", "g", 1, 2).first().method == "asymptotic"


def test_bootstrap_hashes_once_a_row(spark):
    """No md5 inside the search of the distribution, and replicates dealt by block."""
    users = spark.createDataFrame([(1, 2, 5), (2, 1, 4), (1, 0, 3)], "exp_group int, likes long, views long")
    plan = X.poisson_bootstrap(users, n=120)._jdf.queryExecution().optimizedPlan().toString()
    start = plan.index("filter(cdf")
    depth, end = 0, start + len("filter")
    while True:
        depth += {"(": 1, ")": -1}.get(plan[end], 0)
        end += 1
        if not depth:
            break
    assert "md5" in plan and "md5" not in plan[start:end]
    assert "RepartitionByExpression" in plan and "block" in plan
    got = X.poisson_bootstrap(users, n=120).collect()
    assert sorted((r.boot_id, r.exp_group) for r in got) == [(b, g) for b in range(120) for g in (1, 2)]


def _permutation_tail(a, b):
    """P(U >= u) over all ways to deal the values, ties counting a half."""
    from itertools import combinations

    def u_of(x, y):
        return sum((p > q) + (p == q) / 2 for p in x for q in y)

    every, u = [*a, *b], u_of(a, b)
    us = []
    for pick in combinations(range(len(every)), len(a)):
        us.append(u_of([every[i] for i in pick], [every[i] for i in range(len(every)) if i not in pick]))
    return sum(x >= u for x in us) / len(us)


def test_mw_exact_with_ties(spark):
    rng = np.random.default_rng(6)
    for m, n, top in ((3, 4, 3), (5, 4, 4), (2, 7, 2), (4, 4, 9), (6, 3, 2), (3, 3, 1)):
        a, b = rng.integers(0, top, m).tolist(), rng.integers(0, top, n).tolist()
        p = _permutation_tail(a, b)
        df = _two_groups(spark, a, b)
        r = X.mann_whitney(df, "v", "g", 1, 2, "greater", method="exact").first()
        assert r.p_value == pytest.approx(p)
        assert X.mann_whitney(df, "v", "g", 2, 1, "less", method="exact").first().p_value == pytest.approx(p)
        two = X.mann_whitney(df, "v", "g", 1, 2, method="exact").first()
        larger = p if two.u_a >= two.u_b else _permutation_tail(b, a)
        assert two.p_value == pytest.approx(min(1.0, 2 * larger))


def test_mw_exact_ties_agree_without_ties():
    for m, n, u in ((3, 4, 9), (7, 5, 20.0), (8, 30, 200)):
        assert mw_exact_ties_sf_np(u, m, n, [1] * (m + n)) == pytest.approx(mw_exact_sf_np(u, m, n))
    tied = [3, 1, 2, 500, 2]  # one large group of equal values
    assert mw_exact_ties_sf_np(0, 8, 500, tied) == pytest.approx(1.0)
