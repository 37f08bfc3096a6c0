"""Prediction intervals: closed forms against matrices and sums, widening, coverage."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlens.functions import tails
from feedlens.operators import forecast as FC

SCHEMA = "series_id string, fold int, role string, day date, y double, dau_std double, anomaly int"
DAY0 = dt.date(2024, 1, 1)


def rows_of(name, y, x1=None, x2=None, horizon=10):
    """Training days with ``y``, then ``horizon`` days without."""
    n = len(y)
    x1 = [0.0] * (n + horizon) if x1 is None else x1
    x2 = [0] * (n + horizon) if x2 is None else x2
    return [
        (name, 0, "train" if i < n else "future", DAY0 + dt.timedelta(i), float(y[i]) if i < n else None, float(x1[i]), int(x2[i]))
        for i in range(n + horizon)
    ]


def fitted(spark, rows):
    out = {}
    for r in FC.fit_models(spark.createDataFrame(rows, SCHEMA)).orderBy("day").collect():
        out.setdefault((r.series_id, r.model), []).append((r.prediction, r.lo, r.hi))
    return {k: np.array(v, float) for k, v in out.items()}


def test_t_quantile(spark):
    known = {1: 6.313751515, 2: 2.919985580, 5: 2.015048373, 10: 1.812461123, 30: 1.697260887, 120: 1.657650899}
    df = spark.createDataFrame([(float(d),) for d in known], "dof double")
    for r in df.select("dof", tails.t_quantile(0.95, F.col("dof")).alias("hi"), tails.t_quantile(0.05, F.col("dof")).alias("lo")).collect():
        assert r.hi == pytest.approx(known[int(r.dof)], abs=1e-8) and r.lo == pytest.approx(-r.hi)
    odd = spark.createDataFrame([(2.5,), (0.7,), (1e7,)], "dof double")
    found = spark.createDataFrame(odd.select("dof", tails.t_quantile(0.99, F.col("dof")).alias("q")).collect())
    back = found.select(tails.t_sf(F.col("q"), F.col("dof")).alias("p")).collect()
    assert [r.p for r in back] == pytest.approx([0.01] * 3, rel=1e-6)
    none = spark.createDataFrame([(None,), (0.0,), (-3.0,), (float("nan"),)], "dof double")
    assert [r.q for r in none.select(tails.t_quantile(0.95, F.col("dof")).alias("q")).collect()] == [None] * 4
    with pytest.raises(ValueError):
        tails.t_quantile(1.0, F.lit(3))


def test_line_intervals_equal_the_matrix_form(spark):
    """x (X'X)^-1 x of the regressors in use, trend and constant included."""
    rng = np.random.default_rng(2)
    n, h = 20, 10
    t = np.arange(n + h)
    x1, x2 = rng.normal(0, 1, n + h), (t % 5 == 0).astype(int)
    cases = {"both": (2.0, 3.0), "first": (2.0, -3.0), "second": (-2.0, 3.0), "neither": (-2.0, -3.0)}
    rows, want = [], {}
    for name, (b1, b2) in cases.items():
        y = 0.3 * t[:n] + b1 * x1[:n] + b2 * x2[:n] + rng.normal(0, 0.2, n)
        rows += rows_of(name, y, x1, x2, h)
        use = [c for c, b in ((x1, b1), (x2, b2)) if b > 0]
        X = np.column_stack([np.ones(n + h), t, *use])
        beta, (sse,), *_ = np.linalg.lstsq(X[:n], y, rcond=None)
        dof = n - X.shape[1]
        lev = np.einsum("ij,jk,ik->i", X[n:], np.linalg.inv(X[:n].T @ X[:n]), X[n:])
        want[name] = (X[n:] @ beta, np.sqrt(sse / dof * (1 + lev)), dof)
    got = fitted(spark, rows)
    q = {r.dof: r.q for r in spark.range(10, 20).select(F.col("id").alias("dof"), tails.t_quantile(0.95, F.col("id")).alias("q")).collect()}
    for name, (mean, sd, dof) in want.items():
        p, lo, hi = got[name, "linear_reg"].T
        assert p == pytest.approx(mean) and hi - p == pytest.approx(q[dof] * sd) and p - lo == pytest.approx(q[dof] * sd)


def test_local_trend_variance_is_the_recursion(spark):
    """The closed form against errors carried through the state step by step."""
    params = [(0.05, 0.05, 0.8), (0.95, 0.5, 0.98), (0.45, 0.23, 0.9)]
    for a, b, phi in params:
        h = spark.range(1, 31).select(F.col("id").cast("double").alias("h"))
        got = [r.v for r in h.select(FC._carried(F.col("h"), F.lit(a), F.lit(b), F.lit(phi)).alias("v")).collect()]
        want = []
        for steps in range(1, 31):
            total = 0.0
            for ago in range(1, steps):  # one unit error so many steps before the last
                level, trend = a, a * b
                for _ in range(ago - 1):
                    level, trend = level + phi * trend, phi * trend
                total += (level + phi * trend) ** 2
            want.append(total)
        assert got == pytest.approx(want, rel=1e-9, abs=1e-12)


def test_intervals_widen_for_all_models(spark):
    rng = np.random.default_rng(4)
    n, h = 25, 30
    rows = rows_of("s", 0.1 * np.arange(n) + rng.normal(0, 1, n), rng.normal(0, 1, n).tolist() + [0.0] * h, [0] * (n + h), h)
    got = fitted(spark, rows)
    for model in FC.MODELS:
        p, lo, hi = got["s", model].T
        width = hi - lo
        assert (np.diff(width) > 0).all() and hi + lo == pytest.approx(2 * p)


def test_coverage_on_drawn_series(spark):
    """Nine in ten new values lie inside: exactly so for lines, about for local trends."""
    rng = np.random.default_rng(11)
    n, h, many = 30, 10, 60
    rows, truth = [], {}
    for s in range(many):
        y = 5 + 0.2 * np.arange(n + h) + rng.normal(0, 1.5, n + h)
        rows += rows_of(f"line{s}", y[:n], horizon=h)
        truth[f"line{s}"] = y[n:]
        level, trend, z = 0.0, 0.3, []
        for _ in range(n + h):
            ahead = level + 0.9 * trend
            e = rng.normal()
            z.append(ahead + e)
            level, trend = ahead + 0.45 * e, 0.9 * trend + 0.45 * 0.23 * e
        rows += rows_of(f"local{s}", z[:n], horizon=h)
        truth[f"local{s}"] = np.array(z[n:])
    got = fitted(spark, rows)
    inside = lambda kind, model: np.mean([(got[k, model][:, 1] <= v) & (v <= got[k, model][:, 2]) for k, v in truth.items() if k.startswith(kind)])
    assert inside("line", "linear") == pytest.approx(0.9, abs=0.04)
    assert inside("local", "damped") == pytest.approx(0.9, abs=0.08)


def test_too_few_days(spark):
    rows = rows_of("one", [3.0], horizon=2) + rows_of("two", [3.0, 4.0], horizon=2) + rows_of("none", [], horizon=2) + rows_of("three", [1.0, 2.0, 4.0], horizon=2)
    got = fitted(spark, rows)
    assert len(got) == 16 and all(len(v) == 2 for v in got.values())
    assert np.isnan(got["one", "linear"]).all() and np.isnan(got["none", "damped"]).all()
    assert got["two", "linear"][:, 0] == pytest.approx([5.0, 6.0]) and np.isnan(got["two", "linear"][:, 1:]).all()
    assert np.isfinite(got["three", "linear"]).all() and np.isfinite(got["three", "damped"]).all()
