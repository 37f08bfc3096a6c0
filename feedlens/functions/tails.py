"""Student-t and normal tail probabilities as Spark Column expressions.

Both tails are one-dimensional integrals of a smooth, quickly falling function,
taken by Simpson's rule inside ``aggregate`` over ``sequence``; no Python runs.
With x = sqrt(dof) * sinh(w / sqrt(dof)) the t density becomes
cosh(w / sqrt(dof))^(-dof) up to its constant: exponential tails at one degree of
freedom, the normal curve as they grow, and the constant is the same integral
from 0.  So one form holds for any degrees of freedom, without gamma functions
and without a switch.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Intervals of the rule, and the fall (as a power of e) after which the rest is nil.
STEPS = 8000
FALL = 40.0


def _integral(f: Callable[[Column], Column], low: Column, width: Column, steps: int = STEPS) -> Column:
    h = width / float(steps)

    def add(total: Column, i: Column) -> Column:
        weight = F.when((i == 0) | (i == steps), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
        return total + weight * f(low + h * i.cast("double"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(steps)), F.lit(0.0), add) * h / 3.0


def _usable(*values: Column) -> Column:
    out = F.lit(True)
    for v in values:
        out = out & v.isNotNull() & ~F.isnan(v)
    return out


def norm_sf(z: Column) -> Column:
    """P(Z > z) for the standard normal; NULL for NULL or NaN."""
    z = z.cast("double")
    a = F.least(F.abs(z), F.lit(1e3))  # the tail is 0 in doubles from 39 on
    tail = _integral(lambda w: F.exp(-w * w / 2.0), a, FALL / F.greatest(a, F.lit(1.0))) / math.sqrt(2 * math.pi)
    return F.when(_usable(z), F.when(z >= 0, tail).otherwise(1.0 - tail))


def t_sf(t: Column, dof: Column) -> Column:
    """P(T > t) for Student's t with ``dof`` (possibly fractional) degrees of
    freedom; NULL where an argument is NULL or NaN, or dof is not positive."""
    t, dof = t.cast("double"), dof.cast("double")
    root = F.sqrt(dof)
    start = root * F.asinh(F.abs(t) / root)

    def curve(w: Column) -> Column:
        half = F.sinh(w / (root * 2.0))
        return F.exp(-dof * F.log1p(half * half * 2.0))

    def above(w: Column) -> Column:
        return _integral(curve, w, FALL / (root * F.tanh(F.greatest(w, F.lit(1.0)) / root)))

    tail = F.when(F.abs(t) == float("inf"), 0.0).otherwise(above(start) / (above(F.lit(0.0)) * 2.0))
    return F.when(_usable(t, dof) & (dof > 0), F.when(t >= 0, tail).otherwise(1.0 - tail))


#: Halvings of the bracket of a quantile, and the steps of the integral over it.
HALVINGS, BRACKET_STEPS = 48, 400


def t_quantile(p: float, dof: Column) -> Column:
    """The value that Student's t with ``dof`` degrees of freedom stays below with
    probability ``p``, by bisection; NULL where dof is NULL, NaN or not positive.

    The whole half curve is integrated once; the part from 0 to the middle of the
    bracket, at the variable w of this module, is compared with its share."""
    if not 0.0 < p < 1.0:
        raise ValueError("a probability between 0 and 1")
    share = abs(2.0 * p - 1.0)
    usable = _usable(dof.cast("double")) & (dof > 0)
    # Other degrees are not integrated: their roots would be NaN.
    dof = F.when(usable, dof.cast("double")).otherwise(1.0)
    root = F.sqrt(dof)

    def curve(w: Column) -> Column:
        half = F.sinh(w / (root * 2.0))
        return F.exp(-dof * F.log1p(half * half * 2.0))

    width = FALL / (root * F.tanh(F.lit(1.0) / root))
    whole = F.transform(F.array(_integral(curve, F.lit(0.0), width)), lambda x: x * share)

    def solved(goal: Column) -> Column:
        def halve(bracket: Column, _: Column) -> Column:
            middle = (bracket["low"] + bracket["high"]) / 2.0
            small = _integral(curve, F.lit(0.0), middle, BRACKET_STEPS) < goal
            return F.struct(F.when(small, middle).otherwise(bracket["low"]).alias("low"), F.when(small, bracket["high"]).otherwise(middle).alias("high"))

        bracket = F.struct(F.lit(0.0).alias("low"), width.alias("high"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), bracket, halve, lambda b: (b["low"] + b["high"]) / 2.0)

    w = F.transform(whole, solved)[0]
    return F.when(usable, root * F.sinh(w / root) * (1.0 if p >= 0.5 else -1.0))


def two_sided(tail: Column) -> Column:
    """The two-sided p-value from an upper tail; NULL stays NULL (``least`` alone
    would turn it into 1)."""
    return F.when(tail.isNotNull(), F.least(F.lit(1.0), 2.0 * tail))


def t_two_sided_p(t: Column, dof: Column) -> Column:
    return two_sided(t_sf(F.abs(t.cast("double")), dof))


def _sql_simpson(f: str, steps: int) -> str:
    """Simpson's rule over the variable simpson_y in [0, 1), ``f`` being 0 at 1."""
    return f"""(SELECT sum((CASE WHEN simpson_i = 0 THEN 1 WHEN simpson_i % 2 = 1 THEN 4 ELSE 2 END) * simpson_f) / {3 * steps}
  FROM (SELECT simpson_i, {f} AS simpson_f
        FROM (SELECT range AS simpson_i, range / {steps}.0 AS simpson_y FROM range(0, {steps})) simpson_g) simpson_q)"""


def sql_t_two_sided(t: str, dof: str, steps: int = 20000) -> str:
    """Independent DuckDB form of ``t_two_sided_p``: the density with its gamma
    constant, integrated over x = |t| + y / (1 - y)."""
    x = f"(abs({t}) + simpson_y / (1 - simpson_y))"
    constant = f"lgamma(({dof} + 1) / 2) - lgamma({dof} / 2) - ln({dof} * pi()) / 2"
    density = f"exp({constant} - ({dof} + 1) / 2 * ln(1 + {x} * {x} / {dof})) / ((1 - simpson_y) * (1 - simpson_y))"
    return f"CASE WHEN {t} IS NOT NULL AND {dof} > 0 THEN least(1.0, 2 * {_sql_simpson(density, steps)}) END"


def sql_t_quantiles(dofs: str, p: float) -> str:
    """Independent DuckDB form of ``t_quantile`` for whole degrees of freedom: CTEs
    that end in ``tq`` (dof, q) for the distinct positive ``dof`` of the table named by
    ``dofs``, by bisection on the angle of the finite trigonometric series."""
    even = "exp(lgamma(j + 0.5) - lgamma(0.5) - lgamma(j + 1)) * pow(cos(m), 2 * j)"
    odd = "exp(lgamma(j + 1) + lgamma(1.5) - lgamma(j + 1.5)) * pow(cos(m), 2 * j + 1)"
    total = lambda term, n: f"coalesce(list_sum(list_transform(range(0, ({n})::BIGINT), lambda j: {term})), 0)"
    inside = f"CASE WHEN dof % 2 = 0 THEN sin(m) * {total(even, 'dof // 2')} ELSE 2 / pi() * (m + sin(m) * {total(odd, '(dof - 1) // 2')}) END"
    return f"""
, tb AS (
  SELECT dof, 0.0::DOUBLE AS low, pi() / 2 AS high, 0 AS i FROM (SELECT DISTINCT dof FROM {dofs} WHERE dof > 0) d
  UNION ALL
  SELECT dof, CASE WHEN inside < {2 * p - 1} THEN m ELSE low END, CASE WHEN inside < {2 * p - 1} THEN high ELSE m END, i + 1
  FROM (SELECT *, {inside} AS inside FROM (SELECT *, (low + high) / 2 AS m FROM tb WHERE i < 60) h) g)
, tq AS (SELECT dof, sqrt(dof) * tan((low + high) / 2) AS q FROM tb WHERE i = 60)
"""


def sql_norm_sf(z: str, steps: int = 20000) -> str:
    """Independent DuckDB form of ``norm_sf``, integrated over x = |z| + y / (1 - y)."""
    x = f"(abs({z}) + simpson_y / (1 - simpson_y))"
    density = f"exp(-{x} * {x} / 2) / sqrt(2 * pi()) / ((1 - simpson_y) * (1 - simpson_y))"
    tail = _sql_simpson(density, steps)
    return f"CASE WHEN {z} IS NULL THEN NULL WHEN {z} >= 0 THEN {tail} ELSE 1 - {tail} END"
