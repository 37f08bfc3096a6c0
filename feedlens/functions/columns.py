"""Column-expression helpers.  All JVM-side; no Python runs per row."""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
# Age bands of the daily ETL: left-closed [0,18,25,35,45,61,inf); negative -> NULL.
ETL_AGE_EDGES = [0, 18, 25, 35, 45, 61]
ETL_AGE_LABELS = ["<18", "18-24", "25-34", "35-44", "45-60", "старше 60"]
# Age bands of the service report: <18, then left-closed up to 65+.
BOT_AGE_EDGES = [18, 25, 35, 45, 65]
BOT_AGE_LABELS = ["<18", "18-24", "25-34", "35-44", "45-64", "65+"]
# -----------------------------------------------------------------------------


def as_date(value) -> Column:
    """A literal date from a ``datetime.date`` / ISO string, or a Column as is."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = _dt.date.fromisoformat(value)
    return F.lit(value)


def to_day(ts: str | Column = "time") -> Column:
    return F.to_date(F.col(ts) if isinstance(ts, str) else ts)


def week_start(day: str | Column) -> Column:
    """Monday of the week of ``day`` as DATE."""
    c = F.col(day) if isinstance(day, str) else day
    return F.date_trunc("week", c).cast("date")


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as DOUBLE; NULL when den is 0 (never raises under ANSI)."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return F.try_divide(n.cast("double"), d.cast("double"))


def floor_to_hundredth(x: str | Column) -> Column:
    c = F.col(x) if isinstance(x, str) else x
    return F.floor(c * 100).cast("double") / 100.0


def age_band_etl(age: str | Column = "age") -> Column:
    a = F.col(age) if isinstance(age, str) else age
    expr = None
    for lo, label, hi in zip(ETL_AGE_EDGES, ETL_AGE_LABELS, ETL_AGE_EDGES[1:] + [None]):
        cond = (a >= lo) if hi is None else ((a >= lo) & (a < hi))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr  # falls through to NULL for negative or NULL age


def age_band_bot(age: str | Column = "age") -> Column:
    a = F.col(age) if isinstance(age, str) else age
    expr = F.when(a < BOT_AGE_EDGES[0], BOT_AGE_LABELS[0])
    for hi, label in zip(BOT_AGE_EDGES[1:], BOT_AGE_LABELS[1:-1]):
        expr = expr.when(a < hi, label)
    return expr.when(a.isNotNull(), BOT_AGE_LABELS[-1])


def md5_bucket(key: str | Column, n: int) -> Column:
    """Portable bucket: first 8 hex digits of md5(string(key)) mod n (same in DuckDB)."""
    k = F.col(key) if isinstance(key, str) else key
    h = F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(n)).cast("int")


def xxhash_bucket(key: str | Column, n: int) -> Column:
    """Fast bucket: pmod(xxhash64(key), n); Spark-only membership."""
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(k), F.lit(n)).cast("int")


_TWO52 = float(2**52)


def hashed_uniform(*keys: Column, seed: int = 0, method: str = "xxhash64") -> Column:
    """A deterministic uniform in [0, 1) from ids and a seed, 52 random bits.

    ``method="md5"`` uses the first 13 hex digits of md5 of the dash-joined keys
    (reproducible in DuckDB); ``"xxhash64"`` is faster and Spark-only.
    """
    if method == "md5":
        text = F.concat_ws("-", F.lit(str(seed)), *[k.cast("string") for k in keys])
        bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")
    elif method == "xxhash64":
        bits = F.xxhash64(F.lit(seed).cast("bigint"), *keys).bitwiseAND(F.lit((1 << 52) - 1))
    else:
        raise ValueError(f"unknown method {method}")
    return bits.cast("double") / _TWO52


def log_factorial(n: Column) -> Column:
    """ln(n!) by Stirling's series after eight steps of the factorial's own rule."""
    n = n.cast("double")
    m = n + 9.0
    rest = m * F.log(m) - m - 0.5 * F.log(m) + 0.5 * math.log(2 * math.pi) + 1 / (12 * m) - 1 / (360 * m**3) + 1 / (1260 * m**5) - 1 / (1680 * m**7)
    steps = n + 1.0
    for k in range(2, 9):
        steps = steps * (n + float(k))
    return rest - F.log(steps)


def poisson_support(mean: Column) -> tuple[Column, Column]:
    """Counts outside which a Poisson variable falls with a probability that is
    nil in doubles (12 standard deviations and then some)."""
    spread = 12.0 * F.sqrt(mean)
    return F.greatest(F.lit(0), F.floor(mean - spread - 20.0)).cast("bigint"), F.ceil(mean + spread + 40.0).cast("bigint")
