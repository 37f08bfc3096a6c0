"""Daily-metric forecasting with rolling backtests.

Framing, scaling, model fits, folds, scores and model choice are Spark SQL; every
operator carries a ``series_id`` so one run covers many series.  A fit is one row
per (series, fold): covariances of its training days, and the days themselves as
one sorted array (a series' days are a calendar-sized list).

* ``linear``      least-squares trend
* ``linear_reg``  trend plus regressors with non-negative coefficients
* ``damped``      damped local trend (Holt), smoothing and damping grid-fitted
* ``damped_reg``  non-negative regressors, damped local trend on the rest

Intervals: Student-t limits around the prediction, with the variance of a new day in
closed form.  Of the least-squares fits it is the residual variance times one plus
the leverage of the day; of the local trends the one-step variance times one plus
the squared weights that the errors of the steps before have in it.  So intervals
widen with the horizon, and with regressors far from those of the training days.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.columns import as_date, safe_ratio, to_day
from feedlens.functions.tails import t_quantile
from feedlens.operators.engagement import is_view
from feedlens.session import materialize

MODELS = ["linear", "damped", "linear_reg", "damped_reg"]
REGRESSORS = ["dau_std", "anomaly"]


# ----------------------------------------------------------------- framing
def daily_series(feed: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(series_id, day, views, dau); one series, or one per value of ``by``."""
    sid = F.lit("all") if not by else F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in by])
    return (
        feed.select(sid.alias("series_id"), to_day("time").alias("day"), "user_id", "action")
        .groupBy("series_id", "day")
        .agg(F.count_if(is_view()).alias("views"), F.count_distinct("user_id").alias("dau"))
    )


def flag_period(series: DataFrame, start, end, name: str = "anomaly") -> DataFrame:
    """1 inside the closed period, else 0."""
    return series.withColumn(name, F.col("day").between(as_date(start), as_date(end)).cast("int"))


def split(series: DataFrame, as_of, holdout_days: int = 14) -> DataFrame:
    """``part`` = 'test' for the last ``holdout_days`` days up to ``as_of``, else 'train'."""
    cutoff = F.date_sub(as_date(as_of), holdout_days)
    return series.withColumn("part", F.when(F.col("day") >= cutoff, "test").otherwise("train"))


def zscore(series: DataFrame, cols=("views", "dau")) -> DataFrame:
    """standardise ``cols`` with the mean and sample deviation of each series'
    training rows; adds ``<c>_mean``, ``<c>_sd`` and ``<c>_std``."""
    stats = (
        series.filter(F.col("part") == "train")
        .groupBy("series_id")
        .agg(*[x for c in cols for x in (F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_sd"))])
    )
    out = series.join(stats, "series_id", "left")
    for c in cols:
        out = out.withColumn(f"{c}_std", F.try_divide(F.col(c) - F.col(f"{c}_mean"), F.col(f"{c}_sd")))
    return out


def future_frame(train: DataFrame, horizon: int = 30) -> DataFrame:
    """the ``horizon`` days after each series' last training day, anomaly = 0."""
    last = train.groupBy("series_id").agg(F.max("day").alias("last_day"))
    return last.select(
        "series_id",
        F.explode(F.sequence(F.date_add("last_day", 1), F.date_add("last_day", horizon))).alias("day"),
        F.lit(0).alias("anomaly"),
    )


def linear_trend(train: DataFrame, future: DataFrame, y: str, model: str = "linear") -> DataFrame:
    """F6 (linear, in Spark SQL): least-squares y = a + b * t per series,
    t = days since the series' first training day; predictions on ``future``."""
    fit = train.groupBy("series_id").agg(F.min("day").alias("t0"))
    pts = train.join(fit, "series_id").select(
        "series_id", F.datediff("day", "t0").cast("double").alias("t"), F.col(y).cast("double").alias("y")
    )
    coef = pts.groupBy("series_id").agg(
        F.regr_slope("y", "t").alias("slope"), F.regr_intercept("y", "t").alias("intercept")
    )
    coef = coef.join(fit, "series_id")
    return future.join(coef, "series_id").select(
        "series_id",
        "day",
        F.lit(model).alias("model"),
        (F.col("intercept") + F.col("slope") * F.datediff("day", "t0")).alias("prediction"),
    )


# ------------------------------------------------------------- model fits
# The grid of smoothing (level, trend) and damping parameters.
GRID = [
    (a / 100, b / 100, phi)
    for a in range(5, 100, 10)
    for b in range(5, 51, 9)
    for phi in (0.8, 0.85, 0.9, 0.95, 0.98)
]
#: Share of a regressor's variance that the trend must leave for it to be used.
INDEPENDENT = 1e-9


def _t(day: str = "day") -> Column:
    return F.datediff(F.col(day), F.lit("2000-01-01").cast("date")).cast("double")


def _nonnegative(fit: DataFrame) -> DataFrame:
    """Coefficients ``b1`` and ``b2`` >= 0 of the two regressors beside the trend:
    the least-squares solutions of the four sets of regressors in closed form, on
    what the trend leaves of each variable; the feasible one of least squared
    error is taken."""
    pairs = {"11": "11", "22": "22", "12": "12", "1y": "1y", "2y": "2y", "yy": "yy"}
    fit = fit.withColumns(
        {f"r{p}": F.col(f"c{p}") - F.try_divide(F.col(f"ct{p[0]}") * F.col(f"ct{p[1]}"), F.col("ctt")) for p in pairs}
    )
    r11, r22, r12, r1y, r2y, ryy = (F.col(f"r{p}") for p in pairs)
    det = r11 * r22 - r12 * r12
    one, two = r11 > F.col("c11") * INDEPENDENT, r22 > F.col("c22") * INDEPENDENT
    both1, both2 = F.try_divide(r22 * r1y - r12 * r2y, det), F.try_divide(r11 * r2y - r12 * r1y, det)
    zero = F.lit(0.0)

    def choice(k: int, b1: Column, b2: Column, usable: Column) -> Column:
        sse = ryy - b1 * r1y - b2 * r2y
        return F.when(usable & (b1 >= 0) & (b2 >= 0), F.struct(sse.alias("sse"), F.lit(k).alias("k"), b1.alias("b1"), b2.alias("b2")))

    choices = F.array(
        choice(0, zero, zero, F.lit(True)),
        choice(1, F.try_divide(r1y, r11), zero, one),
        choice(2, zero, F.try_divide(r2y, r22), two),
        choice(3, both1, both2, one & two & (det > r11 * r22 * INDEPENDENT)),
    )
    fit = fit.withColumn("best", F.array_min(F.filter(choices, lambda x: x.isNotNull())))
    return fit.withColumns({"b1": F.col("best.b1"), "b2": F.col("best.b2")})


#: Points of the grid that one row walks; the rows are dealt over tasks.
GRID_BLOCK = 30
#: Probability inside an interval.
INSIDE = 0.9


def _walk(values: Column, g: Column) -> Column:
    """Damped local trend of an array with the parameters ``g``: level and trend after
    its last value, and the squared one-step errors."""
    first = F.get(values, 0)
    start = {"level": first, "trend": F.coalesce(F.get(values, 1) - first, F.lit(0.0)), "sse": F.lit(0.0)}

    def step(s: Column, y: Column) -> Column:
        ahead = s["level"] + g["phi"] * s["trend"]
        level = g["a"] * y + (1.0 - g["a"]) * ahead
        out = {
            "level": level,
            "trend": g["b"] * (level - s["level"]) + (1.0 - g["b"]) * g["phi"] * s["trend"],
            "sse": s["sse"] + (y - ahead) * (y - ahead),
        }
        return F.struct(*[v.alias(k) for k, v in out.items()])

    rest = F.slice(values, F.lit(2), F.greatest(F.size(values) - 1, F.lit(0)))
    return F.aggregate(rest, F.struct(*[v.alias(k) for k, v in start.items()]), step)


def _damped_fits(series: DataFrame, keys: list[str]) -> DataFrame:
    """The grid point of least squared errors for each row of ``series`` (keys and
    ``values``): ``fit`` (sse, k, level, trend, a, b, phi).  Blocks of the grid are
    walked in different tasks, so one long series keeps more than one core busy."""
    grid = F.from_json(
        F.lit(json.dumps([{"k": k, "a": a, "b": b, "phi": phi} for k, (a, b, phi) in enumerate(GRID)])),
        "array<struct<k:int,a:double,b:double,phi:double>>",
    )
    tasks = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = series.select(*keys, "values", F.explode(F.sequence(F.lit(0), F.lit((len(GRID) - 1) // GRID_BLOCK))).alias("block"))
    points = blocks.repartition(tasks, *keys, "block").select(*keys, "values", F.explode(F.slice(grid, F.col("block") * GRID_BLOCK + 1, GRID_BLOCK)).alias("g"))
    walked = points.select(*keys, "g", _walk(F.col("values"), F.col("g")).alias("end"))
    fit = F.struct("end.sse", "g.k", "end.level", "end.trend", "g.a", "g.b", "g.phi")
    return walked.groupBy(*keys).agg(F.min(fit).alias("fit"))


def _carried(h: Column, a: Column, b: Column, phi: Column) -> Column:
    """What errors of the h - 1 steps before add to the variance h steps ahead, in
    units of the one-step variance: the j-th step before weighs
    a + a * b * (phi + ... + phi^j), and the squares are summed in closed form."""
    slope = a * b * phi / (1.0 - phi)
    all_ = a + slope
    n = h - 1.0
    return (
        n * all_ * all_
        - 2.0 * all_ * slope * phi * (1.0 - F.pow(phi, n)) / (1.0 - phi)
        + slope * slope * phi * phi * (1.0 - F.pow(phi, 2.0 * n)) / (1.0 - phi * phi)
    )


def fit_models(rows: DataFrame, models=MODELS, inside: float = INSIDE) -> DataFrame:
    """Fit each model on the 'train' rows of every (series_id, fold) group and
    predict its other rows.  ``rows``: series_id, fold, role, day, y, dau_std, anomaly.
    ``lo`` and ``hi`` hold a new value with the probability ``inside``.

    Training rows without ``y`` are left out; a missing regressor counts as 0.  A
    trend needs two training days, else its predictions are NULL.  Intervals are
    NULL without a degree of freedom: training days less two (level and slope, or the
    local trend's begin) and less the regressors in use."""
    keys = ["series_id", "fold"]
    x1, x2 = (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in REGRESSORS)
    rows = rows.select(*keys, "role", "day", F.col("y").cast("double").alias("y"), x1.alias("x1"), x2.alias("x2"), _t().alias("t"))
    named = {"t": "t", "1": "x1", "2": "x2", "y": "y"}
    train = rows.filter((F.col("role") == "train") & F.col("y").isNotNull())
    fit = train.groupBy(*keys).agg(
        F.max("day").alias("last"),
        F.count("*").alias("n"),
        *[F.avg(c).alias(f"m{k}") for k, c in named.items()],
        *[F.covar_samp(named[p[0]], named[p[1]]).alias(f"c{p}") for p in ("tt", "t1", "t2", "ty", "11", "22", "12", "1y", "2y", "yy")],
        F.sort_array(F.collect_list(F.struct("day", "y", "x1", "x2"))).alias("points"),
    )
    fit = _nonnegative(fit)
    none = (F.lit(0.0), F.lit(0.0), F.lit(0), F.col("ryy"))
    best = (F.col("b1"), F.col("b2"), F.col("best.k"), F.col("best.sse"))
    used = [
        F.struct(F.lit(m).alias("model"), *[c.alias(n) for n, c in zip(("w1", "w2", "active", "unexplained"), best if m.endswith("_reg") else none)])
        for m in models
    ]
    fitted = fit.select("*", F.inline(F.array(*used))).withColumn("dof", F.col("n") - 2 - F.size(F.filter(F.array(F.col("active") % 2, F.col("active").bitwiseAND(2)), lambda x: x > 0)))
    local = fitted.filter(F.startswith("model", F.lit("damped")))
    local = local.select(*keys, "model", F.transform("points", lambda p: p["y"] - F.col("w1") * p["x1"] - F.col("w2") * p["x2"]).alias("values"))
    fitted = fitted.drop("points").join(_damped_fits(local, [*keys, "model"]), [*keys, "model"], "left")
    # A few distinct numbers of days, so few quantiles.
    limits = fitted.select("dof").distinct().withColumn("limit", t_quantile((1.0 + inside) / 2.0, F.col("dof")))
    fitted = fitted.join(limits, "dof", "left")

    ahead = rows.filter(F.col("role") != "train").select("*", F.explode(F.array(*[F.lit(m) for m in models])).alias("model"))
    ahead = ahead.join(fitted, [*keys, "model"], "left")
    h = F.greatest(F.datediff("day", "last"), F.lit(1)).cast("double")
    dt, d1, d2 = F.col("t") - F.col("mt"), F.col("x1") - F.col("m1"), F.col("x2") - F.col("m2")
    # What the trend leaves of the day's regressors.
    e1, e2 = d1 - F.try_divide(F.col("ct1"), F.col("ctt")) * dt, d2 - F.try_divide(F.col("ct2"), F.col("ctt")) * dt
    r11, r22, r12 = F.col("r11"), F.col("r22"), F.col("r12")
    far = (
        F.when(F.col("active") == 1, F.try_divide(e1 * e1, r11))
        .when(F.col("active") == 2, F.try_divide(e2 * e2, r22))
        .when(F.col("active") == 3, F.try_divide(r22 * e1 * e1 - 2.0 * r12 * e1 * e2 + r11 * e2 * e2, r11 * r22 - r12 * r12))
        .otherwise(0.0)
    )
    others = F.col("n") - 1.0
    slope = F.try_divide(F.col("cty") - F.col("w1") * F.col("ct1") - F.col("w2") * F.col("ct2"), F.col("ctt"))
    line = F.col("my") + slope * dt + F.col("w1") * d1 + F.col("w2") * d2
    line_spread = F.try_divide(F.greatest(F.col("unexplained"), F.lit(0.0)) * others, F.col("dof")) * (
        1.0 + 1.0 / F.col("n") + F.try_divide(dt * dt / F.col("ctt") + far, others)
    )
    level, trend, phi = (F.col(f"fit.{c}") for c in ("level", "trend", "phi"))
    curve = level + trend * phi * (1.0 - F.pow(phi, h)) / (1.0 - phi) + F.col("w1") * F.col("x1") + F.col("w2") * F.col("x2")
    curve_spread = F.try_divide(F.col("fit.sse"), F.col("dof")) * (1.0 + _carried(h, F.col("fit.a"), F.col("fit.b"), phi) + F.coalesce(F.try_divide(far, others), F.lit(0.0)))
    local = F.startswith("model", F.lit("damped"))
    out = ahead.select(*keys, "model", "day", F.col("y").alias("actual"), "limit", F.when(local, curve).otherwise(line).alias("prediction"), F.sqrt(F.when(local, curve_spread).otherwise(line_spread)).alias("spread"))
    return out.select(
        "series_id", "fold", "model", "day", "actual", "prediction",
        (F.col("prediction") - F.col("limit") * F.col("spread")).alias("lo"), (F.col("prediction") + F.col("limit") * F.col("spread")).alias("hi"),
    )


# --------------------------------------------------------------- forecasts
def prepare(feed: DataFrame, as_of, anomaly: tuple, holdout_days: int = 14, by=None) -> DataFrame:
    """F1-F4 in one frame: series, anomaly flag, train/test split, z-scores.
    Runs one job (the feed scan) and checkpoints the small daily series."""
    s = flag_period(daily_series(feed, by), anomaly[0], anomaly[1])
    # One row per series and day, read by every later step: checkpoint it so
    # the feed is scanned once.  The z-scores are then computed on it.
    return zscore(materialize(split(s, as_of, holdout_days)))


def forecast(prepared: DataFrame, horizon: int = 30, models=MODELS, y: str = "views_std") -> DataFrame:
    """F5-F8 + F13: forecasts of ``y`` for ``horizon`` days after training, with
    intervals.  The DAU regressor of the future is itself forecast first
    (linear trend of ``dau_std``) and joined on day; it is kept as ``dau_std``."""
    train = prepared.filter(F.col("part") == "train")
    future = future_frame(train, horizon)
    dau_future = linear_trend(train, future, "dau_std", "dau").select("series_id", "day", F.col("prediction").alias("dau_std"))
    fut = future.join(dau_future, ["series_id", "day"], "left")
    rows = train.select(
        "series_id", F.lit(0).alias("fold"), F.lit("train").alias("role"), "day", F.col(y).alias("y"), *REGRESSORS
    ).unionByName(
        fut.select(
            "series_id", F.lit(0).alias("fold"), F.lit("future").alias("role"), "day", F.lit(None).cast("double").alias("y"), *REGRESSORS
        )
    )
    # The DAU forecast rides along, for its own comparison in users.
    return fit_models(rows, models).drop("fold", "actual").join(dau_future, ["series_id", "day"], "left")


def compare(prepared: DataFrame, forecasts: DataFrame) -> DataFrame:
    """test-period actuals beside each model's forecast in original units
    (joined on day, never by position), views in views and DAU in users; error =
    forecast - actual."""
    test = prepared.filter(F.col("part") == "test").drop("dau_std")
    joined = test.join(forecasts, ["series_id", "day"])
    views_pred = F.col("prediction") * F.col("views_sd") + F.col("views_mean")
    dau_pred = F.col("dau_std") * F.col("dau_sd") + F.col("dau_mean")
    return joined.select(
        "series_id",
        "day",
        "model",
        "views",
        views_pred.alias("views_pred"),
        (views_pred - F.col("views")).alias("error"),
        (F.col("lo") * F.col("views_sd") + F.col("views_mean")).alias("views_lo"),
        (F.col("hi") * F.col("views_sd") + F.col("views_mean")).alias("views_hi"),
        "dau",
        dau_pred.alias("dau_pred"),
        (dau_pred - F.col("dau")).alias("dau_error"),
    )


# --------------------------------------------------------------- backtest
def folds(prepared: DataFrame, train_len: int = 7, step: int = 7, horizon: int = 7, y: str = "views_std") -> DataFrame:
    """F9 fold table: rolling windows over each series' training rows.  Fold i
    trains on rows [i*step, i*step+train_len) and tests on the next ``horizon``
    rows.  Each row is expanded only to the folds that contain it."""
    train = prepared.filter(F.col("part") == "train")
    by_series = Window.partitionBy("series_id")
    r = F.row_number().over(by_series.orderBy("day")) - 1
    n = F.count("*").over(by_series)
    idx = train.select("series_id", "day", F.col(y).alias("y"), *REGRESSORS, r.alias("r"), n.alias("n"))
    n_folds = F.floor((F.col("n") - train_len - horizon) / step) + 1
    first = F.greatest(F.lit(0), F.ceil((F.col("r") - train_len - horizon + 1) / step))
    last = F.least(n_folds - 1, F.floor(F.col("r") / step))
    expanded = idx.filter(n_folds >= 1).filter(first <= last).select(
        "*", F.explode(F.sequence(first.cast("int"), last.cast("int"))).alias("fold")
    )
    pos = F.col("r") - F.col("fold") * step
    return expanded.filter(pos < train_len + horizon).select(
        "series_id",
        "fold",
        F.when(pos < train_len, "train").otherwise("test").alias("role"),
        "day",
        "y",
        *REGRESSORS,
    )


def backtest(prepared: DataFrame, models=MODELS, train_len: int = 7, step: int = 7, horizon: int = 7) -> DataFrame:
    """one fit per (series, model, fold); predictions of the test rows."""
    return fit_models(folds(prepared, train_len, step, horizon), models)


def linear_backtest(fold_rows: DataFrame) -> DataFrame:
    """F9 for the linear trend entirely in Spark SQL: one least-squares fit per
    (series, fold) by ``regr_slope`` / ``regr_intercept``, predictions of the
    fold's test rows (no Python; same output frame as ``backtest``)."""
    train = fold_rows.filter(F.col("role") == "train")
    t0 = train.groupBy("series_id", "fold").agg(F.min("day").alias("t0"))
    pts = train.join(t0, ["series_id", "fold"]).select(
        "series_id", "fold", F.datediff("day", "t0").cast("double").alias("t"), F.col("y").cast("double").alias("y")
    )
    coef = pts.groupBy("series_id", "fold").agg(
        F.regr_slope("y", "t").alias("slope"), F.regr_intercept("y", "t").alias("intercept")
    ).join(t0, ["series_id", "fold"])
    test = fold_rows.filter(F.col("role") == "test").join(coef, ["series_id", "fold"])
    return test.select(
        "series_id",
        "fold",
        F.lit("linear").alias("model"),
        "day",
        F.col("y").alias("actual"),
        (F.col("intercept") + F.col("slope") * F.datediff("day", "t0")).alias("prediction"),
        F.lit(None).cast("double").alias("lo"),
        F.lit(None).cast("double").alias("hi"),
    )


def score(bt: DataFrame, fold_rows: DataFrame) -> DataFrame:
    """sMAPE, wMAPE, MAPE, MSE, MAE and RMSSE per (series, model), pooled
    over folds.  RMSSE scales each squared error by the mean squared one-step
    change of its fold's training actuals.  Points where a ratio is undefined
    (zero denominators) are skipped: ``n_points`` counts all points, ``n_used``
    those that entered the metric."""
    w = Window.partitionBy("series_id", "fold").orderBy("day")
    naive = (
        fold_rows.filter(F.col("role") == "train")
        .withColumn("d", F.col("y") - F.lag("y").over(w))
        .groupBy("series_id", "fold")
        .agg(F.avg(F.col("d") * F.col("d")).alias("naive_mse"))
    )
    e = F.col("prediction") - F.col("actual")
    x = bt.join(naive, ["series_id", "fold"], "left")
    terms = {
        "smape": F.try_divide(2.0 * F.abs(e), F.abs("actual") + F.abs("prediction")),
        "mape": F.try_divide(F.abs(e), F.abs("actual")),
        "mse": e * e,
        "mae": F.abs(e),
        "rmsse": F.try_divide(e * e, F.col("naive_mse")),
    }
    agg = x.groupBy("series_id", "model").agg(
        F.count("*").alias("n_points"),
        F.avg(terms["smape"]).alias("smape"),
        safe_ratio(F.sum(F.abs(e)), F.sum(F.abs("actual"))).alias("wmape"),
        F.avg(terms["mape"]).alias("mape"),
        F.avg(terms["mse"]).alias("mse"),
        F.avg(terms["mae"]).alias("mae"),
        F.sqrt(F.avg(terms["rmsse"])).alias("rmsse"),
        *[F.count(t).alias(f"used_{m}") for m, t in terms.items()],
        F.count(e).alias("used_wmape"),
    )
    metrics = ["smape", "wmape", "mape", "mse", "mae", "rmsse"]
    long = agg.select(
        "series_id",
        "model",
        "n_points",
        F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"), F.col(f"used_{m}").alias("n_used")) for m in metrics])),
    )
    return long


def best_model(scores: DataFrame) -> DataFrame:
    """per series and metric the model with the least value (ties: model name)."""
    return (
        scores.filter(F.col("value").isNotNull())
        .groupBy("series_id", "metric")
        .agg(F.min_by(F.struct("model", "value"), F.struct("value", "model")).alias("best"))
        .select("series_id", "metric", F.col("best.model").alias("best_model"), F.col("best.value").alias("value"))
    )
