"""Registered forecasting queries (F1-F13) with DuckDB oracles.  The oracles of
the model fits walk the damped trends with a recursive query and choose the
non-negative regressors by a ranked list of candidates."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlens.functions.tails import sql_t_quantiles
from feedlens.operators import forecast as FC
from feedlens.plans.params import ANOMALY_END, ANOMALY_START, AS_OF, HOLDOUT_DAYS, HORIZON_DAYS
from feedlens.plans.registry import register
from feedlens.sources.fixtures import feed_actions, with_fixtures

ROUND = 10


def _prepared(spark, sf_dir, by=None):
    return FC.prepare(feed_actions(spark, sf_dir), AS_OF, (ANOMALY_START, ANOMALY_END), HOLDOUT_DAYS, by)


def _series_sql(sid: str = "'all'") -> str:
    return f"""
  SELECT series_id, day, views, dau,
         CAST(CASE WHEN day BETWEEN DATE '{ANOMALY_START}' AND DATE '{ANOMALY_END}' THEN 1 ELSE 0 END AS INTEGER) AS anomaly
  FROM (SELECT {sid} AS series_id, CAST(time AS DATE) AS day,
               count(*) FILTER (WHERE action = 'view') AS views, count(DISTINCT user_id) AS dau
        FROM feed_actions GROUP BY 1, 2) s
"""


@register("daily_series", with_fixtures(_series_sql()))
def q_daily_series(spark, sf_dir):
    s = FC.daily_series(feed_actions(spark, sf_dir))
    return FC.flag_period(s, ANOMALY_START, ANOMALY_END)


@register("daily_series_by_os", with_fixtures(_series_sql("coalesce(CAST(os AS VARCHAR), 'NULL')")))
def q_daily_series_by_os(spark, sf_dir):
    s = FC.daily_series(feed_actions(spark, sf_dir), ["os"])
    return FC.flag_period(s, ANOMALY_START, ANOMALY_END)


_PREPARED_SQL = f"""
WITH s AS ({_series_sql()}),
p AS (SELECT *, CASE WHEN day >= DATE '{AS_OF}' - {HOLDOUT_DAYS} THEN 'test' ELSE 'train' END AS part FROM s),
st AS (SELECT series_id, avg(views) AS views_mean, stddev_samp(views) AS views_sd,
              avg(dau) AS dau_mean, stddev_samp(dau) AS dau_sd
       FROM p WHERE part = 'train' GROUP BY 1),
z AS (SELECT p.*, st.views_mean, st.views_sd, st.dau_mean, st.dau_sd,
             (p.views - st.views_mean) / NULLIF(st.views_sd, 0) AS views_std,
             (p.dau - st.dau_mean) / NULLIF(st.dau_sd, 0) AS dau_std
      FROM p LEFT JOIN st USING (series_id))
"""
_Z_ROUND = ["views_mean", "views_sd", "dau_mean", "dau_sd", "views_std", "dau_std"]


@register(
    "series_zscore",
    with_fixtures(
        _PREPARED_SQL
        + "SELECT series_id, day, views, dau, anomaly, part, "
        + ", ".join(f"round({c}, {ROUND}) AS {c}" for c in _Z_ROUND)
        + " FROM z"
    ),
)
def q_series_zscore(spark, sf_dir):
    p = _prepared(spark, sf_dir)
    return p.select(*[F.round(c, ROUND).alias(c) if c in _Z_ROUND else F.col(c) for c in p.columns])


_FUTURE_SQL = f"""
, fut AS (SELECT series_id, CAST(unnest(generate_series(max(day) + 1, max(day) + {HORIZON_DAYS}, INTERVAL 1 DAY)) AS DATE) AS day,
                 0 AS anomaly
          FROM z WHERE part = 'train' GROUP BY 1)
"""


@register("future_frame", with_fixtures(_PREPARED_SQL + _FUTURE_SQL + "SELECT * FROM fut"))
def q_future_frame(spark, sf_dir):
    return FC.future_frame(_prepared(spark, sf_dir).filter(F.col("part") == "train"), HORIZON_DAYS)


@register(
    "forecast_linear",
    with_fixtures(
        _PREPARED_SQL
        + _FUTURE_SQL
        + f""", tr AS (SELECT z.series_id, CAST(z.day - t.t0 AS DOUBLE) AS t, views_std AS y
                FROM z JOIN (SELECT series_id, min(day) AS t0 FROM z WHERE part = 'train' GROUP BY 1) t USING (series_id)
                WHERE part = 'train'),
coef AS (SELECT series_id, regr_slope(y, t) AS slope, regr_intercept(y, t) AS intercept FROM tr GROUP BY 1),
t0 AS (SELECT series_id, min(day) AS t0 FROM z WHERE part = 'train' GROUP BY 1)
SELECT f.series_id, f.day, 'linear' AS model,
       round(c.intercept + c.slope * CAST(f.day - t0.t0 AS DOUBLE), 8) AS prediction
FROM fut f JOIN coef c USING (series_id) JOIN t0 USING (series_id)"""
    ),
)
def q_forecast_linear(spark, sf_dir):
    p = _prepared(spark, sf_dir)
    train = p.filter(F.col("part") == "train")
    out = FC.linear_trend(train, FC.future_frame(train, HORIZON_DAYS), "views_std")
    return out.withColumn("prediction", F.round("prediction", 8))


_DAU_FUTURE_SQL = """
, dt AS (SELECT series_id, regr_slope(dau_std, epoch(day) / 86400) AS slope, regr_intercept(dau_std, epoch(day) / 86400) AS intercept
         FROM z WHERE part = 'train' GROUP BY 1)
, dauf AS (SELECT fut.series_id, fut.day, fut.anomaly, dt.intercept + dt.slope * (epoch(fut.day) / 86400) AS dau_std FROM fut JOIN dt USING (series_id))
, fr AS (
  SELECT series_id, 0 AS fold, 'train' AS role, day, views_std AS y, dau_std, anomaly FROM z WHERE part = 'train'
  UNION ALL SELECT series_id, 0, 'future', day, NULL, dau_std, anomaly FROM dauf)
"""
_GRID_SQL = ", ".join(f"({k}, {a!r}::DOUBLE, {b!r}::DOUBLE, {phi!r}::DOUBLE)" for k, (a, b, phi) in enumerate(FC.GRID))
_SAME = "a.series_id = b.series_id AND a.fold = b.fold"
_MODELS_SQL = f"""
, pt AS (SELECT series_id, fold, role, day, CAST(y AS DOUBLE) AS y, epoch(day) / 86400 AS t, coalesce(dau_std, 0.0) AS x1, coalesce(CAST(anomaly AS DOUBLE), 0.0) AS x2 FROM fr)
, tr AS (SELECT *, row_number() OVER (PARTITION BY series_id, fold ORDER BY day) AS i FROM pt WHERE role = 'train' AND y IS NOT NULL)
, tc AS (SELECT *, t - avg(t) OVER w AS dt, y - avg(y) OVER w AS dy, x1 - avg(x1) OVER w AS d1, x2 - avg(x2) OVER w AS d2
         FROM tr WINDOW w AS (PARTITION BY series_id, fold))
, tp AS (SELECT series_id, fold, sum(dt * dy) / nullif(sum(dt * dt), 0) AS by_, sum(dt * d1) / nullif(sum(dt * dt), 0) AS b1_,
                sum(dt * d2) / nullif(sum(dt * dt), 0) AS b2_, sum(d1 * d1) AS c11, sum(d2 * d2) AS c22 FROM tc GROUP BY 1, 2)
, rs AS (SELECT a.*, dy - by_ * dt AS ry, d1 - b1_ * dt AS r1, d2 - b2_ * dt AS r2 FROM tc a JOIN tp b ON {_SAME})
, sm AS (SELECT a.series_id, a.fold, any_value(c11) AS c11, any_value(c22) AS c22, sum(r1 * r1) AS r11, sum(r2 * r2) AS r22,
                sum(r1 * r2) AS r12, sum(r1 * ry) AS r1y, sum(r2 * ry) AS r2y, sum(ry * ry) AS ryy FROM rs a JOIN tp b ON {_SAME} GROUP BY 1, 2)
, cand AS (
  SELECT series_id, fold, 0 AS k, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2, ryy, r1y, r2y FROM sm
  UNION ALL SELECT series_id, fold, 1, r1y / r11, 0.0, ryy, r1y, r2y FROM sm WHERE r11 > c11 * {FC.INDEPENDENT}
  UNION ALL SELECT series_id, fold, 2, 0.0, r2y / r22, ryy, r1y, r2y FROM sm WHERE r22 > c22 * {FC.INDEPENDENT}
  UNION ALL SELECT series_id, fold, 3, (r22 * r1y - r12 * r2y) / (r11 * r22 - r12 * r12), (r11 * r2y - r12 * r1y) / (r11 * r22 - r12 * r12), ryy, r1y, r2y
    FROM sm WHERE r11 > c11 * {FC.INDEPENDENT} AND r22 > c22 * {FC.INDEPENDENT} AND r11 * r22 - r12 * r12 > r11 * r22 * {FC.INDEPENDENT})
, reg AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series_id, fold ORDER BY ryy - b1 * r1y - b2 * r2y, k) AS rn
                         FROM cand WHERE b1 >= 0 AND b2 >= 0) q WHERE rn = 1)
, coefs AS (
  SELECT series_id, fold, m.model, CASE WHEN m.model LIKE '%reg' THEN b1 ELSE 0 END AS b1, CASE WHEN m.model LIKE '%reg' THEN b2 ELSE 0 END AS b2
  FROM reg, (VALUES ('linear'), ('linear_reg'), ('damped'), ('damped_reg')) m(model))
, lf AS (
  SELECT b.model, a.series_id, a.fold, any_value(b.b1) AS b1, any_value(b.b2) AS b2,
         regr_slope(y - b.b1 * x1 - b.b2 * x2, t) AS slope, regr_intercept(y - b.b1 * x1 - b.b2 * x2, t) AS intercept
  FROM tr a JOIN coefs b ON {_SAME} WHERE b.model LIKE 'linear%' GROUP BY 1, 2, 3)
, le AS (SELECT b.model, a.series_id, a.fold, y - (intercept + slope * t + b1 * x1 + b2 * x2) AS e FROM tr a JOIN lf b ON {_SAME})
, ys AS (SELECT b.model, a.series_id, a.fold, a.i, a.y - b.b1 * a.x1 - b.b2 * a.x2 AS y FROM tr a JOIN coefs b ON {_SAME} WHERE b.model LIKE 'damped%')
, grid(k, a, b, phi) AS (VALUES {_GRID_SQL})
, walk AS (
  SELECT s.model, s.series_id, s.fold, g.k, g.a, g.b, g.phi, s.i, s.y AS level, coalesce(n.y - s.y, 0) AS trend, 0.0::DOUBLE AS sse, NULL::DOUBLE AS e
  FROM ys s LEFT JOIN ys n ON n.model = s.model AND n.series_id = s.series_id AND n.fold = s.fold AND n.i = 2 CROSS JOIN grid g WHERE s.i = 1
  UNION ALL
  SELECT w.model, w.series_id, w.fold, w.k, w.a, w.b, w.phi, s.i, w.a * s.y + (1 - w.a) * (w.level + w.phi * w.trend),
         w.b * (w.a * s.y + (1 - w.a) * (w.level + w.phi * w.trend) - w.level) + (1 - w.b) * w.phi * w.trend,
         w.sse + (s.y - (w.level + w.phi * w.trend)) * (s.y - (w.level + w.phi * w.trend)), s.y - (w.level + w.phi * w.trend)
  FROM walk w JOIN ys s ON s.model = w.model AND s.series_id = w.series_id AND s.fold = w.fold AND s.i = w.i + 1)
, df AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model, series_id, fold ORDER BY i DESC, sse, k) AS rn FROM walk) q WHERE rn = 1)
, ends AS (SELECT series_id, fold, max(day) AS last FROM tr GROUP BY 1, 2)
, ah AS (SELECT a.*, greatest(a.day - b.last, 1) AS h FROM pt a JOIN ends b ON {_SAME} WHERE a.role <> 'train')
, dg AS (SELECT a.series_id, a.fold, c.model, count(*) - 2 - CASE WHEN c.model NOT LIKE '%reg' THEN 0 ELSE any_value(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) END AS dof, count(*) AS n,
              avg(t) AS mt, avg(x1) AS m1, avg(x2) AS m2, CASE WHEN c.model LIKE '%reg' THEN any_value(k) ELSE 0 END AS used
       FROM tr a JOIN reg b ON {_SAME} JOIN coefs c ON c.series_id = a.series_id AND c.fold = a.fold GROUP BY 1, 2, 3)
{sql_t_quantiles("dg", 0.95)}
, days AS (SELECT series_id, fold, sum(dt * dt) AS stt FROM tc GROUP BY 1, 2)
, lv AS (  -- leverage of a day: of the trend, and of what the trend leaves of the regressors in use
  SELECT a.*, g.model, g.dof, g.n, q.q, 1.0 / g.n + (a.t - g.mt) * (a.t - g.mt) / s.stt AS trend_part,
         a.x1 - g.m1 - p.b1_ * (a.t - g.mt) AS u1, a.x2 - g.m2 - p.b2_ * (a.t - g.mt) AS u2, g.used, m.r11, m.r22, m.r12
  FROM ah a JOIN dg g ON g.series_id = a.series_id AND g.fold = a.fold JOIN days s ON s.series_id = a.series_id AND s.fold = a.fold
  JOIN tp p ON p.series_id = a.series_id AND p.fold = a.fold JOIN sm m ON m.series_id = a.series_id AND m.fold = a.fold LEFT JOIN tq q ON q.dof = g.dof)
, lw AS (SELECT *, CASE used WHEN 0 THEN 0 WHEN 1 THEN u1 * u1 / r11 WHEN 2 THEN u2 * u2 / r22
                   ELSE (u1 * (r22 * u1 - r12 * u2) + u2 * (r11 * u2 - r12 * u1)) / (r11 * r22 - r12 * r12) END AS reg_part FROM lv)
, ss AS (SELECT model, series_id, fold, sum(e * e) AS sse FROM le GROUP BY 1, 2, 3)
, pred AS (
  SELECT b.model, a.series_id, a.fold, a.day, a.y AS actual, intercept + slope * t + b1 * x1 + b2 * x2 AS prediction,
         a.q * sqrt(s.sse / nullif(a.dof, 0) * (1 + trend_part + reg_part)) AS reach
  FROM lw a JOIN lf b ON {_SAME} AND a.model = b.model JOIN ss s ON s.model = b.model AND s.series_id = b.series_id AND s.fold = b.fold
  UNION ALL
  SELECT b.model, a.series_id, a.fold, a.day, a.y, b.level + b.trend * b.phi * (1 - pow(b.phi, a.h)) / (1 - b.phi) + c.b1 * a.x1 + c.b2 * a.x2,
         a.q * sqrt(b.sse / nullif(a.dof, 0) * (1 + reg_part + coalesce(list_sum(list_transform(range(1, a.h::BIGINT),
           lambda j: pow(b.a + b.a * b.b * list_sum(list_transform(range(1, j + 1), lambda i: pow(b.phi, i))), 2))), 0)))
  FROM lw a JOIN df b ON {_SAME} AND a.model = b.model JOIN coefs c ON c.model = b.model AND c.series_id = a.series_id AND c.fold = a.fold)
, bt AS (SELECT series_id, fold, model, day, actual, prediction, prediction - reach AS lo, prediction + reach AS hi FROM pred)
"""


def _recursive(sql: str) -> str:
    return with_fixtures(sql).replace("WITH ", "WITH RECURSIVE ", 1)


_FORECAST_SQL = _FUTURE_SQL + _DAU_FUTURE_SQL + _MODELS_SQL
_FORECAST_SELECT = """SELECT bt.series_id, bt.day, model, round(prediction, 6) AS prediction, round(lo, 6) AS lo, round(hi, 6) AS hi, round(d.dau_std, 6) AS dau_std
FROM bt JOIN dauf d ON d.series_id = bt.series_id AND d.day = bt.day"""


def _rounded(df, columns, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns])


_FORECAST_ROUND = ["prediction", "lo", "hi", "dau_std"]


@register("forecast_models", _recursive(_PREPARED_SQL + _FORECAST_SQL + _FORECAST_SELECT))
def q_forecast_models(spark, sf_dir):
    return _rounded(FC.forecast(_prepared(spark, sf_dir), HORIZON_DAYS), _FORECAST_ROUND)


_PREPARED_BY_OS_SQL = _PREPARED_SQL.replace(_series_sql(), _series_sql("coalesce(CAST(os AS VARCHAR), 'NULL')"))


@register("forecast_models_by_os", _recursive(_PREPARED_BY_OS_SQL + _FORECAST_SQL + _FORECAST_SELECT))
def q_forecast_models_by_os(spark, sf_dir):
    return _rounded(FC.forecast(_prepared(spark, sf_dir, ["os"]), HORIZON_DAYS), _FORECAST_ROUND)


_COMPARE_ROUND = ["views_pred", "error", "views_lo", "views_hi", "dau_pred", "dau_error"]
_COMPARE_SELECT = """SELECT z.series_id, z.day, bt.model, z.views, round(prediction * views_sd + views_mean, 6) AS views_pred,
       round(prediction * views_sd + views_mean - z.views, 6) AS error, round(lo * views_sd + views_mean, 6) AS views_lo,
       round(hi * views_sd + views_mean, 6) AS views_hi, z.dau, round(d.dau_std * dau_sd + dau_mean, 6) AS dau_pred,
       round(d.dau_std * dau_sd + dau_mean - z.dau, 6) AS dau_error
FROM z JOIN bt ON bt.series_id = z.series_id AND bt.day = z.day JOIN dauf d ON d.series_id = z.series_id AND d.day = z.day WHERE z.part = 'test'"""


@register("forecast_compare", _recursive(_PREPARED_SQL + _FORECAST_SQL + _COMPARE_SELECT))
def q_forecast_compare(spark, sf_dir):
    p = _prepared(spark, sf_dir)
    return _rounded(FC.compare(p, FC.forecast(p, HORIZON_DAYS)), _COMPARE_ROUND)


@register(
    "forecast_dau",
    _recursive(
        _PREPARED_SQL
        + _FUTURE_SQL
        + _DAU_FUTURE_SQL
        + """SELECT z.series_id, z.day, z.dau, round(d.dau_std * dau_sd + dau_mean, 6) AS dau_pred, round(d.dau_std * dau_sd + dau_mean - z.dau, 6) AS dau_error
FROM z JOIN dauf d ON d.series_id = z.series_id AND d.day = z.day WHERE z.part = 'test'"""
    ),
)
def q_forecast_dau(spark, sf_dir):
    """The DAU forecast of the test days, in users."""
    p = _prepared(spark, sf_dir)
    out = FC.compare(p, FC.forecast(p, HORIZON_DAYS, ["linear"]))
    return _rounded(out.select("series_id", "day", "dau", "dau_pred", "dau_error"), _COMPARE_ROUND)


_FOLDS_SQL = """, idx AS (SELECT series_id, day, views_std AS y, dau_std, anomaly,
                    row_number() OVER (PARTITION BY series_id ORDER BY day) - 1 AS r,
                    count(*) OVER (PARTITION BY series_id) AS n
             FROM z WHERE part = 'train'),
nf AS (SELECT DISTINCT series_id, CAST(floor((n - 14) / 7) + 1 AS INTEGER) AS n_folds FROM idx),
f AS (SELECT series_id, CAST(unnest(range(0, greatest(n_folds, 0))) AS INTEGER) AS fold FROM nf)
SELECT idx.series_id, f.fold, CASE WHEN idx.r - f.fold * 7 < 7 THEN 'train' ELSE 'test' END AS role,
       idx.day, round(idx.y, 10) AS y, round(idx.dau_std, 10) AS dau_std, idx.anomaly
FROM idx JOIN f ON f.series_id = idx.series_id
WHERE idx.r - f.fold * 7 >= 0 AND idx.r - f.fold * 7 < 14"""


@register("backtest_folds", with_fixtures(_PREPARED_SQL + _FOLDS_SQL))
def q_backtest_folds(spark, sf_dir):
    f = FC.folds(_prepared(spark, sf_dir))
    return f.withColumn("y", F.round("y", ROUND)).withColumn("dau_std", F.round("dau_std", ROUND))


_FOLD_ROWS_SQL = (
    _FOLDS_SQL.replace("SELECT idx.series_id, f.fold", "SELECT idx.series_id AS series_id, f.fold AS fold", 1)
    .replace("round(idx.y, 10) AS y", "idx.y AS y")
    .replace("round(idx.dau_std, 10) AS dau_std", "idx.dau_std AS dau_std")
    .replace("\nSELECT idx.series_id", "\n, fr AS (SELECT idx.series_id", 1)
    + ")"
)
_BACKTEST_ROUND = ["actual", "prediction", "lo", "hi"]


@register(
    "backtest",
    _recursive(
        _PREPARED_SQL
        + _FOLD_ROWS_SQL
        + _MODELS_SQL
        + "SELECT series_id, fold, model, day, round(actual, 6) AS actual, round(prediction, 6) AS prediction, round(lo, 6) AS lo, round(hi, 6) AS hi FROM bt"
    ),
)
def q_backtest(spark, sf_dir):
    return _rounded(FC.backtest(_prepared(spark, sf_dir)), _BACKTEST_ROUND)


def _scores(spark, sf_dir):
    p = _prepared(spark, sf_dir)
    return FC.score(FC.backtest(p), FC.folds(p))


_METRICS = ["smape", "wmape", "mape", "mse", "mae", "rmsse"]
_SCORES_SQL = """, naive AS (SELECT series_id, fold, avg(d * d) AS naive_mse FROM (
              SELECT series_id, fold, y - lag(y) OVER (PARTITION BY series_id, fold ORDER BY day) AS d
              FROM fr WHERE role = 'train') x GROUP BY 1, 2)
, terms AS (SELECT bt.series_id, model, prediction - actual AS e, actual, prediction,
                   2.0 * abs(prediction - actual) / NULLIF(abs(actual) + abs(prediction), 0) AS t_smape,
                   abs(prediction - actual) / NULLIF(abs(actual), 0) AS t_mape,
                   (prediction - actual) * (prediction - actual) / NULLIF(naive_mse, 0) AS t_rmsse
            FROM bt LEFT JOIN naive USING (series_id, fold))
, agg AS (SELECT series_id, model, count(*) AS n_points,
                 avg(t_smape) AS smape, count(t_smape) AS used_smape,
                 sum(abs(e)) / NULLIF(sum(abs(actual)), 0) AS wmape, count(e) AS used_wmape,
                 avg(t_mape) AS mape, count(t_mape) AS used_mape,
                 avg(e * e) AS mse, count(e) AS used_mse,
                 avg(abs(e)) AS mae, count(e) AS used_mae,
                 sqrt(avg(t_rmsse)) AS rmsse, count(t_rmsse) AS used_rmsse
          FROM terms GROUP BY 1, 2)
, long AS (""" + "\nUNION ALL\n".join(f"SELECT series_id, model, n_points, '{m}' AS metric, {m} AS value, used_{m} AS n_used FROM agg" for m in _METRICS) + ")\n"
_ALL_SCORES_SQL = _PREPARED_SQL + _FOLD_ROWS_SQL + _MODELS_SQL + _SCORES_SQL


@register("backtest_scores", _recursive(_ALL_SCORES_SQL + "SELECT series_id, model, n_points, metric, round(value, 6) AS value, n_used FROM long"))
def q_backtest_scores(spark, sf_dir):
    return _rounded(_scores(spark, sf_dir), ["value"])


@register(
    "best_model",
    _recursive(
        _ALL_SCORES_SQL
        + """SELECT series_id, metric, model AS best_model, round(value, 6) AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id, metric ORDER BY value, model) AS rn FROM long WHERE value IS NOT NULL) q WHERE rn = 1"""
    ),
)
def q_best_model(spark, sf_dir):
    return _rounded(FC.best_model(_scores(spark, sf_dir)), ["value"])


_LINEAR_SCORES_SQL = (
    _PREPARED_SQL
    + _FOLD_ROWS_SQL
    + """
, t0 AS (SELECT series_id, fold, min(day) AS t0 FROM fr WHERE role = 'train' GROUP BY 1, 2)
, coef AS (SELECT fr.series_id, fr.fold, regr_slope(y, CAST(fr.day - t0.t0 AS DOUBLE)) AS slope,
                  regr_intercept(y, CAST(fr.day - t0.t0 AS DOUBLE)) AS intercept
           FROM fr JOIN t0 USING (series_id, fold) WHERE role = 'train' GROUP BY 1, 2)
, bt AS (SELECT fr.series_id, fr.fold, 'linear' AS model, fr.day, fr.y AS actual,
                c.intercept + c.slope * CAST(fr.day - t0.t0 AS DOUBLE) AS prediction
         FROM fr JOIN coef c USING (series_id, fold) JOIN t0 USING (series_id, fold) WHERE role = 'test')
"""
    + _SCORES_SQL
    + "SELECT series_id, model, n_points, metric, round(value, 8) AS value, n_used FROM long"
)


@register("backtest_linear_scores", with_fixtures(_LINEAR_SCORES_SQL))
def q_backtest_linear_scores(spark, sf_dir):
    p = _prepared(spark, sf_dir)
    fr = FC.folds(p)
    return FC.score(FC.linear_backtest(fr), fr).withColumn("value", F.round("value", 8))


@register(
    "forecast_compare_linear",
    with_fixtures(
        _PREPARED_SQL
        + _FUTURE_SQL
        + f""", t0 AS (SELECT series_id, min(day) AS t0 FROM z WHERE part = 'train' GROUP BY 1),
tr AS (SELECT z.series_id, CAST(z.day - t0.t0 AS DOUBLE) AS t, views_std AS y, dau_std AS d
       FROM z JOIN t0 USING (series_id) WHERE part = 'train'),
coef AS (SELECT series_id, regr_slope(y, t) AS slope, regr_intercept(y, t) AS intercept,
                regr_slope(d, t) AS dau_slope, regr_intercept(d, t) AS dau_intercept FROM tr GROUP BY 1),
pred AS (SELECT f.series_id, f.day, c.intercept + c.slope * CAST(f.day - t0.t0 AS DOUBLE) AS prediction,
                c.dau_intercept + c.dau_slope * CAST(f.day - t0.t0 AS DOUBLE) AS dau_std
         FROM fut f JOIN coef c USING (series_id) JOIN t0 USING (series_id)),
cmp AS (SELECT z.series_id, z.day, 'linear' AS model, z.views,
               p.prediction * z.views_sd + z.views_mean AS views_pred, z.dau, p.dau_std * z.dau_sd + z.dau_mean AS dau_pred
        FROM z JOIN pred p USING (series_id, day) WHERE z.part = 'test')
SELECT series_id, day, model, views, round(views_pred, 6) AS views_pred, round(views_pred - views, 6) AS error,
       dau, round(dau_pred, 6) AS dau_pred, round(dau_pred - dau, 6) AS dau_error FROM cmp"""
    ),
)
def q_forecast_compare_linear(spark, sf_dir):
    """F12 for the linear trend (Spark SQL end to end): test-period actuals
    beside the forecast in original units, joined on day."""
    p = _prepared(spark, sf_dir)
    train = p.filter(F.col("part") == "train")
    future = FC.future_frame(train, HORIZON_DAYS)
    dau = FC.linear_trend(train, future, "dau_std").select("series_id", "day", F.col("prediction").alias("dau_std"))
    empty = F.lit(None).cast("double")
    fc = FC.linear_trend(train, future, "views_std").withColumns({"lo": empty, "hi": empty}).join(dau, ["series_id", "day"])
    return _rounded(FC.compare(p, fc).drop("views_lo", "views_hi"), _COMPARE_ROUND)
