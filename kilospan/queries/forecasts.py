"""Forecast tables, scores, comparisons and roll-outs."""

from __future__ import annotations

from pyspark.sql import functions as F

from kilospan.functions.calendar import calendar_short
from kilospan.functions.scalars import unscale
from kilospan.operators import clean, fitted, forecast, metrics, samples, split
from kilospan.queries import query
from kilospan.queries import views as V
from kilospan.queries.views import rounded
from kilospan.schema import HALF_HOURLY, HOURLY

MODELS = forecast.NAIVE_MODELS
# The registry of baseline models and their categories.
REGISTRY = [
    ("last_value", "persistence"),
    ("same_slot_day", "seasonal"),
    ("same_slot_week", "seasonal"),
    ("slot_mean", "averaging"),
]
THRESHOLD = 250.0


def _results(spark, d):
    return metrics.forecast_metrics(V.predictions(spark, d), ["region", "model"])


@query(
    "naive_forecasts",
    f"WITH {V.SQL_PREDICTIONS} SELECT region, ts, model, round(actual, 6) AS actual, "
    "round(predicted, 6) AS predicted FROM pred",
)
def naive_forecasts(spark, d):
    return rounded(V.predictions(spark, d), "actual", "predicted")


SQL_ROW_ERRORS = """round(abs(actual - predicted), 6) AS abs_error,
  round(abs(actual - predicted) / (actual + 1e-4) * 100, 4) AS pct_error"""


@query(
    "predictions_table",
    f"""WITH {V.SQL_PREDICTIONS} SELECT p.region, p.ts, model, round(predicted, 6) AS predicted,
  round(r.load_mw, 6) AS actual, round(abs(r.load_mw - predicted), 6) AS abs_error,
  round(abs(r.load_mw - predicted) / (r.load_mw + 1e-4) * 100, 4) AS pct_error
FROM pred p JOIN region_hourly r ON p.region = r.region AND p.ts = r.ts""",
)
def predictions_table(spark, d):
    actuals = V.region_hourly(spark, d).withColumnRenamed("load_mw", "actual")
    out = forecast.predictions_table(
        V.predictions(spark, d).drop("actual"), actuals, ["region", "ts"]
    )
    out = rounded(out, "predicted", "actual", "abs_error")
    return rounded(out, "pct_error", places=4)


@query(
    "residuals",
    f"WITH {V.SQL_PREDICTIONS} SELECT region, ts, model, round(actual - predicted, 6) AS residual FROM pred",
)
def residuals(spark, d):
    out = forecast.residuals(V.predictions(spark, d))
    return rounded(out.select("region", "ts", "model", "residual"), "residual")


@query("forecast_metrics", f"WITH {V.SQL_PREDICTIONS} SELECT model, {V.SQL_ERRORS} FROM pred GROUP BY model")
def forecast_metrics(spark, d):
    return metrics.forecast_metrics(V.predictions(spark, d), ["model"])


@query("forecast_metrics_by_entity", f"WITH {V.SQL_RESULTS} SELECT * FROM results")
def forecast_metrics_by_entity(spark, d):
    return _results(spark, d)


# -- models fitted per series ---------------------------------------------------------

# Six variants that look back over more and more.
REGION_LAGS = {"lag_1": 1, "lag_2": 2, "lag_3": 3, "lag_day": 24}
REGION_VARIANTS = {
    "level": [], "line": ["lag_1"], "two_steps": ["lag_1", "lag_2"], "day": ["lag_day"],
    "line_day": ["lag_1", "lag_day"], "look_back": [*REGION_LAGS],
}
METER_LAGS = {"lag_1": 1, "lag_2": 2, "lag_3": 3}
METER_VARIANTS = {
    "level": [], "line": ["lag_1"], "second": ["lag_2"], "third": ["lag_3"],
    "two_steps": ["lag_1", "lag_2"], "look_back": [*METER_LAGS],
}


def sql_parted(source: str, key: str, value: str, more: str = "*") -> str:
    """Rows with the part they belong to by their place in the series."""
    return f"""placed AS (SELECT {more}, {value} AS y, row_number() OVER w AS rn,
    count(*) OVER (PARTITION BY {key}) AS n FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY ts)),
parted AS (SELECT *, CASE WHEN rn <= floor(0.70::DOUBLE * n) THEN 'train'
  WHEN rn <= floor(0.85::DOUBLE * n) THEN 'val' ELSE 'test' END AS split FROM placed)"""


def sql_least_squares(key: str, lags: dict[str, int], variants: dict[str, list[str]]) -> str:
    """Least squares per key and variant on the train rows of ``parted``: sums of products,
    solved by elimination column by column."""
    lagged = ", ".join(f"lag(y, {n}) OVER w AS {c}" for c, n in lags.items())
    whole = " AND ".join(f"{c} IS NOT NULL" for c in ["y", *lags])
    # all variants learn from the same rows; a forecast needs only what its variant looks at
    each = " UNION ALL ".join(
        f"""SELECT {key}, ts, split, y, '{m}' AS model, [{', '.join(['1.0::DOUBLE', *chosen, 'y'])}] AS v
  FROM looked WHERE {' AND '.join(f'{c} IS NOT NULL' for c in ['y', *chosen])}
    AND (split != 'train' OR ({whole}))"""
        for m, chosen in variants.items()
    )
    return f"""looked AS (SELECT *, {lagged} FROM parted WINDOW w AS (PARTITION BY {key} ORDER BY ts)),
vec AS ({each}),
ij AS (SELECT {key}, model, v, i, unnest(range(1, len(v) + 1)) AS j FROM (
  SELECT *, unnest(range(1, len(v))) AS i FROM vec WHERE split = 'train')),
sums AS (SELECT {key}, model, i, j, sum(v[i] * v[j]) AS s FROM ij GROUP BY ALL),
lines AS (SELECT {key}, model, i, list(s ORDER BY j) AS r FROM sums GROUP BY ALL),
elim({key}, model, k, m) AS (
  SELECT {key}, model, 1::BIGINT, list(r ORDER BY i) FROM lines GROUP BY ALL
  UNION ALL
  SELECT {key}, model, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k
      THEN list_transform(r, lambda x: x / r[k])
      ELSE list_transform(r, lambda x, j: x - m[k][j] * r[k] / m[k][k]) END)
  FROM elim WHERE k <= len(m)),
fits AS (SELECT {key}, model, list_transform(m, lambda r: r[-1]) AS c FROM elim WHERE k > len(m)),
fitted AS (SELECT v.{key}, ts, v.model, y AS actual, list_dot_product(v[1:-2], c) AS predicted
  FROM vec v JOIN fits f ON v.{key} = f.{key} AND v.model = f.model WHERE split = 'test')"""


SQL_VARIANTS = f"""{sql_parted('filled', 'region', 'load_mw')},
{sql_least_squares('region', REGION_LAGS, REGION_VARIANTS)}"""


def _variants(spark, d):
    filled, series = V.region_filled(spark, d), V.filled_series(spark, d)
    parts = split.split_by_fraction(filled, series)
    return fitted.variant_forecasts(parts, series, "load_mw", REGION_LAGS, REGION_VARIANTS)


@query(
    "model_grid",
    f"""WITH RECURSIVE {V.SQL_RESULTS}, {SQL_VARIANTS}
SELECT region, model, mape, rmse FROM results
UNION ALL SELECT region, model, mape, rmse FROM (SELECT region, model, {V.SQL_ERRORS} FROM fitted GROUP BY ALL)""",
)
def model_grid(spark, d):
    """Baselines on all rows; six models per region on the part they have not seen."""
    scores = metrics.forecast_metrics(_variants(spark, d), ["region", "model"])
    return _results(spark, d).unionByName(scores).select("region", "model", "mape", "rmse")


@query(
    "customer_models",
    f"""WITH RECURSIVE {V.SQL_METER}, {sql_parted('meter', 'customer_id', 'load_val')},
enough AS (SELECT customer_id FROM parted GROUP BY 1 HAVING count(*) FILTER (WHERE split = 'train') >= 10
  AND count(*) FILTER (WHERE split = 'val') >= 5 AND count(*) FILTER (WHERE split = 'test') >= 5),
{sql_least_squares('customer_id', METER_LAGS, METER_VARIANTS)}
SELECT customer_id, model, count(*) AS n, round(avg(abs(actual - predicted)), 4) AS mae,
  round(sqrt(avg((actual - predicted) * (actual - predicted))), 4) AS rmse
FROM fitted WHERE customer_id IN (FROM enough) GROUP BY ALL""",
)
def customer_models(spark, d):
    """Six models for each customer with enough rows in every part."""
    rows, series = V.meter_first(spark, d)
    parts = clean.with_min_history_by_part(split.split_by_fraction(rows, series), series)
    found = fitted.variant_forecasts(parts, series, "load_val", METER_LAGS, METER_VARIANTS)
    scores = metrics.forecast_metrics(found, ["customer_id", "model"])
    return scores.select("customer_id", "model", "n", "mae", "rmse")


_pivot = ", ".join(f"max(CASE WHEN model = '{m}' THEN mape END) AS {m}" for m in MODELS)
_means = ", ".join(f"round(avg({m}), 4) AS {m}" for m in MODELS)


@query(
    "mape_pivot",
    f"""WITH {V.SQL_RESULTS}, p AS (SELECT region, {_pivot} FROM results GROUP BY region)
SELECT * FROM p UNION ALL SELECT 'Average', {_means} FROM p""",
)
def mape_pivot(spark, d):
    return rounded(metrics.mape_pivot(_results(spark, d), "region", MODELS), *MODELS, places=4)


SQL_MEANS = "means AS (SELECT model, avg(mape) AS mean_mape FROM results GROUP BY 1)"


@query(
    "mape_by_model",
    f"WITH {V.SQL_RESULTS}, {SQL_MEANS} SELECT model, round(mean_mape, 4) AS mean_mape FROM means",
)
def mape_by_model(spark, d):
    return rounded(metrics.mape_by_model(_results(spark, d)), "mean_mape", places=4)


_order = "CASE model " + " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(MODELS)) + " END"
SQL_BEST = f"""best AS (SELECT region, model AS best_model, mape AS best_mape FROM results
  QUALIFY row_number() OVER (PARTITION BY region ORDER BY mape, {_order}) = 1)"""


@query("best_model_per_entity", f"WITH {V.SQL_RESULTS}, {SQL_BEST} SELECT * FROM best")
def best_model_per_entity(spark, d):
    return metrics.best_model_per_entity(_results(spark, d), "region", MODELS)


@query(
    "best_model_distribution",
    f"WITH {V.SQL_RESULTS}, {SQL_BEST} SELECT best_model, count(*) AS n_entities FROM best GROUP BY 1",
)
def best_model_distribution(spark, d):
    best = metrics.best_model_per_entity(_results(spark, d), "region", MODELS)
    return metrics.best_model_distribution(best)


@query(
    "best_model_overall",
    f"""WITH {V.SQL_RESULTS}, {SQL_MEANS}
SELECT model, round(mean_mape, 4) AS mean_mape FROM means ORDER BY means.mean_mape, model LIMIT 1""",
)
def best_model_overall(spark, d):
    return rounded(metrics.best_model_overall(_results(spark, d)), "mean_mape", places=4)


@query(
    "best_worst_entities",
    f"""WITH {V.SQL_RESULTS}, {SQL_MEANS},
win AS (SELECT region, mape FROM results WHERE model = (
  SELECT model FROM means ORDER BY mean_mape, model LIMIT 1))
SELECT * FROM (SELECT 'best' AS side, row_number() OVER (ORDER BY mape, region)::INTEGER AS place,
    region, mape FROM win
  UNION ALL SELECT 'worst', row_number() OVER (ORDER BY mape DESC, region DESC)::INTEGER, region, mape
  FROM win) WHERE place <= 2""",
)
def best_worst_entities(spark, d):
    return metrics.best_worst_entities(_results(spark, d), "region", 2)


SQL_HEAD = f"""head AS (SELECT * FROM pred
  QUALIFY row_number() OVER (PARTITION BY region, model ORDER BY ts) <= 168)"""


def _head(spark, d):
    return metrics.horizon_head(V.predictions(spark, d), ["region", "model"], "ts", 168)


@query(
    "horizon_head",
    f"WITH {V.SQL_PREDICTIONS}, {SQL_HEAD} SELECT region, ts, model, round(predicted, 6) AS predicted FROM head",
)
def horizon_head(spark, d):
    return rounded(_head(spark, d).select("region", "ts", "model", "predicted"), "predicted")


@query(
    "horizon_kpis",
    f"""WITH {V.SQL_PREDICTIONS}, {SQL_HEAD}
SELECT region, model, round(max(predicted), 6) AS peak,
  strftime(arg_min(ts, (-predicted, ts)), '%H:%M') AS peak_time, round(min(predicted), 6) AS base,
  round(avg(abs(actual - predicted)), 4) AS mean_abs_error,
  round(avg(abs(actual - predicted) / (actual + 1e-4) * 100), 4) AS mean_pct_error,
  round(max(predicted) * 1.15, 4) AS reserve
FROM head GROUP BY 1, 2""",
)
def horizon_kpis(spark, d):
    rows = forecast.with_errors(_head(spark, d))
    out = rounded(metrics.horizon_kpis(rows, ["region", "model"], "ts"), "peak", "base")
    return rounded(out, "mean_abs_error", "mean_pct_error", "reserve", places=4)


@query(
    "peak_alerts",
    f"""WITH {V.SQL_PREDICTIONS}, {SQL_HEAD}
SELECT region, model, round(max(predicted), 6) AS peak, max(predicted) >= {THRESHOLD} AS alert,
  count(*) FILTER (WHERE predicted >= {THRESHOLD}) AS n_breaches,
  min(ts) FILTER (WHERE predicted >= {THRESHOLD}) AS first_breach
FROM head GROUP BY 1, 2""",
)
def peak_alerts(spark, d):
    out = forecast.peak_alerts(_head(spark, d), ["region", "model"], "ts", threshold=THRESHOLD)
    return rounded(out, "peak")


@query(
    "breaching_steps",
    f"""WITH {V.SQL_PREDICTIONS} SELECT region, ts, model, round(predicted, 6) AS predicted
FROM pred WHERE predicted >= {THRESHOLD}""",
)
def breaching_steps(spark, d):
    out = forecast.breaching_steps(V.predictions(spark, d), threshold=THRESHOLD)
    return rounded(out.drop("actual"), "predicted")


@query(
    "error_band",
    f"""WITH {V.SQL_PREDICTIONS}, widths AS (SELECT model,
  sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse FROM pred GROUP BY 1)
SELECT region, ts, p.model, round(predicted, 6) AS predicted, round(predicted + rmse, 4) AS upper,
  round(greatest(predicted - rmse, 0), 4) AS lower
FROM pred p JOIN widths w ON p.model = w.model""",
)
def error_band(spark, d):
    out = forecast.error_band(V.predictions(spark, d), ["model"]).drop("actual", "rmse")
    return rounded(rounded(out, "predicted"), "upper", "lower", places=4)


_registry = ", ".join(f"('{m}', '{c}')" for m, c in REGISTRY)


@query(
    "leaderboard",
    f"""WITH {V.SQL_PREDICTIONS}, m AS (SELECT model, {V.SQL_ERRORS} FROM pred GROUP BY model)
SELECT g.model, category, mae, rmse, mape, r2,
  rank() OVER (ORDER BY rmse NULLS LAST)::INTEGER AS rank
FROM (VALUES {_registry}) AS g(model, category) LEFT JOIN m ON g.model = m.model""",
)
def leaderboard(spark, d):
    scores = metrics.forecast_metrics(V.predictions(spark, d), ["model"])
    registry = spark.createDataFrame(REGISTRY, "model string, category string")
    board = metrics.leaderboard(scores, registry)
    return board.select("model", "category", "mae", "rmse", "mape", "r2", "rank")


# -- looking ahead ---------------------------------------------------------------------

SQL_SLOT = "((hour(ts) * 60 + minute(ts)) // 30)::INTEGER"


@query(
    "future_calendar",
    f"""WITH {V.SQL_METER_RAW}, ends AS (SELECT customer_id, max(ts) AS last FROM meter_raw GROUP BY 1),
ahead AS (SELECT customer_id, last, unnest(range(1, 49))::INTEGER AS step FROM ends),
f AS (SELECT customer_id, step, last + step * INTERVAL 30 MINUTE AS ts FROM ahead)
SELECT customer_id, step, ts, {SQL_SLOT} AS step_of_day, (isodow(ts) - 1)::INTEGER AS day_of_week,
  month(ts)::INTEGER AS month, (isodow(ts) >= 6)::INTEGER AS is_weekend,
  round(sin(2 * pi() * {SQL_SLOT} / 48), 6) + 0.0 AS step_sin,
  round(cos(2 * pi() * {SQL_SLOT} / 48), 6) + 0.0 AS step_cos,
  round(sin(2 * pi() * month(ts) / 12), 6) + 0.0 AS month_sin,
  round(cos(2 * pi() * month(ts) / 12), 6) + 0.0 AS month_cos
FROM f""",
)
def future_calendar(spark, d):
    out = forecast.future_calendar(V.meter_raw(spark, d), V.METER, HALF_HOURLY, 48)
    names = ["step_sin", "step_cos", "month_sin", "month_cos"]
    return out.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in names})


@query(
    "rollout_seasonal",
    f"""WITH {V.SQL_FILLED}, tail AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY ts DESC) AS age
  FROM filled QUALIFY age <= 24),
info AS (SELECT region, count(*) AS len, max(ts) AS last FROM tail GROUP BY 1),
steps AS (SELECT region, len, last, unnest(range(1, 169))::INTEGER AS step FROM info)
SELECT s.region, s.step, s.last + s.step * INTERVAL 1 HOUR AS ts, round(t.load_mw, 6) AS predicted
FROM steps s JOIN tail t ON s.region = t.region AND t.age = s.len - (s.step - 1) % s.len""",
)
def rollout_seasonal(spark, d):
    out = forecast.rollout_seasonal(
        V.region_filled(spark, d), V.REGION, "load_mw", HOURLY, 168, 24
    )
    return rounded(out, "predicted")


@query(
    "rollout_linear",
    f"""WITH RECURSIVE {V.SQL_FILLED},
pairs AS (SELECT region, load_mw AS y, lag(load_mw) OVER (PARTITION BY region ORDER BY ts) AS x FROM filled),
fit AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM pairs WHERE x IS NOT NULL),
roll(region, last, step, v) AS (
  SELECT region, max(ts), 0, arg_max(load_mw, ts) FROM filled GROUP BY 1
  UNION ALL SELECT region, last, step + 1, a + b * v FROM roll, fit WHERE step < 48)
SELECT region, step, last + step * INTERVAL 1 HOUR AS ts, round(v, 4) AS predicted
FROM roll WHERE step > 0""",
)
def rollout_linear(spark, d):
    filled, series = V.region_filled(spark, d), V.filled_series(spark, d)
    model = forecast.fit_autoregression(filled, series, "load_mw", 1)
    out = forecast.rollout_linear(
        filled, series, "load_mw", HOURLY, 48, list(model.coefficients), model.intercept
    )
    return rounded(out, "predicted", places=4)


LOOK_BACK = 24
_look_back = {f"lag_{i}": i for i in range(1, LOOK_BACK + 1)}
# Columns a model uses where the table has them.
OPTIONAL = ["is_weekend", "temperature"]


@query(
    "ml_forecast_metrics",
    f"""WITH RECURSIVE {V.SQL_FILLED},
widths AS (SELECT region, min(load_mw) AS least, max(load_mw) AS most FROM filled GROUP BY 1),
scaled AS (SELECT f.region, ts, load_mw, least, most, (load_mw - least) / (most - least) AS load_scaled,
  (isodow(ts) >= 6)::INTEGER::DOUBLE AS is_weekend, 0 AS pool
  FROM filled f JOIN widths e ON f.region = e.region),
{sql_parted('scaled', 'region', 'load_scaled')},
lags AS (SELECT *, {', '.join(f'lag(y, {n}) OVER w AS {c}' for c, n in _look_back.items())}
  FROM parted WINDOW w AS (PARTITION BY region ORDER BY ts)),
vec AS (SELECT region, split, load_mw, least, most, [1.0::DOUBLE, {', '.join(_look_back)}, is_weekend, y] AS v
  FROM lags WHERE lag_{LOOK_BACK} IS NOT NULL),
ij AS (SELECT v, i, unnest(range(1, len(v) + 1)) AS j FROM (
  SELECT v, unnest(range(1, len(v))) AS i FROM vec WHERE split = 'train')),
sums AS (SELECT i, j, sum(v[i] * v[j]) AS s FROM ij GROUP BY ALL),
lines AS (SELECT i, list(s ORDER BY j) AS r FROM sums GROUP BY ALL),
elim(k, m) AS (
  SELECT 1::BIGINT, list(r ORDER BY i) FROM lines
  UNION ALL
  SELECT k + 1, list_transform(m, lambda r, i: CASE WHEN i = k
      THEN list_transform(r, lambda x: x / r[k])
      ELSE list_transform(r, lambda x, j: x - m[k][j] * r[k] / m[k][k]) END)
  FROM elim WHERE k <= len(m)),
fit AS (SELECT list_transform(m, lambda r: r[-1]) AS c FROM elim WHERE k > len(m)),
scored AS (SELECT region, load_mw AS actual,
  greatest(list_dot_product(v[1:-2], c) * (most - least) + least, 0) AS predicted
  FROM vec, fit WHERE split = 'test')
SELECT region, {V.SQL_ERRORS} FROM scored GROUP BY region""",
)
def ml_forecast_metrics(spark, d):
    """A pooled look-back regression, scored on each region's last part in its own unit."""
    filled, series = V.region_filled(spark, d), V.filled_series(spark, d)
    rows = series.with_totals(filled, {"least": F.min("load_mw"), "most": F.max("load_mw")})
    rows = clean.ensure_scaled(rows, series, "load_mw", "load_scaled")
    rows = rows.withColumns(calendar_short("ts", 60))
    parts = split.split_by_fraction(rows, series)
    scored = forecast.look_back_forecasts(
        parts, series, "load_scaled", LOOK_BACK, samples.present(parts, OPTIONAL),
        keep=["load_mw", "least", "most"],
    )
    scored = scored.withColumns(
        {"actual": F.col("load_mw"), "predicted": unscale("predicted", "least", "most", floor=0.0)}
    )
    return metrics.forecast_metrics(scored, ["region"])


# -- a fitted model beside the baselines ---------------------------------------------

SPLIT_AT = "2024-01-22"
SQL_FITTED = f"""{V.SQL_PREDICTIONS},
before AS (SELECT region, ts, load_mw AS actual, lag(load_mw) OVER (PARTITION BY region ORDER BY ts) AS x
  FROM filled),
line AS (SELECT regr_slope(actual, x) AS slope, regr_intercept(actual, x) AS intercept
  FROM before WHERE ts < TIMESTAMP '{SPLIT_AT}'),
fitted AS (SELECT region, ts, model, actual, predicted FROM pred
  UNION ALL SELECT region, ts, 'linear', actual, x * slope + intercept FROM before, line
  WHERE ts >= TIMESTAMP '{SPLIT_AT}' AND x IS NOT NULL AND actual IS NOT NULL)"""
FITTED_MODELS = [*MODELS, "linear"]


def _fitted(spark, d):
    filled, series = V.region_filled(spark, d), V.filled_series(spark, d)
    linear = forecast.linear_forecasts(filled, series, "load_mw", SPLIT_AT)
    return V.predictions(spark, d).unionByName(linear)


@query(
    "fitted_model_grid",
    f"WITH {SQL_FITTED} SELECT region, model, {V.SQL_ERRORS} FROM fitted GROUP BY ALL",
)
def fitted_model_grid(spark, d):
    """Baselines on all rows, the fitted line on the rows it has not seen."""
    return metrics.forecast_metrics(_fitted(spark, d), ["region", "model"])


_fitted_pivot = ", ".join(f"max(CASE WHEN model = '{m}' THEN mape END) AS {m}" for m in FITTED_MODELS)
_fitted_means = ", ".join(f"round(avg({m}), 4) AS {m}" for m in FITTED_MODELS)


@query(
    "fitted_mape_pivot",
    f"""WITH {SQL_FITTED}, results AS (SELECT region, model, {V.SQL_ERRORS} FROM fitted GROUP BY ALL),
p AS (SELECT region, {_fitted_pivot} FROM results GROUP BY region)
SELECT * FROM p UNION ALL SELECT 'Average', {_fitted_means} FROM p""",
)
def fitted_mape_pivot(spark, d):
    results = metrics.forecast_metrics(_fitted(spark, d), ["region", "model"])
    return rounded(metrics.mape_pivot(results, "region", FITTED_MODELS), *FITTED_MODELS, places=4)


@query(
    "fitted_leaderboard",
    f"""WITH {SQL_FITTED}, m AS (SELECT model, {V.SQL_ERRORS} FROM fitted GROUP BY model)
SELECT model, mae, rmse, mape, r2, rank() OVER (ORDER BY rmse NULLS LAST)::INTEGER AS rank FROM m""",
)
def fitted_leaderboard(spark, d):
    scores = metrics.forecast_metrics(_fitted(spark, d), ["model"])
    return metrics.leaderboard(scores).select("model", "mae", "rmse", "mape", "r2", "rank")
