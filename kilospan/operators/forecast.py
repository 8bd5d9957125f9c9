"""Forecast tables: baseline and linear forecasters, roll-outs, bands and alerts."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilospan.functions.calendar import calendar_short, cyclical
from kilospan.functions.clock import plus_seconds
from kilospan.functions.errors import ROW_PCT_EPSILON, pct_error, rmse
from kilospan.operators.features import lag_columns
from kilospan.plans.series import Series, first_rows
from kilospan.plans.sizes import checkpointed, left_lookup
from kilospan.schema import Frequency

NAIVE_MODELS = ["last_value", "same_slot_day", "same_slot_week", "slot_mean"]
PEAK_THRESHOLD = 0.80


def naive_forecasts(
    df: DataFrame, series: Series, value: str, freq: Frequency, mean_days: int = 7
) -> DataFrame:
    """One row per reading and baseline model: keys, ts, model, actual, predicted.

    Expects a gapless grid, where "same slot n days ago" is a row lag. All models
    come from one window pass.
    """
    days = {f"__d{i}": i * freq.lag_day for i in range(1, mean_days + 1)}
    steps = {"last_value": 1, "same_slot_day": freq.lag_day, "same_slot_week": freq.lag_week}

    def compute(d, w):
        return d.withColumns(lag_columns(value, {**steps, **days}, w))

    rows = series.over(df, compute, before=max([*steps.values(), *days.values()]))
    total = " + ".join(f"coalesce({c}, 0D)" for c in days)
    count = " + ".join(f"cast({c} IS NOT NULL AS int)" for c in days)
    rows = rows.withColumn("slot_mean", F.expr(f"try_divide({total}, {count})"))
    keys = list(series.keys)
    return (
        rows.select(*keys, series.ts, F.col(value).alias("actual"), *NAIVE_MODELS)
        .unpivot([*keys, series.ts, "actual"], NAIVE_MODELS, "model", "predicted")
        .where(F.col("predicted").isNotNull() & F.col("actual").isNotNull())
    )


def linear_forecasts(
    df: DataFrame, series: Series, value: str, split_at: str, model: str = "linear"
) -> DataFrame:
    """One-step forecasts of a fitted model on the rows from ``split_at`` on.

    The model is one line through (value before, value), pooled over all series and fitted
    on the rows before ``split_at`` alone: an aggregate whose one row comes to the driver.
    """
    rows = series.over(
        df, lambda d, w: d.withColumns(lag_columns(value, {"__before": 1}, w)), before=1
    ).select(*series.keys, series.ts, value, "__before").dropna(subset=[value, "__before"])
    at = F.lit(split_at).cast("timestamp_ntz")
    line = rows.where(F.col(series.ts) < at).agg(
        F.regr_slope(value, "__before").alias("slope"),
        F.regr_intercept(value, "__before").alias("intercept"),
    ).first()
    predicted = F.col("__before") * F.lit(line["slope"]) + F.lit(line["intercept"])
    return rows.where(F.col(series.ts) >= at).select(
        *series.keys, series.ts, F.lit(model).alias("model"), F.col(value).alias("actual"),
        predicted.cast("double").alias("predicted"),
    ).dropna(subset=["predicted"])


def with_errors(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted",
    eps: float | None = ROW_PCT_EPSILON,
) -> DataFrame:
    return df.withColumns(
        {
            "abs_error": F.abs(F.col(actual) - F.col(predicted)),
            "pct_error": pct_error(actual, predicted, eps),
        }
    )


def predictions_table(
    predicted: DataFrame, actuals: DataFrame, on: list[str], eps: float | None = ROW_PCT_EPSILON
) -> DataFrame:
    """Predictions beside what happened, matched by key and time."""
    return with_errors(predicted.join(actuals, on, "inner"), eps=eps)


def residuals(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    return df.withColumn("residual", F.col(actual) - F.col(predicted))


def error_band(df: DataFrame, by: list[str], actual="actual", predicted="predicted") -> DataFrame:
    """Prediction plus and minus the model's own RMSE; the lower edge stops at 0.

    The forecasts are kept: their errors are known only when all of them are.
    """
    df = checkpointed(df)
    widths = df.groupBy(*by).agg(rmse(actual, predicted).alias("rmse"))
    out = left_lookup(df, widths, by)
    return out.withColumns(
        {
            "upper": F.col(predicted) + F.col("rmse"),
            "lower": F.greatest(F.col(predicted) - F.col("rmse"), F.lit(0.0)),
        }
    )


def peak_alerts(
    df: DataFrame, keys: list[str], ts: str, predicted: str = "predicted",
    threshold: float = PEAK_THRESHOLD,
) -> DataFrame:
    """Per horizon: its peak, whether that reaches the threshold, and how often."""
    breach = F.col(predicted) >= threshold
    return df.groupBy(*keys).agg(
        F.max(predicted).alias("peak"),
        (F.max(predicted) >= threshold).alias("alert"),
        F.count_if(breach).alias("n_breaches"),
        F.min(F.when(breach, F.col(ts))).alias("first_breach"),
    )


def breaching_steps(df: DataFrame, predicted: str = "predicted", threshold: float = PEAK_THRESHOLD):
    return df.where(F.col(predicted) >= threshold)


def future_calendar(
    df: DataFrame, series: Series, freq: Frequency, steps: int
) -> DataFrame:
    """The next ``steps`` steps after each series' last reading, with calendar columns."""
    ends = df.groupBy(*series.keys).agg(F.max(series.ts).alias("__last"))
    ahead = ends.select(
        *series.keys, "__last", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step")
    )
    rows = ahead.withColumn(
        series.ts, plus_seconds("__last", f"step * {freq.step_seconds}")
    ).drop("__last")
    rows = rows.withColumns(calendar_short(series.ts, freq.step_minutes))
    return rows.withColumns(
        {
            **cyclical("step_of_day", freq.steps_per_day, "step"),
            **cyclical("month", 12, "month"),
        }
    )


def last_rows(df: DataFrame, series: Series, value: str, rows: int) -> DataFrame:
    """The newest ``rows`` readings of each series with their age (1 = newest)."""
    picked = df.select(*series.keys, series.ts, value)
    newest = first_rows(picked, list(series.keys), F.desc(series.ts), rows)
    return newest.withColumnRenamed("__place", "__age")


def rollout_seasonal(
    df: DataFrame, series: Series, value: str, freq: Frequency, steps: int, season: int
) -> DataFrame:
    """Repeat the last season forward: keys, step, ts, predicted.

    Each of the last ``season`` readings emits the future steps it stands for, so
    nothing is gathered per series. A series shorter than a season repeats itself.
    """
    tail = last_rows(df, series, value, season)
    whole = Window.partitionBy(*series.keys)
    tail = tail.withColumns(
        {"__len": F.max("__age").over(whole), "__last": F.max(series.ts).over(whole)}
    )
    first = F.col("__len") - F.col("__age") + 1
    marks = F.when(first <= steps, F.sequence(first, F.lit(steps), F.col("__len")))
    return tail.select(
        *series.keys, "__last", F.explode(marks).alias("step"), F.col(value).alias("predicted")
    ).select(
        *series.keys, "step",
        plus_seconds("__last", f"step * {freq.step_seconds}").alias(series.ts),
        "predicted",
    )


def fit_autoregression(df: DataFrame, series: Series, value: str, order: int) -> LinearRegressionModel:
    """One linear model of the next value on the ``order`` values before it, pooled
    over all series."""
    names = {f"lag_{i}": i for i in range(1, order + 1)}
    rows = series.over(
        df, lambda d, w: d.withColumns(lag_columns(value, names, w)), before=order
    ).select(value, *names).dropna()
    data = VectorAssembler(inputCols=list(names), outputCol="features").transform(rows)
    return LinearRegression(featuresCol="features", labelCol=value, solver="normal").fit(data)


def look_back_forecasts(
    df: DataFrame, series: Series, value: str, rows: int, extra: list[str] = (),
    keep: list[str] = (), split: str = "split",
) -> DataFrame:
    """One-step forecasts on the test part of one linear model of the ``rows`` values before
    a row and of its ``extra`` columns, pooled over all series: keys, ts, ``keep``, actual,
    predicted.

    The fit is one aggregate over the train part: the normal equations are added up in the
    tasks and solved on the driver, where they have as many rows as the model has columns.
    """
    names = {f"__lag_{i}": i for i in range(1, rows + 1)}
    data = series.over(
        df, lambda d, w: d.withColumns(lag_columns(value, names, w)), before=rows
    )
    inputs = [*names, *extra]
    known = data.dropna(subset=[value, *inputs])
    assembled = VectorAssembler(inputCols=inputs, outputCol="__x").transform(
        known.where(F.col(split) == "train").select(value, *inputs)
    )
    model = LinearRegression(featuresCol="__x", labelCol=value, solver="normal").fit(assembled)
    predicted = F.lit(float(model.intercept))
    for c, weight in zip(inputs, model.coefficients):
        predicted = predicted + F.col(c) * F.lit(float(weight))
    return known.where(F.col(split) == "test").select(
        *series.keys, series.ts, *keep, F.col(value).alias("actual"), predicted.alias("predicted")
    )


def rollout_linear(
    df: DataFrame, series: Series, value: str, freq: Frequency, steps: int,
    coefficients: list[float], intercept: float,
) -> DataFrame:
    """Feed a linear autoregression its own output for ``steps`` steps.

    ``coefficients[0]`` belongs to the newest value. Only the last ``order`` values
    per series are gathered; series with fewer give no forecast.
    """
    order = len(coefficients)
    tail = last_rows(df, series, value, order)
    seeds = tail.groupBy(*series.keys).agg(
        F.sort_array(F.collect_list(F.struct("__age", F.col(value).alias("v")))).alias("s"),
        F.max(series.ts).alias("__last"),
    ).where(F.size("s") == order)
    recent = F.transform("s", lambda e: e["v"].cast("double"))
    weights = F.array(*[F.lit(float(c)) for c in coefficients])

    def grow(state: Column, _step: Column) -> Column:
        # Newest first: the head of the array is what the next step looks at.
        terms = F.zip_with(F.slice(state, 1, order), weights, lambda v, c: v * c)
        nxt = F.aggregate(terms, F.lit(float(intercept)), lambda a, b: a + b)
        return F.concat(F.array(nxt), state)

    rolled = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), recent, grow)
    ahead = F.reverse(F.slice(rolled, 1, steps))
    out = seeds.select(*series.keys, "__last", F.posexplode(ahead).alias("__i", "predicted"))
    return out.select(
        *series.keys, (F.col("__i") + 1).alias("step"),
        plus_seconds("__last", f"(__i + 1) * {freq.step_seconds}").alias(series.ts), "predicted",
    )
