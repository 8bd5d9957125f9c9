"""End-to-end preparations composed from the operators."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilospan.functions.calendar import calendar_long, calendar_short, cyclical
from kilospan.functions.clock import epoch_seconds
from kilospan.functions.scalars import clip, outside, row_total
from kilospan.operators import clean
from kilospan.operators.features import lag_columns, next_columns, rolling_columns
from kilospan.operators.resample import interpolate
from kilospan.plans.quantiles import MAX_DISTINCT
from kilospan.plans.series import Series
from kilospan.plans.sizes import checkpointed, left_lookup
from kilospan.schema import (
    HOURLY, KWH_COLUMNS, SIMPLE_COLUMNS, UNIFIED_COLUMNS, Frequency,
)

REGIONAL_LAGS = {"lag_1h": 1, "lag_24h": 24, "lag_168h": 168}


def _regional_rows(df: DataFrame, series: Series, value: str, tiebreak, freq) -> DataFrame:
    """Filled, fenced and clipped grid with its ordered columns and outlier flag."""
    series = series.measured_grid(df, freq.step_seconds)
    rows = df
    if tiebreak:
        rows = clean.keep_first(series.gathered(df), [*series.keys, series.ts], tiebreak)
    filled = interpolate(rows, series, value, freq.step_seconds)
    series = series.on_grid(freq.step_seconds)
    fenced = clean.with_fences(filled, series, value)
    clipped = fenced.withColumns(
        {"__out": outside(value, "lower", "upper"), value: clip(value, "lower", "upper")}
    ).drop("lower", "upper")

    def ordered(d, w):
        return d.withColumns(
            {
                **lag_columns(value, REGIONAL_LAGS, w),
                **rolling_columns(
                    value, freq.rolling_rows, w,
                    ("rolling_24h_mean", "rolling_24h_std"), partial=False,
                ),
            }
        )

    return series.over(clipped, ordered, before=max(REGIONAL_LAGS.values()))


def regional_features(
    df: DataFrame, series: Series, value: str, *, tiebreak: str | None = None,
    freq: Frequency = HOURLY,
) -> DataFrame:
    """Grid, interpolation, quartile clipping, calendar, lags and rolling columns;
    rows with any gap left are dropped."""
    out = _regional_rows(df, series, value, tiebreak, freq).drop("__out")
    out = out.dropna("any").withColumns(calendar_long(series.ts))
    return out.withColumns({**cyclical("hour", 24, "hour"), **cyclical("month", 12, "month")})


def meter_clean(
    df: DataFrame, key: str, ts: str, tiebreak: str, columns=KWH_COLUMNS,
    caps: dict[str, float | None] | None = None,
) -> DataFrame:
    """Parse, dedupe, clip at 0, cap at the 99.9th percentile, total, calendar.

    The caps need a pass of their own; give ``caps`` to reuse known ones.
    """
    rows = df
    if dict(df.dtypes)[ts] == "string":
        rows = clean.parse_timestamps(rows, ts)
    rows = rows.dropna(subset=[ts])
    rows = clean.keep_first(rows.select(key, ts, tiebreak, *columns), [key, ts], tiebreak)
    rows = clean.clip_columns(rows, columns, lower=0.0)
    if caps is None:
        # raw rows bound the deduped ones, and are counted without reading them
        at_most, plain = df.count(), None
        if at_most > MAX_DISTINCT:
            rows = plain = checkpointed(rows)
        caps = clean.quantile_caps(rows, columns, superset=plain, at_most=at_most)
    rows = clean.cap_columns(rows, caps)
    rows = rows.withColumn("TOTAL_KWH", row_total(columns)).drop(tiebreak)
    keep = ("hour", "dayofweek", "month", "year", "is_weekend")
    rows = rows.withColumns({n: c for n, c in calendar_long(ts).items() if n in keep})
    return rows.withColumns({**cyclical("hour", 24, "hour"), **cyclical("month", 12, "month")})


def _scaled(df, series: Series, value, tiebreak, freq, bounds) -> DataFrame:
    """Deduped, clipped, scaled rows under the common column names."""
    (key,) = series.keys
    rows = df
    if dict(df.dtypes)[series.ts] == "string":
        rows = clean.parse_timestamps(rows, series.ts)
    rows = rows.dropna(subset=[series.ts]).select(
        F.col(key).alias("customer_id"),
        F.col(series.ts).alias("datetime"),
        F.col(value).cast("double").alias("load_val"),
        *([F.col(tiebreak).alias("__seq")] if tiebreak else []),
    )
    if tiebreak:
        common = replace(series, keys=("customer_id",), ts="datetime")
        rows = clean.first_readings(rows, common, "__seq")[0].drop("__seq")
    return clean.clip_and_scale(rows, "load_val", "load_scaled", bounds)


def _with_calendar(rows: DataFrame, freq: Frequency) -> DataFrame:
    """Added after the windows: what the clock tells need not travel in a shuffle."""
    rows = rows.withColumns(calendar_short("datetime", freq.step_minutes))
    return rows.withColumns(
        {
            **cyclical("step_of_day", freq.steps_per_day, "step"),
            **cyclical("month", 12, "month"),
        }
    )


TARGETS = {"target_load": "load_val", "target_scaled": "load_scaled"}


def unified_features(
    df: DataFrame, series: Series, value: str, freq: Frequency, bounds: clean.Bounds,
    *, tiebreak: str | None = None, regularise: bool = False,
) -> DataFrame:
    """The 20-column feature table. Lags count rows; ``regularise`` fills the grid
    first so that they count steps."""
    if regularise:
        rows = df
        if tiebreak:
            rows = clean.keep_first(df, [*series.keys, series.ts], tiebreak)
        series = series.measured_grid(rows, freq.step_seconds)
        df = interpolate(rows, series, value, freq.step_seconds)
        series, tiebreak = series.on_grid(freq.step_seconds), None
    # Raw counts bound the deduped ones, so measuring needs no shuffle of readings.
    series = series.measured(df)
    rows = _scaled(df, series, value, tiebreak, freq, bounds)
    common = replace(series, keys=("customer_id",), ts="datetime")
    lags = {"lag_1": 1, "lag_2": 2, "lag_day": freq.lag_day, "lag_week": freq.lag_week}

    def ordered(d, w):
        return d.withColumns(
            {
                **lag_columns("load_scaled", lags, w, fill=0.0),
                **rolling_columns(
                    "load_scaled", freq.rolling_rows, w,
                    ("rolling_mean", "rolling_std"), partial=True,
                ),
                **next_columns("datetime", TARGETS, w),
            }
        )

    out = common.over(rows, ordered, before=max(lags.values()), after=1)
    return _with_calendar(out.dropna("any"), freq).select(*UNIFIED_COLUMNS)


def simple_features(
    df: DataFrame, series: Series, value: str, freq: Frequency, bounds: clean.Bounds,
    *, tiebreak: str | None = None,
) -> DataFrame:
    """The feature table without lag and rolling columns."""
    series = series.measured(df)
    rows = _scaled(df, series, value, tiebreak, freq, bounds)
    common = replace(series, keys=("customer_id",), ts="datetime")
    out = common.over(
        rows, lambda d, w: d.withColumns(next_columns("datetime", TARGETS, w)),
        before=1, after=1,
    )
    return _with_calendar(out.dropna("any"), freq).select(*SIMPLE_COLUMNS)


def prep_report(
    df: DataFrame, series: Series, value: str, tiebreak: str, freq: Frequency = HOURLY
) -> DataFrame:
    """Per series: rows in and out, duplicates, missing steps and clipped outliers.

    The readings are grouped by time once, with the number of their copies; what is counted
    and what is filled both start from there, behind one exchange.
    """
    keys = list(series.keys)
    series = series.measured_grid(df, freq.step_seconds)
    firsts = series.gathered(df).groupBy(*keys, series.ts).agg(
        F.min_by(value, tiebreak).alias(value), F.count(F.lit(1)).alias("__n")
    )
    if series.cut:
        firsts = checkpointed(firsts)
    ends = {"__lo": F.min(series.ts), "__hi": F.max(series.ts)}
    placed = series.with_totals(firsts.select(*keys, series.ts, "__n"), ends)
    span = lambda until: epoch_seconds(until) - epoch_seconds("__lo")
    expected = F.floor(F.max(span("__hi")) / freq.step_seconds) + 1
    on_grid = F.count_if(span(series.ts) % freq.step_seconds == 0)
    report = placed.groupBy(*keys).agg(
        F.sum("__n").alias("rows_in"),
        (F.sum("__n") - F.count(F.lit(1))).alias("duplicates"),
        (expected - on_grid).cast("bigint").alias("missing_steps"),
    )
    rows = _regional_rows(firsts.drop("__n"), series, value, None, freq)
    whole = F.lit(True)
    for c in rows.columns:
        whole = whole & F.col(c).isNotNull()
    done = rows.groupBy(*keys).agg(
        F.count_if("__out").alias("outliers"), F.count_if(whole).alias("rows_out")
    )
    return left_lookup(report, done, keys)
