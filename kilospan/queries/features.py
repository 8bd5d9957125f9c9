"""Calendar, ordered features, splits, samples and end-to-end preparations."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from kilospan.functions import calendar as C
from kilospan.functions.clock import step_of_day, step_of_day_sql
from kilospan.functions.scalars import rounded as half_away
from kilospan.operators import clean, features, samples, split
from kilospan.operators.sets import with_region_ids
from kilospan.plans import recipes
from kilospan.queries import query
from kilospan.queries import views as V
from kilospan.queries.cleaning import KWH, SQL_BOUNDS, SQL_FENCES
from kilospan.queries.views import rounded
from kilospan.schema import HALF_HOURLY, HOURLY
from kilospan.sources.tables import ReadingStore, scratch

# Small enough that the test tables' series are cut, so the long-series plan runs.
SHORT_BLOCK = 50

# -- calendar ------------------------------------------------------------------

SQL_CALENDAR = """hour(ts)::INTEGER AS hour, (isodow(ts) - 1)::INTEGER AS dayofweek,
  month(ts)::INTEGER AS month, year(ts)::INTEGER AS year, dayofyear(ts)::INTEGER AS dayofyear,
  quarter(ts)::INTEGER AS quarter, (isodow(ts) >= 6)::INTEGER AS is_weekend"""
SQL_SLOT = "((hour(ts) * 60 + minute(ts)) // 30)::INTEGER"


@query(
    "calendar_features",
    f"SELECT event_id, ts, minute(ts)::INTEGER AS minute, {SQL_SLOT} AS step_of_day, {SQL_CALENDAR} FROM events",
)
def calendar_features(spark, d):
    events = V.table(spark, d, "events").select("event_id", "ts")
    return events.withColumns(
        {"minute": F.minute("ts"), "step_of_day": step_of_day("ts", 30), **C.calendar_long("ts")}
    )


def _sql_cyc(expr: str, period: int, name: str) -> str:
    return (
        f"round(sin(2 * pi() * {expr} / {period}), 6) + 0.0 AS {name}_sin, "
        f"round(cos(2 * pi() * {expr} / {period}), 6) + 0.0 AS {name}_cos"
    )


@query(
    "cyclical_features",
    f"SELECT event_id, {_sql_cyc('hour(ts)', 24, 'hour')}, {_sql_cyc(SQL_SLOT, 48, 'step')}, "
    f"{_sql_cyc('month(ts)', 12, 'month')} FROM events",
)
def cyclical_features(spark, d):
    cols = {
        **C.cyclical("hour(ts)", 24, "hour"),
        **C.cyclical(step_of_day_sql("ts", 30), 48, "step"),
        **C.cyclical("month(ts)", 12, "month"),
    }
    events = V.table(spark, d, "events")
    return rounded(events.select("event_id", *[c.alias(n) for n, c in cols.items()]), *cols)


@query(
    "one_hot_slot",
    f"""SELECT event_id, CASE WHEN ts IS NOT NULL THEN 1 END AS n_set, coalesce({SQL_SLOT} + 1, 0) AS slot_at,
  coalesce(isodow(ts)::INTEGER, 0) AS weekday_at
FROM events""",
)
def one_hot_slot(spark, d):
    slots = C.one_hot(step_of_day_sql("ts", 30), 48, "int")
    weekdays = C.one_hot("weekday(ts)", 7, "int")
    hot = V.table(spark, d, "events").select(
        "event_id", slots.alias("s"), weekdays.alias("w")
    )
    return hot.select(
        "event_id",
        F.aggregate("s", F.lit(0), lambda a, b: a + b).alias("n_set"),
        F.array_position("s", 1).cast("int").alias("slot_at"),
        F.array_position("w", 1).cast("int").alias("weekday_at"),
    )


@query(
    "basic_vector",
    f"""SELECT event_id, 57 AS size, round(value, 6) AS load,
  coalesce({SQL_SLOT} + 2, 1) AS slot_at, coalesce((isodow(ts) - 1 + 50)::INTEGER, 49) AS weekday_at,
  (isodow(ts) >= 6)::INTEGER::DOUBLE AS weekend FROM events""",
)
def basic_vector(spark, d):
    vec = V.table(spark, d, "events").select(
        "event_id", C.basic_vector("value", "ts", 30, "double").alias("v")
    )
    at = lambda start, n: F.array_position(F.slice("v", start, n), 1.0).cast("int")
    return vec.select(
        "event_id",
        F.size("v").alias("size"),
        half_away("element_at(v, 1)", 6).alias("load"),
        (at(2, 48) + 1).alias("slot_at"),
        (at(50, 7) + 49).alias("weekday_at"),
        F.col("v")[56].alias("weekend"),
    )


# -- ordered features on meters --------------------------------------------------

W = "WINDOW w AS (PARTITION BY customer_id ORDER BY ts)"
SQL_LAGS = f"""WITH {V.SQL_METER} SELECT customer_id, ts, load_val, seq,
  lag(load_val, 1) OVER w AS lag_1, lag(load_val, 24) OVER w AS lag_24,
  lag(load_val, 168) OVER w AS lag_168 FROM meter {W}"""
LAGS = {"lag_1": 1, "lag_24": 24, "lag_168": 168}
CUT_METER = replace(V.METER, rows_per_block=SHORT_BLOCK)


@query("lag_features", SQL_LAGS)
def lag_features(spark, d):
    rows, series = V.meter_first(spark, d)
    return features.lags(rows, series, "load_val", LAGS)


@query("stored_lag_features", SQL_LAGS)
def stored_lag_features(spark, d):
    """Lags over a stored table that was written in two appends, without an exchange."""
    rows, series = V.meter_first(spark, d)
    path = scratch(spark, "store")
    store = ReadingStore(f"store_{path[-32:]}", path, "customer_id", "ts", buckets=8)
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    store.append(rows.where(~late), series)
    store.append(rows.where(late), series)
    return features.lags(store.open(spark), series, "load_val", LAGS)


@query("lag_features_cut", SQL_LAGS)
def lag_features_cut(spark, d):
    """Lags with every long series cut into blocks."""
    rows, series = V.meter_first(spark, d, CUT_METER)
    return features.lags(rows, series, "load_val", LAGS)


@query(
    "lag_zero_fill",
    f"""WITH {V.SQL_METER} SELECT customer_id, ts, load_val, seq,
  coalesce(lag(load_val, 1) OVER w, 0) AS lag_1, coalesce(lag(load_val, 2) OVER w, 0) AS lag_2,
  coalesce(lag(load_val, 48) OVER w, 0) AS lag_day,
  coalesce(lag(load_val, 336) OVER w, 0) AS lag_week FROM meter {W}""",
)
def lag_zero_fill(spark, d):
    steps = {"lag_1": 1, "lag_2": 2, "lag_day": 48, "lag_week": 336}
    rows, series = V.meter_first(spark, d)
    return features.lags(rows, series, "load_val", steps, fill=0.0)


def _sql_rolling(rows: int, guard: bool) -> str:
    frame = (
        f"(PARTITION BY customer_id ORDER BY ts ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    )
    mean = f"avg(load_val) OVER {frame}"
    dev = f"stddev_samp(load_val) OVER {frame}"
    if guard:
        full = f"count(load_val) OVER {frame} = {rows}"
        mean, dev = f"CASE WHEN {full} THEN {mean} END", f"CASE WHEN {full} THEN {dev} END"
    else:
        dev = f"coalesce({dev}, 0)"
    return f"""WITH {V.SQL_METER} SELECT customer_id, ts, load_val, seq,
  round({mean}, 6) AS rolling_mean, round({dev}, 6) AS rolling_std FROM meter"""


@query("rolling_full", _sql_rolling(24, True))
def rolling_full(spark, d):
    rows, series = V.meter_first(spark, d)
    out = features.rolling(rows, series, "load_val", 24)
    return rounded(out, "rolling_mean", "rolling_std")


@query("rolling_partial", _sql_rolling(12, False))
def rolling_partial(spark, d):
    rows, series = V.meter_first(spark, d)
    out = features.rolling(rows, series, "load_val", 12, partial=True)
    return rounded(out, "rolling_mean", "rolling_std")


@query("rolling_partial_cut", _sql_rolling(12, False))
def rolling_partial_cut(spark, d):
    rows, series = V.meter_first(spark, d, CUT_METER)
    out = features.rolling(rows, series, "load_val", 12, partial=True)
    return rounded(out, "rolling_mean", "rolling_std")


SQL_LEAD = f"""WITH {V.SQL_METER}, placed AS (
  SELECT *, CASE WHEN load_val < 0 THEN NULL ELSE load_val END AS x,
    row_number() OVER (PARTITION BY customer_id ORDER BY ts) AS rn FROM meter)
SELECT customer_id, ts, x, seq, last_value(CASE WHEN rn > 1 THEN x END IGNORE NULLS) OVER (
    PARTITION BY customer_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 FOLLOWING) AS target
FROM placed"""


def _with_holes(spark, d, series=V.METER):
    """Meter readings whose negative values count as missing, and their series."""
    rows, series = V.meter_first(spark, d, series)
    x = F.when(F.col("load_val") >= 0, F.col("load_val"))
    return rows.select("customer_id", "ts", x.alias("x"), "seq"), series


@query("lead_target", SQL_LEAD)
def lead_target(spark, d):
    return features.lead_target(*_with_holes(spark, d), "x")


@query("lead_target_cut", SQL_LEAD)
def lead_target_cut(spark, d):
    return features.lead_target(*_with_holes(spark, d, CUT_METER), "x")


@query(
    "past_k_stats",
    f"""WITH {V.SQL_METER} SELECT customer_id, ts, load_val, seq,
  round(coalesce(avg(load_val) OVER f, 0), 6) AS past_mean,
  round(coalesce(stddev_samp(load_val) OVER f, 0), 6) AS past_std
FROM meter WINDOW f AS (PARTITION BY customer_id ORDER BY ts ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)""",
)
def past_k_stats(spark, d):
    rows, series = V.meter_first(spark, d)
    out = features.past_stats(rows, series, "load_val", 12)
    return rounded(out, "past_mean", "past_std")


@query(
    "same_slot_stats",
    f"""WITH {V.SQL_METER} SELECT customer_id, ts, load_val, seq, {SQL_SLOT} AS time_slot,
  round(coalesce(avg(load_val) OVER f, 0), 6) AS slot_mean,
  round(coalesce(stddev_samp(load_val) OVER f, 0), 6) AS slot_std
FROM meter WINDOW f AS (PARTITION BY customer_id, {SQL_SLOT} ORDER BY ts
  ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)""",
)
def same_slot_stats(spark, d):
    rows, series = V.meter_first(spark, d)
    rows = rows.withColumn("time_slot", step_of_day("ts", 30))
    out = features.same_slot_stats(rows, series, "time_slot", "load_val", 3)
    return rounded(out, "slot_mean", "slot_std")


# -- splits ----------------------------------------------------------------------


@query(
    "split_date",
    f"""WITH {V.SQL_FILLED} SELECT region, ts, round(load_mw, 6) AS load_mw,
  CASE WHEN ts < TIMESTAMP '2024-01-21' THEN 'train' ELSE 'test' END AS split FROM filled""",
)
def split_date(spark, d):
    return rounded(split.split_at(V.region_filled(spark, d), "ts", "2024-01-21"), "load_mw")


SQL_FRACTION = f"""{V.SQL_METER}, placed AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY ts) AS rn,
    count(*) OVER (PARTITION BY customer_id) AS n FROM meter),
parts AS (SELECT customer_id, ts, load_val, seq,
  CASE WHEN rn <= floor(0.70::DOUBLE * n) THEN 'train'
       WHEN rn <= floor(0.85::DOUBLE * n) THEN 'val' ELSE 'test' END AS split FROM placed)"""


@query("split_fraction", f"WITH {SQL_FRACTION} SELECT * FROM parts")
def split_fraction(spark, d):
    return split.split_by_fraction(*V.meter_first(spark, d))


@query("split_fraction_cut", f"WITH {SQL_FRACTION} SELECT * FROM parts")
def split_fraction_cut(spark, d):
    return split.split_by_fraction(*V.meter_first(spark, d, CUT_METER))


@query(
    "split_report",
    f"""WITH {SQL_FRACTION} SELECT customer_id, split, count(*) AS n_rows,
  min(ts) AS first_ts, max(ts) AS last_ts,
  round(count(*) / sum(count(*)) OVER (PARTITION BY customer_id), 6) AS share
FROM parts GROUP BY 1, 2""",
)
def split_report(spark, d):
    parts = split.split_by_fraction(*V.meter_first(spark, d))
    return rounded(split.split_report(parts, ["customer_id"], "ts"), "share")


# Calendar parts of the test month.
RANGES = {
    "train": ("2024-01-02", "2024-01-20"),
    "val": ("2024-01-21", "2024-01-25"),
    "test": ("2024-01-26", "2024-01-28"),
}
SQL_PART = """CASE WHEN ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-21' THEN 'train'
  WHEN ts >= TIMESTAMP '2024-01-21' AND ts < TIMESTAMP '2024-01-26' THEN 'val'
  WHEN ts >= TIMESTAMP '2024-01-26' AND ts < TIMESTAMP '2024-01-29' THEN 'test' END"""


@query(
    "split_calendar",
    f"""SELECT * FROM (SELECT event_id, ts, {SQL_PART} AS split FROM events)
WHERE split IS NOT NULL""",
)
def split_calendar(spark, d):
    events = V.table(spark, d, "events").select("event_id", "ts")
    return split.split_by_calendar(events, "ts", RANGES)


# -- samples -----------------------------------------------------------------------


@query(
    "sliding_windows",
    f"""WITH {V.SQL_FILLED}, x AS (
  SELECT region, ts, load_mw AS y, list(load_mw) OVER (
    PARTITION BY region ORDER BY ts ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS x FROM filled)
SELECT region, ts, len(x)::INTEGER AS n, round(x[1], 6) AS x_first, round(x[24], 6) AS x_last,
  round(list_sum(x)::FLOAT::DOUBLE, 4) AS x_sum, round(y, 6) AS y FROM x WHERE len(x) = 24""",
)
def sliding_windows(spark, d):
    series = V.filled_series(spark, d)
    rows = V.region_filled(spark, d).withColumn("y", F.col("load_mw"))
    got = samples.lookback_arrays(
        rows, series, {"x": F.struct(F.col("load_mw").alias("load"))}, 24, ["y"]
    )
    total = F.aggregate("x", F.lit(0.0), lambda a, e: a + e["load"])
    return got.select(
        "region", "ts", F.size("x").alias("n"),
        half_away("element_at(x, 1).load", 6).alias("x_first"),
        half_away("element_at(x, 24).load", 6).alias("x_last"),
        F.round(total.cast("float").cast("double"), 4).alias("x_sum"), half_away("y", 6).alias("y"),
    )


@query(
    "sequence_samples",
    f"""WITH {V.SQL_METER}, ranged AS (
  SELECT * FROM meter WHERE ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-30'),
top AS (SELECT customer_id, count(*) AS n FROM ranged GROUP BY 1 ORDER BY n DESC, customer_id LIMIT 69),
kept AS (SELECT r.*, {SQL_SLOT} AS slot FROM ranged r JOIN top t ON r.customer_id = t.customer_id
  WHERE t.n >= 22),
stats AS (SELECT customer_id, ts, load_val::FLOAT::DOUBLE AS load, (isodow(ts) >= 6)::INTEGER AS wk,
  coalesce(avg(load_val) OVER p, 0)::FLOAT::DOUBLE AS m1,
  coalesce(stddev_samp(load_val) OVER p, 0)::FLOAT::DOUBLE AS s1,
  coalesce(avg(load_val) OVER q, 0)::FLOAT::DOUBLE AS m2,
  coalesce(stddev_samp(load_val) OVER q, 0)::FLOAT::DOUBLE AS s2
  FROM kept WINDOW p AS (PARTITION BY customer_id ORDER BY ts ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING),
    q AS (PARTITION BY customer_id, slot ORDER BY ts ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)),
seq AS (SELECT customer_id, ts, load AS y, count(*) OVER f AS n,
  CASE WHEN count(load) OVER f = 12 THEN sum(load + 2 + wk) OVER f END AS basic_sum, sum(m1 + s1 + m2 + s2) OVER f AS derived_sum
  FROM stats WINDOW f AS (PARTITION BY customer_id ORDER BY ts ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)),
lab AS (SELECT *, {SQL_PART} AS split FROM seq WHERE n = 12)
SELECT customer_id, ts, split, round(y, 3) AS y, 12 AS n_steps, 57 AS n_basic, 4 AS n_derived,
  round(basic_sum, 2) AS basic_sum, round(derived_sum, 2) AS derived_sum
FROM lab WHERE split IS NOT NULL""",
)
def sequence_samples(spark, d):
    got = samples.sequence_dataset(
        V.meter_raw(spark, d), V.METER, "load_val", k_steps=12, n_entities=69,
        start="2024-01-02", end="2024-01-29", step_minutes=30, ranges=RANGES, tiebreak="seq",
    )
    total = lambda c: F.aggregate(
        F.flatten(c), F.lit(0.0), lambda a, e: a + e.cast("double")
    )
    return got.select(
        "customer_id", "ts", "split",
        F.round(F.col("y").cast("double"), 3).alias("y"),
        F.size("basic").alias("n_steps"),
        F.size(F.col("basic")[0]).alias("n_basic"),
        F.size(F.col("derived")[0]).alias("n_derived"),
        F.round(total("basic"), 2).alias("basic_sum"),
        F.round(total("derived"), 2).alias("derived_sum"),
    )


# -- end to end ----------------------------------------------------------------------

REGIONAL_ROUNDED = [
    "load_mw", "hour_sin", "hour_cos", "month_sin", "month_cos",
    "lag_1h", "lag_24h", "lag_168h",
]
ROLLED = ["rolling_24h_mean", "rolling_24h_std"]


def _sql_regional(source: str) -> str:
    roll = "(PARTITION BY region ORDER BY ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)"
    return f"""WITH {source}, {V.SQL_SPINE}, {V.SQL_FILL}, {SQL_FENCES},
clipped AS (SELECT f.region, f.ts, least(greatest(load_mw, lower), upper) AS load_mw
  FROM filled f JOIN fences q ON f.region = q.region),
feats AS (SELECT region, ts, load_mw, lag(load_mw, 1) OVER w AS lag_1h,
  lag(load_mw, 24) OVER w AS lag_24h, lag(load_mw, 168) OVER w AS lag_168h,
  avg(load_mw) OVER {roll} AS m, stddev_samp(load_mw) OVER {roll} AS s
  FROM clipped WINDOW w AS (PARTITION BY region ORDER BY ts))
SELECT region, ts, round(load_mw, 6) AS load_mw, {SQL_CALENDAR},
  {_sql_cyc('hour(ts)', 24, 'hour')}, {_sql_cyc('month(ts)', 12, 'month')},
  round(lag_1h, 6) AS lag_1h, round(lag_24h, 6) AS lag_24h, round(lag_168h, 6) AS lag_168h,
  round(m::FLOAT::DOUBLE, 6) AS rolling_24h_mean, round(s::FLOAT::DOUBLE, 6) AS rolling_24h_std
FROM feats WHERE lag_168h IS NOT NULL"""


def _regional(df, series, **kw):
    out = recipes.regional_features(df, series, "load_mw", **kw)
    # Means of 24 decimals often end in an exact half, which engines round either
    # way; at FLOAT storage precision both sides see the same number.
    out = rounded(out.withColumns({c: F.col(c).cast("float").cast("double") for c in ROLLED}), *ROLLED)
    return out.withColumns({c: half_away(c, 6) for c in REGIONAL_ROUNDED})


@query("regional_features", _sql_regional(V.SQL_REGION_HOURLY))
def regional_features(spark, d):
    return _regional(V.region_hourly(spark, d), V.REGION)


@query("regional_features_raw", _sql_regional(V.SQL_REGION_FIRST))
def regional_features_raw(spark, d):
    """From single readings with repeats: the first one of each hour counts."""
    return _regional(V.region_raw(spark, d), V.REGION, tiebreak="seq")


@query("regional_features_cut", _sql_regional(V.SQL_REGION_HOURLY))
def regional_features_cut(spark, d):
    """The long-series plan: blocks of hours and distributed quartiles."""
    return _regional(V.region_hourly(spark, d), replace(V.REGION, rows_per_block=200))


def _sql_step_cyc(steps: int) -> str:
    return f"{_sql_cyc('step_of_day', steps, 'step')}, {_sql_cyc('month', 12, 'month')}"


SQL_STEP_CYC = _sql_step_cyc(48)
ROUNDED_SIMPLE = [
    "load_val", "load_scaled", "step_sin", "step_cos", "month_sin", "month_cos",
    "target_load", "target_scaled",
]
UNIFIED_ROLLED = ["rolling_mean", "rolling_std"]
ROUNDED_UNIFIED = ROUNDED_SIMPLE + [
    "lag_1", "lag_2", "lag_day", "lag_week", "rolling_mean", "rolling_std",
]
def _sql_scaled(table: str, slot: str, day: int, week: int, rolled: int) -> str:
    return f"""scaled AS (SELECT customer_id, ts AS datetime, CASE WHEN load_val IS NOT NULL THEN least(greatest(load_val, lo), hi) END AS load_val,
  CASE WHEN load_val IS NOT NULL THEN (least(greatest(load_val, lo), hi) - lo) / (hi - lo) END AS load_scaled,
  {slot} AS step_of_day, (isodow(ts) - 1)::INTEGER AS day_of_week,
  month(ts)::INTEGER AS month, (isodow(ts) >= 6)::INTEGER AS is_weekend
  FROM {table}, bounds),
nexts AS (SELECT *, row_number() OVER w AS rn, lead(load_val) OVER w AS next_load,
  lead(load_scaled) OVER w AS next_scaled,
  coalesce(lag(load_scaled, 1) OVER w, 0) AS lag_1, coalesce(lag(load_scaled, 2) OVER w, 0) AS lag_2,
  coalesce(lag(load_scaled, {day}) OVER w, 0) AS lag_day,
  coalesce(lag(load_scaled, {week}) OVER w, 0) AS lag_week,
  avg(load_scaled) OVER r AS rolling_mean, coalesce(stddev_samp(load_scaled) OVER r, 0) AS rolling_std
  FROM scaled WINDOW w AS (PARTITION BY customer_id ORDER BY datetime),
    r AS (PARTITION BY customer_id ORDER BY datetime ROWS BETWEEN {rolled - 1} PRECEDING AND CURRENT ROW)),
done AS (SELECT *, CASE WHEN rn = 1 THEN next_load ELSE coalesce(next_load, load_val) END AS target_load,
  CASE WHEN rn = 1 THEN next_scaled ELSE coalesce(next_scaled, load_scaled) END AS target_scaled
  FROM nexts)"""


SQL_SCALED = f"{V.SQL_METER}, {SQL_BOUNDS},\n{_sql_scaled('meter', SQL_SLOT, 48, 336, 12)}"
_common = """customer_id, datetime, round(load_val, 6) AS load_val, round(load_scaled, 6) AS load_scaled,
  step_of_day, day_of_week, month, is_weekend"""
_targets = "round(target_load, 6) AS target_load, round(target_scaled, 6) AS target_scaled"
def _sql_unified(scaled: str, steps: int) -> str:
    return f"""WITH {scaled} SELECT {_common}, {_sql_step_cyc(steps)},
  round(lag_1, 6) AS lag_1, round(lag_2, 6) AS lag_2, round(lag_day, 6) AS lag_day,
  round(lag_week, 6) AS lag_week, round(rolling_mean::FLOAT::DOUBLE, 6) AS rolling_mean,
  round(rolling_std::FLOAT::DOUBLE, 6) AS rolling_std, {_targets}
FROM done WHERE target_load IS NOT NULL AND load_val IS NOT NULL"""


SQL_UNIFIED = _sql_unified(SQL_SCALED, 48)


def _meter_bounds(raw, series):
    return clean.fetch_bounds(clean.scaler_bounds(raw, "load_val", at_most=series.total))


def _unified(raw, series):
    series = series.measured(raw)
    out = recipes.unified_features(
        raw, series, "load_val", HALF_HOURLY, _meter_bounds(raw, series), tiebreak="seq"
    )
    out = out.withColumns({c: F.col(c).cast("float").cast("double") for c in UNIFIED_ROLLED})
    return out.withColumns({c: half_away(c, 6) for c in ROUNDED_UNIFIED})


@query("unified_features", SQL_UNIFIED)
def unified_features(spark, d):
    return _unified(V.meter_raw(spark, d), V.METER)


@query("unified_features_cut", SQL_UNIFIED)
def unified_features_cut(spark, d):
    return _unified(V.meter_raw(spark, d), CUT_METER)


SQL_NUMBERED = f"""{V.SQL_REGION_HOURLY},
numbered AS (SELECT dense_rank() OVER (ORDER BY region)::INTEGER AS customer_id, ts, load_mw AS load_val
  FROM region_hourly),
bounds AS (SELECT 0.0::DOUBLE AS lo, quantile_cont(greatest(load_val, 0), 0.999) AS hi FROM numbered
  WHERE load_val IS NOT NULL)"""


@query(
    "unified_regions",
    _sql_unified(f"{SQL_NUMBERED},\n{_sql_scaled('numbered', 'hour(ts)::INTEGER', 24, 168, 24)}", 24),
)
def unified_regions(spark, d):
    """The hourly form: numbered regions, bounds over all of them, lags by row."""
    rows = with_region_ids(V.region_hourly(spark, d))
    series = V.Series.of("customer_id", "ts").measured(rows)
    bounds = clean.scaler_bounds(rows, "load_mw", fallback=None, at_most=series.total)
    out = recipes.unified_features(rows, series, "load_mw", HOURLY, clean.fetch_bounds(bounds))
    out = out.withColumns({c: F.col(c).cast("float").cast("double") for c in UNIFIED_ROLLED})
    return out.withColumns({c: half_away(c, 6) for c in ROUNDED_UNIFIED})


@query(
    "simple_features",
    f"WITH {SQL_SCALED} SELECT {_common}, {SQL_STEP_CYC}, {_targets} FROM done "
    "WHERE target_load IS NOT NULL AND load_val IS NOT NULL",
)
def simple_features(spark, d):
    raw = V.meter_raw(spark, d)
    series = V.METER.measured(raw)
    out = recipes.simple_features(
        raw, series, "load_val", HALF_HOURLY, _meter_bounds(raw, series), tiebreak="seq"
    )
    return out.withColumns({c: half_away(c, 6) for c in ROUNDED_SIMPLE})


_clipped = ", ".join(f"CASE WHEN {c} IS NULL THEN NULL ELSE greatest({c}, 0) END AS {c}" for c in KWH)
_caps = ", ".join(f"quantile_cont({c}, 0.999) AS cap_{c}" for c in KWH)
_cut = ", ".join(
    f"CASE WHEN {c} IS NULL THEN NULL WHEN cap_{c} > 0 THEN least({c}, cap_{c}) ELSE {c} END AS {c}"
    for c in KWH
)
_out = ", ".join(f"round({c}, 6) AS {c}" for c in KWH)


@query(
    "meter_clean",
    f"""WITH {V.SQL_METER_WIDE}, firsts AS (SELECT * FROM meter_wide WHERE ts IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY customer_id, ts ORDER BY seq) = 1),
clipped AS (SELECT customer_id, ts, {_clipped} FROM firsts),
caps AS (SELECT {_caps} FROM clipped),
cut AS (SELECT customer_id, ts, {_cut} FROM clipped, caps)
SELECT customer_id, ts, {_out},
  round({' + '.join(f'coalesce({c}, 0)' for c in KWH)}, 6) AS total_kwh,
  hour(ts)::INTEGER AS hour, (isodow(ts) - 1)::INTEGER AS dayofweek, month(ts)::INTEGER AS month,
  year(ts)::INTEGER AS year, (isodow(ts) >= 6)::INTEGER AS is_weekend,
  {_sql_cyc('hour(ts)', 24, 'hour')}, {_sql_cyc('month(ts)', 12, 'month')}
FROM cut""",
)
def meter_clean(spark, d):
    out = recipes.meter_clean(V.meter_wide(spark, d), "customer_id", "ts", "seq", KWH)
    out = out.withColumnRenamed("TOTAL_KWH", "total_kwh")
    names = [*KWH, "total_kwh", "hour_sin", "hour_cos", "month_sin", "month_cos"]
    return out.withColumns({c: half_away(c, 6) for c in names})
