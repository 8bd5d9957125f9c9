"""Scans, cleaning, resampling, profiling and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kilospan.functions import scalars as S
from kilospan.operators import clean, profile, resample, samples, sets
from kilospan.plans.quantiles import exact_quantiles
from kilospan.plans.recipes import prep_report
from kilospan.queries import query
from kilospan.queries import views as V
from kilospan.queries.views import rounded
from kilospan.schema import HOURLY
from kilospan.sources.tables import convert_csv, entity_series

# -- scans ---------------------------------------------------------------------


@query("scan_project", "SELECT user_id, ts, value FROM events")
def scan_project(spark, d):
    return V.table(spark, d, "events").select("user_id", "ts", "value")


@query(
    "entity_series",
    """SELECT user_id, ts, event_id, value FROM events WHERE user_id = (
  SELECT user_id FROM events GROUP BY 1 ORDER BY count(*) DESC, user_id LIMIT 1)""",
)
def entity_series_query(spark, d):
    events = V.table(spark, d, "events").select("user_id", "ts", "event_id", "value")
    busiest = samples.top_entities(events, "user_id", 1).first()["user_id"]
    return entity_series(events, "user_id", "ts", busiest)


@query(
    "profile_table",
    """SELECT count(value) AS n_rows, 6 AS n_columns, round(avg(value), 6) AS mean,
  round(stddev_samp(value), 6) AS std, min(value) AS min,
  round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
  round(quantile_cont(value, 0.75), 6) AS p75, max(value) AS max
FROM events""",
)
def profile_table(spark, d):
    events = V.table(spark, d, "events")
    out = profile.describe(events, "value", superset=events).withColumnRenamed("count", "n_rows")
    out = out.withColumn("n_columns", F.lit(len(events.columns)))
    return rounded(out, "mean", "std", "p25", "p50", "p75")


@query(
    "wide_to_long",
    f"WITH {V.SQL_REGION_HOURLY} SELECT ts, region, round(load_mw, 6) AS load_val FROM region_hourly "
    "WHERE load_mw IS NOT NULL",
)
def wide_to_long(spark, d):
    hourly = V.region_hourly(spark, d)
    regions = sorted(r[0] for r in hourly.select("region").distinct().collect() if r[0] is not None)
    wide = hourly.groupBy("ts").pivot("region", regions).agg(F.first("load_mw"))
    return rounded(sets.wide_to_long(wide, ["ts"]), "load_val")


@query("csv_to_parquet", "SELECT * FROM events")
def csv_to_parquet(spark, d):
    return convert_csv(V.table(spark, d, "events"))


# -- cleaning ------------------------------------------------------------------


@query(
    "parse_lenient",
    f"""WITH {V.SQL_METER_TEXT} SELECT customer_id, TRY_CAST(ts AS TIMESTAMP) AS ts, load_val, seq
FROM meter_text WHERE TRY_CAST(ts AS TIMESTAMP) IS NOT NULL""",
)
def parse_lenient(spark, d):
    return clean.parse_timestamps(V.meter_text(spark, d), "ts")


@query("dedupe_keep_first", f"WITH {V.SQL_METER} SELECT * FROM meter")
def dedupe_keep_first(spark, d):
    return V.meter(spark, d)


@query(
    "clip_negative",
    f"WITH {V.SQL_METER_RAW} SELECT customer_id, ts, CASE WHEN load_val IS NOT NULL THEN greatest(load_val, 0) END AS load_val, seq FROM meter_raw",
)
def clip_negative(spark, d):
    return clean.clip_columns(V.meter_raw(spark, d), ["load_val"], lower=0.0)


KWH = list(V.KWH_OF_EVENT)
_caps = ", ".join(f"quantile_cont({c}, 0.999) AS cap_{c}" for c in KWH)
_capped = ", ".join(
    f"round(CASE WHEN {c} IS NULL THEN NULL WHEN cap_{c} > 0 THEN least({c}, cap_{c}) ELSE {c} END, 6) AS {c}"
    for c in KWH
)


@query(
    "cap_p999",
    f"WITH {V.SQL_METER_WIDE}, caps AS (SELECT {_caps} FROM meter_wide) "
    f"SELECT customer_id, ts, seq, {_capped} FROM meter_wide, caps",
)
def cap_p999(spark, d):
    wide = V.meter_wide(spark, d)
    return rounded(clean.cap_columns(wide, clean.quantile_caps(wide, KWH, superset=wide)), *KWH)


@query(
    "clip_bounds",
    f"WITH {V.SQL_METER_RAW} SELECT customer_id, ts, CASE WHEN load_val IS NOT NULL THEN least(greatest(load_val, 0), 100) END AS load_val, seq FROM meter_raw",
)
def clip_bounds(spark, d):
    return clean.clip_columns(V.meter_raw(spark, d), ["load_val"], 0.0, 100.0)


SQL_BOUNDS = """bounds AS (
  SELECT 0.0::DOUBLE AS lo, CASE WHEN m <= 0 THEN 10.0 ELSE m END AS hi
  FROM (SELECT quantile_cont(greatest(load_val, 0), 0.999) AS m FROM meter_raw WHERE load_val IS NOT NULL))"""


@query(
    "scaler_bounds",
    f"WITH {V.SQL_METER_RAW}, {SQL_BOUNDS} SELECT lo AS min, round(hi, 6) AS max FROM bounds",
)
def scaler_bounds(spark, d):
    raw = V.meter_raw(spark, d)
    return rounded(clean.scaler_bounds(raw, "load_val", superset=raw), "max")


SQL_UNION = """regions AS (
  SELECT event_type AS region, date_trunc('day', ts) AS ts, sum(value) AS load_val
  FROM events GROUP BY 1, 2
  UNION ALL
  SELECT c_mktsegment, date_trunc('day', o_orderdate), sum(o_totalprice)
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


@query(
    "scaler_bounds_all",
    f"""WITH {SQL_UNION} SELECT 0.0::DOUBLE AS min,
  round(quantile_cont(greatest(load_val, 0), 0.999), 4) AS max FROM regions WHERE load_val IS NOT NULL""",
)
def scaler_bounds_all(spark, d):
    both = sets.union_all([V.region_daily(spark, d), V.segment_daily(spark, d)])
    return rounded(clean.scaler_bounds(both, "load_val", fallback=None), "max", places=4)


SQL_FENCES = """fences AS (
  SELECT region, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper
  FROM (SELECT region, quantile_cont(load_mw, 0.25) AS q1, quantile_cont(load_mw, 0.75) AS q3
        FROM filled GROUP BY 1))"""


@query(
    "iqr_clip",
    f"""WITH {V.SQL_FILLED}, {SQL_FENCES}
SELECT f.region, f.ts, round(least(greatest(load_mw, lower), upper), 6) AS load_mw
FROM filled f JOIN fences q ON f.region = q.region""",
)
def iqr_clip(spark, d):
    series = V.filled_series(spark, d)
    return rounded(clean.iqr_clip(V.region_filled(spark, d), series, "load_mw"), "load_mw")


@query(
    "iqr_outliers",
    f"""WITH {V.SQL_FILLED}, {SQL_FENCES}
SELECT f.region, sum((load_mw < lower OR load_mw > upper)::INTEGER)::BIGINT AS outliers,
  round(avg((load_mw < lower OR load_mw > upper)::INTEGER) * 100, 6) AS outlier_pct
FROM filled f JOIN fences q ON f.region = q.region GROUP BY 1""",
)
def iqr_outliers(spark, d):
    series = V.filled_series(spark, d)
    out = clean.iqr_outliers(V.region_filled(spark, d), series, "load_mw")
    return rounded(out, "outlier_pct")


@query(
    "minmax_scale",
    f"""WITH {V.SQL_METER_RAW}, {SQL_BOUNDS}
SELECT customer_id, ts, seq, round(CASE WHEN load_val IS NOT NULL THEN least(greatest(load_val, lo), hi) END, 6) AS load_val,
  round(CASE WHEN load_val IS NOT NULL THEN (least(greatest(load_val, lo), hi) - lo) / (hi - lo) END, 6) AS load_scaled
FROM meter_raw, bounds""",
)
def minmax_scale(spark, d):
    raw = V.meter_raw(spark, d)
    bounds = clean.fetch_bounds(clean.scaler_bounds(raw, "load_val", superset=raw))
    return rounded(
        clean.clip_and_scale(raw, "load_val", "load_scaled", bounds), "load_val", "load_scaled"
    )


@query(
    "minmax_scale_self",
    f"""WITH {V.SQL_METER}, ends AS (
  SELECT customer_id, min(load_val) AS lo, max(load_val) AS hi FROM meter GROUP BY 1)
SELECT m.customer_id, ts, load_val, seq,
  CASE WHEN hi > lo THEN round((load_val - lo) / (hi - lo), 6) ELSE 0.0 END AS load_scaled
FROM meter m JOIN ends e ON m.customer_id = e.customer_id""",
)
def minmax_scale_self(spark, d):
    rows, series = V.meter_first(spark, d)
    out = clean.scale_within(rows, series, "load_val", "load_scaled")
    return rounded(out, "load_scaled")


@query(
    "inverse_scale",
    f"""WITH {V.SQL_METER_RAW}
SELECT customer_id, ts, seq, round(CASE WHEN load_val IS NOT NULL THEN greatest(load_val / 490.0 * (2.929 - 0.5) + 0.5, 0) END, 6) AS load_kwh
FROM meter_raw""",
)
def inverse_scale(spark, d):
    raw = V.meter_raw(spark, d)
    back = S.unscale("(load_val / 490D)", 0.5, 2.929, floor=0.0)
    return rounded(raw.select("customer_id", "ts", "seq", back.alias("load_kwh")), "load_kwh")


@query(
    "total_kwh",
    f"""WITH {V.SQL_METER_WIDE}
SELECT customer_id, ts, seq, round({' + '.join(f'coalesce({c}, 0)' for c in KWH)}, 6) AS total_kwh
FROM meter_wide""",
)
def total_kwh(spark, d):
    wide = V.meter_wide(spark, d)
    return rounded(
        wide.select("customer_id", "ts", "seq", S.row_total(KWH).alias("total_kwh")), "total_kwh"
    )


@query(
    "kwh_to_kw",
    f"WITH {V.SQL_METER_RAW} SELECT customer_id, ts, seq, round(load_val * 2, 6) AS load_kw FROM meter_raw",
)
def kwh_to_kw(spark, d):
    kw = S.energy_to_power("load_val", 30)
    out = V.meter_raw(spark, d).select("customer_id", "ts", "seq", kw.alias("load_kw"))
    return rounded(out, "load_kw")


@query(
    "date_range",
    """SELECT event_id, ts, value FROM events
WHERE ts >= TIMESTAMP '2024-01-06' AND ts < TIMESTAMP '2024-01-21'""",
)
def date_range(spark, d):
    events = V.table(spark, d, "events").select("event_id", "ts", "value")
    return clean.between_dates(events, "ts", "2024-01-06", "2024-01-20")


@query(
    "min_history",
    f"""WITH {V.SQL_METER} SELECT * FROM meter
QUALIFY count(*) OVER (PARTITION BY customer_id) >= 65""",
)
def min_history(spark, d):
    rows, series = V.meter_first(spark, d)
    return clean.with_min_history(rows, series, 65)


# -- grids ---------------------------------------------------------------------


@query("grid_spine", f"WITH {V.SQL_REGION_HOURLY}, {V.SQL_SPINE} SELECT region, ts FROM spine")
def grid_spine(spark, d):
    return resample.grid_spine(V.region_hourly(spark, d), V.REGION, V.HOUR)


@query(
    "reindex_hourly",
    f"""WITH {V.SQL_REGION_HOURLY}, {V.SQL_SPINE}
SELECT s.region, s.ts, round(load_mw, 6) AS load_mw
FROM spine s LEFT JOIN region_hourly r ON s.region = r.region AND s.ts = r.ts""",
)
def reindex_hourly(spark, d):
    return rounded(resample.reindex(V.region_hourly(spark, d), V.REGION, V.HOUR), "load_mw")


@query(
    "missing_steps",
    f"""WITH {V.SQL_REGION_HOURLY}
SELECT region, (date_diff('hour', min(ts), max(ts)) + 1)::BIGINT AS expected_steps,
  (date_diff('hour', min(ts), max(ts)) + 1 - count(DISTINCT ts))::BIGINT AS missing_steps
FROM region_hourly GROUP BY 1""",
)
def missing_steps(spark, d):
    return resample.missing_steps(V.region_hourly(spark, d), V.REGION, V.HOUR)


SQL_INTERPOLATED = f"WITH {V.SQL_FILLED} SELECT region, ts, round(load_mw, 6) AS load_mw FROM filled"


@query("interpolate_time", SQL_INTERPOLATED)
def interpolate_time(spark, d):
    return rounded(V.region_filled(spark, d), "load_mw")


# -- profiles ------------------------------------------------------------------


@query(
    "quantiles",
    f"""WITH {V.SQL_METER_RAW} SELECT customer_id,
  round(quantile_cont(load_val, 0.25), 6) AS p25, round(quantile_cont(load_val, 0.5), 6) AS p50,
  round(quantile_cont(load_val, 0.75), 6) AS p75, round(quantile_cont(load_val, 0.999), 6) AS p999
FROM meter_raw GROUP BY 1""",
)
def quantiles(spark, d):
    raw = V.meter_raw(spark, d)
    got = exact_quantiles(
        raw, {"q": F.col("load_val")}, [0.25, 0.5, 0.75, 0.999], ["customer_id"], superset=raw
    )
    names = ["p25", "p50", "p75", "p999"]
    out = got.select("customer_id", *[F.col("q")[i].alias(n) for i, n in enumerate(names)])
    return rounded(out, *names)


@query(
    "quantiles_narrowed",
    """SELECT event_type, round(quantile_cont(value, 0.25), 6) AS p25,
  round(quantile_cont(value, 0.999), 6) AS p999 FROM events GROUP BY 1""",
)
def quantiles_narrowed(spark, d):
    """The distributed selection, forced by a low limit on rows."""
    events = V.table(spark, d, "events")
    got = exact_quantiles(
        events, {"q": F.col("value")}, [0.25, 0.999], ["event_type"], max_distinct=200,
        superset=events,
    )
    out = got.select("event_type", F.col("q")[0].alias("p25"), F.col("q")[1].alias("p999"))
    return rounded(out, "p25", "p999")


@query(
    "series_range",
    f"""WITH {V.SQL_METER_RAW} SELECT customer_id, min(load_val) AS min_value,
  max(load_val) AS max_value, min(ts) AS first_ts, max(ts) AS last_ts
FROM meter_raw GROUP BY 1""",
)
def series_range(spark, d):
    return profile.series_range(V.meter_raw(spark, d), ["customer_id"], "ts", "load_val")


@query(
    "reading_counts",
    f"WITH {V.SQL_METER_RAW} SELECT customer_id, count(*) AS n_readings FROM meter_raw GROUP BY 1",
)
def reading_counts(spark, d):
    return profile.reading_counts(V.meter_raw(spark, d), "customer_id")


_nulls = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in KWH)


@query(
    "quality_profile",
    f"""WITH {V.SQL_METER_WIDE} SELECT count(*) AS n_rows, 8 AS n_columns,
  count(*) - count(DISTINCT (customer_id, ts)) AS n_duplicates,
  count(*) FILTER (WHERE ts IS NULL) AS null_ts, {_nulls},
  min(ts) AS first_ts, max(ts) AS last_ts
FROM meter_wide""",
)
def quality_profile(spark, d):
    return profile.quality_profile(V.meter_wide(spark, d), ["customer_id"], "ts", KWH)


@query(
    "describe_load",
    f"""WITH {V.SQL_METER_RAW} SELECT customer_id, count(load_val) AS count,
  round(avg(load_val), 6) AS mean, round(stddev_samp(load_val), 6) AS std, min(load_val) AS min,
  round(quantile_cont(load_val, 0.25), 6) AS p25, round(quantile_cont(load_val, 0.5), 6) AS p50,
  round(quantile_cont(load_val, 0.75), 6) AS p75, max(load_val) AS max
FROM meter_raw GROUP BY 1""",
)
def describe_load(spark, d):
    raw = V.meter_raw(spark, d)
    out = profile.describe(raw, "load_val", ["customer_id"], superset=raw)
    return rounded(out, "mean", "std", "p25", "p50", "p75")


@query(
    "rows_removed",
    f"""WITH {V.SQL_METER_TEXT}, parsed AS (
  SELECT customer_id, TRY_CAST(ts AS TIMESTAMP) AS ts FROM meter_text)
SELECT count(*) AS rows_in,
  count(DISTINCT (customer_id, ts)) FILTER (WHERE ts IS NOT NULL) AS rows_out,
  count(*) - count(DISTINCT (customer_id, ts)) FILTER (WHERE ts IS NOT NULL) AS rows_removed
FROM parsed""",
)
def rows_removed(spark, d):
    text = V.meter_text(spark, d)
    parsed = clean.parse_timestamps(text, "ts")
    return profile.rows_removed(text, clean.keep_first(parsed, ["customer_id", "ts"], "seq"))


@query(
    "prep_report",
    f"""WITH {V.SQL_REGION_FIRST}, {V.SQL_SPINE}, {V.SQL_FILL}, {SQL_FENCES},
raw AS (SELECT event_type AS region, count(*) AS rows_in, count(*)
    - count(DISTINCT coalesce(date_trunc('hour', ts), TIMESTAMP '1900-01-01')) AS duplicates
  FROM events GROUP BY 1),
gaps AS (SELECT region, (date_diff('hour', min(ts), max(ts)) + 1 - count(*))::BIGINT AS missing_steps
  FROM region_hourly GROUP BY 1),
outs AS (SELECT f.region, sum((load_mw < lower OR load_mw > upper)::INTEGER)::BIGINT AS outliers,
    greatest(count(*) - 168, 0) AS rows_out
  FROM filled f JOIN fences q ON f.region = q.region GROUP BY 1)
SELECT raw.region, rows_in, duplicates, missing_steps, outliers, rows_out
FROM raw JOIN gaps ON raw.region = gaps.region JOIN outs ON raw.region = outs.region""",
)
def prep_report_query(spark, d):
    return prep_report(V.region_raw(spark, d), V.REGION, "load_mw", "seq", HOURLY)


# -- entities and sets -----------------------------------------------------------

SQL_TOP = """top AS (
  SELECT customer_id, count(*) AS n_readings FROM meter_raw
  GROUP BY 1 ORDER BY n_readings DESC, customer_id LIMIT 69)"""


@query("top_entities", f"WITH {V.SQL_METER_RAW}, {SQL_TOP} SELECT * FROM top")
def top_entities(spark, d):
    return samples.top_entities(V.meter_raw(spark, d), "customer_id", 69)


@query(
    "top_entities_series",
    f"""WITH {V.SQL_METER_RAW}, {SQL_TOP}
SELECT * FROM meter_raw WHERE customer_id IN (SELECT customer_id FROM top)""",
)
def top_entities_series(spark, d):
    return samples.only_top_entities(V.meter_raw(spark, d), "customer_id", 69)


@query(
    "union_regions",
    f"""WITH {SQL_UNION} SELECT region, ts, round(load_val, 4) AS load_val,
  dense_rank() OVER (ORDER BY region)::INTEGER AS customer_id FROM regions""",
)
def union_regions(spark, d):
    both = sets.union_all([V.region_daily(spark, d), V.segment_daily(spark, d)])
    return rounded(sets.with_region_ids(both), "load_val", places=4)
