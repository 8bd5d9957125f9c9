"""The test tables seen as meter and regional readings, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilospan.functions.clock import floor_to_step
from kilospan.functions.scalars import rounded as half_away
from kilospan.operators.clean import first_readings, keep_first
from kilospan.operators.forecast import naive_forecasts
from kilospan.operators.resample import interpolate
from kilospan.plans.series import Series
from kilospan.schema import HOURLY

REGION = Series.of("region", "ts")
METER = Series.of("customer_id", "ts")
HOUR = 3600

# The event types that stand for the five kWh columns.
KWH_OF_EVENT = {
    "general_supply": "click",
    "controlled_load": "view",
    "gross_generation": "purchase",
    "net_generation": "signup",
    "other": "error",
}


# Declared, so that opening a table costs no schema-inference job.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def region_hourly(spark, d) -> DataFrame:
    """Load per event type and hour; hours without events are gaps. A load has a time."""
    return (
        table(spark, d, "events")
        .dropna(subset=["ts"])
        .groupBy(F.col("event_type").alias("region"), floor_to_step("ts", 60).alias("ts"))
        .agg(F.sum("value").alias("load_mw"))
    )


def region_raw(spark, d) -> DataFrame:
    """Single events as hourly readings with repeats."""
    return table(spark, d, "events").select(
        F.col("event_type").alias("region"),
        floor_to_step("ts", 60).alias("ts"),
        F.col("value").alias("load_mw"),
        F.col("event_id").alias("seq"),
    )


def meter_raw(spark, d) -> DataFrame:
    """Half-hourly readings per user, with repeats and negative values."""
    return table(spark, d, "events").select(
        F.col("user_id").cast("int").alias("customer_id"),
        floor_to_step("ts", 30).alias("ts"),
        (F.col("value") - 10.0).alias("load_val"),
        F.col("event_id").alias("seq"),
    )


def meter(spark, d) -> DataFrame:
    return keep_first(meter_raw(spark, d).dropna(subset=["ts"]), ["customer_id", "ts"], "seq")


def meter_first(spark, d, series: Series = METER) -> tuple[DataFrame, Series]:
    """The same readings with their series, measured without a dedupe of its own."""
    return first_readings(meter_raw(spark, d), series, "seq")


def meter_wide(spark, d) -> DataFrame:
    events = table(spark, d, "events")
    return events.select(
        F.col("user_id").cast("int").alias("customer_id"),
        floor_to_step("ts", 30).alias("ts"),
        F.col("event_id").alias("seq"),
        *[
            F.when(F.col("event_type") == e, F.col("value") - 10.0).alias(c)
            for c, e in KWH_OF_EVENT.items()
        ],
    )


def meter_text(spark, d) -> DataFrame:
    """Readings whose time is text; error events carry text no parser accepts."""
    return table(spark, d, "events").select(
        F.col("user_id").cast("int").alias("customer_id"),
        F.when(F.col("event_type") == "error", F.lit("not a time"))
        .otherwise(F.col("ts").cast("string")).alias("ts"),
        F.col("value").alias("load_val"),
        F.col("event_id").alias("seq"),
    )


def region_filled(spark, d) -> DataFrame:
    return interpolate(region_hourly(spark, d), REGION, "load_mw", HOUR)


def filled_series(spark, d) -> Series:
    """The filled regional series with its length measured on the raw hours."""
    return REGION.measured_grid(region_hourly(spark, d), HOUR).on_grid(HOUR)


def predictions(spark, d) -> DataFrame:
    rows = region_hourly(spark, d)
    series = REGION.measured_grid(rows, HOUR)
    filled = interpolate(rows, series, "load_mw", HOUR)
    return naive_forecasts(filled, series.on_grid(HOUR), "load_mw", HOURLY)


def segment_daily(spark, d) -> DataFrame:
    """Order value per market segment and day: a second regional source."""
    orders, customer = table(spark, d, "orders"), table(spark, d, "customer")
    day = F.to_date("o_orderdate").cast("timestamp_ntz")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_mktsegment").alias("region"), day.alias("ts"))
        .agg(F.sum("o_totalprice").alias("load_val"))
    )


def region_daily(spark, d) -> DataFrame:
    day = F.to_date("ts").cast("timestamp_ntz")
    return (
        table(spark, d, "events")
        .groupBy(F.col("event_type").alias("region"), day.alias("ts"))
        .agg(F.sum("value").alias("load_val"))
    )


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: half_away(c, places) for c in columns})


# The same views in SQL.

SQL_REGION_HOURLY = """region_hourly AS (
  SELECT event_type AS region, date_trunc('hour', ts) AS ts, sum(value) AS load_mw
  FROM events WHERE ts IS NOT NULL GROUP BY 1, 2)"""

SQL_REGION_FIRST = """region_hourly AS (
  SELECT event_type AS region, date_trunc('hour', ts) AS ts, value AS load_mw
  FROM events WHERE ts IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY event_id) = 1)"""

SQL_SPINE = """ends AS (
  SELECT region, min(ts) AS lo, max(ts) AS hi FROM region_hourly GROUP BY 1),
spine AS (
  SELECT region, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM ends)"""

SQL_FILL = """joined AS (
  SELECT s.region, s.ts, r.load_mw
  FROM spine s LEFT JOIN region_hourly r ON s.region = r.region AND s.ts = r.ts),
marks AS (
  SELECT *, CASE WHEN load_mw IS NOT NULL THEN ts END AS known_ts FROM joined),
around AS (
  SELECT region, ts, load_mw,
    last_value(known_ts IGNORE NULLS) OVER b AS t0,
    last_value(load_mw IGNORE NULLS) OVER b AS x0,
    first_value(known_ts IGNORE NULLS) OVER a AS t1,
    first_value(load_mw IGNORE NULLS) OVER a AS x1
  FROM marks
  WINDOW b AS (PARTITION BY region ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         a AS (PARTITION BY region ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS (
  SELECT region, ts,
    CASE WHEN load_mw IS NOT NULL THEN load_mw
         WHEN x1 IS NULL THEN x0
         ELSE x0 + (x1 - x0) * date_diff('second', t0, ts) / date_diff('second', t0, t1)
    END AS load_mw
  FROM around)"""

SQL_FILLED = f"{SQL_REGION_HOURLY},\n{SQL_SPINE},\n{SQL_FILL}"

SQL_METER_RAW = """meter_raw AS (
  SELECT user_id::INTEGER AS customer_id, time_bucket(INTERVAL '30 minutes', ts) AS ts,
         value - 10.0 AS load_val, event_id AS seq
  FROM events)"""

SQL_METER = f"""{SQL_METER_RAW},
meter AS (
  SELECT * FROM meter_raw WHERE ts IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY customer_id, ts ORDER BY seq) = 1)"""

SQL_METER_WIDE = (
    "meter_wide AS (SELECT user_id::INTEGER AS customer_id, "
    "time_bucket(INTERVAL '30 minutes', ts) AS ts, event_id AS seq, "
    + ", ".join(
        f"CASE WHEN event_type = '{e}' THEN value - 10.0 END AS {c}"
        for c, e in KWH_OF_EVENT.items()
    )
    + " FROM events)"
)

SQL_METER_TEXT = """meter_text AS (
  SELECT user_id::INTEGER AS customer_id,
         CASE WHEN event_type = 'error' THEN 'not a time' ELSE ts::VARCHAR END AS ts,
         value AS load_val, event_id AS seq
  FROM events)"""

SQL_PREDICTIONS = f"""{SQL_FILLED},
lagged AS (
  SELECT region, ts, load_mw AS actual,
    lag(load_mw, 1) OVER w AS last_value,
    lag(load_mw, 24) OVER w AS same_slot_day,
    lag(load_mw, 168) OVER w AS same_slot_week,
    avg(load_mw) OVER (PARTITION BY region, hour(ts) ORDER BY ts
                       ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS slot_mean
  FROM filled WINDOW w AS (PARTITION BY region ORDER BY ts)),
predictions AS (
  SELECT region, ts, 'last_value' AS model, actual, last_value AS predicted FROM lagged
  UNION ALL SELECT region, ts, 'same_slot_day', actual, same_slot_day FROM lagged
  UNION ALL SELECT region, ts, 'same_slot_week', actual, same_slot_week FROM lagged
  UNION ALL SELECT region, ts, 'slot_mean', actual, slot_mean FROM lagged),
pred AS (SELECT * FROM predictions WHERE predicted IS NOT NULL AND actual IS NOT NULL)"""

SQL_ERRORS = """count(*) AS n,
  round(avg(abs(actual - predicted)), 4) AS mae,
  round(avg((actual - predicted) * (actual - predicted)), 4) AS mse,
  round(sqrt(avg((actual - predicted) * (actual - predicted))), 4) AS rmse,
  round(avg(abs(actual - predicted) / greatest(abs(actual), 1e-7)) * 100, 4) AS mape,
  round(1 - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(*)), 4) AS r2,
  count(*) FILTER (WHERE abs(actual) < 1e-7) AS n_clamped"""

SQL_RESULTS = f"""{SQL_PREDICTIONS},
results AS (SELECT region, model, {SQL_ERRORS} FROM pred GROUP BY ALL)"""
