"""Streaming queries, run to the end of the stored events."""

from __future__ import annotations


from kilospan.functions.clock import floor_to_step
from kilospan.operators.clean import Bounds
from kilospan.queries import query
from kilospan.queries import views as V
from kilospan.queries.views import rounded
from kilospan.schema import HALF_HOURLY
from kilospan.sources.tables import scratch
from kilospan.streaming import flows

DELAY = "1 hour"


def _events(spark, d):
    # A file source lists a folder, so the table is named by a pattern.
    schema = V.table(spark, d, "events").schema
    return flows.read_stream(spark, f"{d}/events*.parquet", schema)


def _finished(spark, stream):
    target = scratch(spark, "stream")
    flows.run_available(stream, target, scratch(spark, "progress"))
    return spark.read.schema(stream.schema).parquet(target)


# Windows the watermark has closed by the end of the stream (it counts milliseconds).
SQL_CLOSED = "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM events)"


@query(
    "stream_clean",
    """SELECT event_id, ts, CASE WHEN value IS NOT NULL THEN least(greatest(value, 0), 400) END AS value,
  round(CASE WHEN value IS NOT NULL THEN least(greatest(value, 0), 400) / 400 END, 6) AS value_scaled,
  ((hour(ts) * 60 + minute(ts)) // 30)::INTEGER AS step_of_day FROM events WHERE ts IS NOT NULL""",
)
def stream_clean(spark, d):
    rows = _events(spark, d).select("event_id", "ts", "value")
    out = flows.clean_scaled(rows, "ts", "value", Bounds(0.0, 400.0), HALF_HOURLY)
    out = out.select("event_id", "ts", "value", "value_scaled", "step_of_day")
    return rounded(_finished(spark, out), "value_scaled")


@query(
    "stream_dedupe",
    """WITH hourly AS (SELECT user_id, date_trunc('hour', ts) AS ts, event_id, value FROM events)
SELECT * FROM hourly
QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) = 1""",
)
def stream_dedupe(spark, d):
    hourly = _events(spark, d).select(
        "user_id", floor_to_step("ts", 60).alias("ts"), "event_id", "value"
    )
    table = flows.FirstReadings(scratch(spark, "first"), hourly.schema, ["user_id", "ts"], "event_id")
    flows.run_first_readings(hourly, table, scratch(spark, "progress"))
    return table.read(spark)


SQL_STEPS = f"""steps AS (SELECT event_type, time_bucket(INTERVAL '30 minutes', ts) AS ts,
  round(sum(value), 6) AS load, count(*) AS n_readings FROM events GROUP BY 1, 2),
closed AS (SELECT * FROM steps WHERE ts + INTERVAL 30 MINUTE <= {SQL_CLOSED})"""


@query("stream_window_load", f"WITH {SQL_STEPS} SELECT * FROM closed")
def stream_window_load(spark, d):
    out = flows.window_load(_events(spark, d), ["event_type"], "ts", "value", delay=DELAY)
    return rounded(_finished(spark, out), "load")


@query("stream_alerts", f"WITH {SQL_STEPS} SELECT * FROM closed WHERE load >= 300")
def stream_alerts(spark, d):
    load = flows.window_load(_events(spark, d), ["event_type"], "ts", "value", delay=DELAY)
    return rounded(_finished(spark, flows.alerts(load, 300.0)), "load")


@query(
    "stream_sliding_stats",
    f"""WITH spread AS (SELECT event_type, value,
    unnest(generate_series(time_bucket(INTERVAL '30 minutes', ts) - INTERVAL 330 MINUTE,
      time_bucket(INTERVAL '30 minutes', ts), INTERVAL 30 MINUTE)) AS window_start FROM events)
SELECT event_type, window_start, window_start + INTERVAL 6 HOUR AS window_end,
  round(avg(value), 6) AS mean, round(coalesce(stddev_samp(value), 0), 6) AS std,
  count(*) AS n_readings
FROM spread WHERE window_start + INTERVAL 6 HOUR <= {SQL_CLOSED} GROUP BY 1, 2""",
)
def stream_sliding_stats(spark, d):
    out = flows.sliding_stats(_events(spark, d), ["event_type"], "ts", "value", delay=DELAY)
    return rounded(_finished(spark, out), "mean", "std")
