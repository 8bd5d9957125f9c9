"""Regular grids: spine, gaps, gap filling and interpolation."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kilospan.functions.clock import epoch_seconds, epoch_seconds_sql, plus_seconds, sql_name
from kilospan.plans.series import Series
from kilospan.plans.sizes import left_lookup

RUN = 10_000


def grid_spine(df: DataFrame, series: Series, step_seconds: int) -> DataFrame:
    """Every step from the first to the last reading of each series."""
    ends = df.groupBy(*series.keys).agg(
        F.min(series.ts).alias("__lo"), F.max(series.ts).alias("__hi")
    )
    span = f"({epoch_seconds_sql('__hi')} - {epoch_seconds_sql('__lo')})"
    # In runs, so that no single array holds a long series.
    runs = ends.select(
        *series.keys, "__lo", F.expr(f"{span} div {step_seconds}").alias("__steps")
    ).withColumn("__run", F.expr(f"explode(sequence(0L, __steps div {RUN}))"))
    # A row per run is little to move; a long series is then expanded by many tasks.
    runs = runs.repartition(*series.keys, "__run")
    at = F.expr(f"sequence(__run * {RUN}, least((__run + 1) * {RUN} - 1, __steps))")
    return runs.select(*series.keys, "__lo", F.explode(at).alias("__i")).select(
        *series.keys, plus_seconds("__lo", f"__i * {step_seconds}").alias(series.ts)
    )


def reindex(df: DataFrame, series: Series, step_seconds: int) -> DataFrame:
    """Left join onto the grid: missing steps are NULL, off-grid rows drop out."""
    on = [*series.keys, series.ts]
    return grid_spine(df, series, step_seconds).join(df, on, "left")


def missing_steps(df: DataFrame, series: Series, step_seconds: int) -> DataFrame:
    """Grid steps without a reading, per series."""
    keys = list(series.keys)
    ends = df.groupBy(*keys).agg(
        F.min(series.ts).alias("__lo"), F.max(series.ts).alias("__hi")
    )
    at = left_lookup(df.select(*keys, series.ts), ends, keys)
    since = epoch_seconds(series.ts) - epoch_seconds("__lo")
    on_grid = F.when(since % step_seconds == 0, F.col(series.ts))
    span = epoch_seconds("__hi") - epoch_seconds("__lo")
    return (
        at.groupBy(*keys, "__lo", "__hi")
        .agg(F.count_distinct(on_grid).alias("__n"))
        .select(
            *keys,
            (F.floor(span / step_seconds) + 1).cast("bigint").alias("expected_steps"),
            (F.floor(span / step_seconds) + 1 - F.col("__n")).cast("bigint").alias("missing_steps"),
        )
    )


def interpolate(df: DataFrame, series: Series, value: str, step_seconds: int) -> DataFrame:
    """Fill the grid of each series, with straight lines in time between readings.

    No spine and no join: every known reading looks up the next known one and emits
    the steps between them. Steps before the first value stay NULL, steps after the
    last one repeat it. Result columns: keys, ts, value.
    """
    series = replace(series.measured_grid(df, step_seconds), step_seconds=None)
    keys, ts = list(series.keys), series.ts
    rows = df.select(*keys, ts, F.col(value).cast("double").alias(value))
    if series.cut:
        ends = rows.groupBy(*keys).agg(F.min(ts).alias("__first_ts"), F.max(ts).alias("__last_ts"))
        rows = left_lookup(rows, ends, keys)
        pairs = series.over(_known(rows, ts, value, step_seconds), _next_known(ts, value), after=1)
    else:
        w = series.along()
        whole = w.spec.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        rows = rows.withColumns(
            {"__first_ts": F.min(ts).over(whole), "__last_ts": F.max(ts).over(whole)}
        )
        pairs = _next_known(ts, value)(_known(rows, ts, value, step_seconds), w)

    t, v = sql_name(ts), sql_name(value)
    span = f"({epoch_seconds_sql('__last_ts')} - {epoch_seconds_sql('__first_ts')})"
    # The last grid step, for readings with none known after them.
    end = f"timestampadd(SECOND, -({span} % {step_seconds}), __last_ts)"
    last = f"coalesce(timestampadd(SECOND, -{step_seconds}, __nt), {end})"
    gap = F.expr(f"({epoch_seconds_sql('__nt')} - {epoch_seconds_sql(ts)}) / {step_seconds}")
    gaps = pairs.select(*keys, ts, value, "__nx", gap.alias("__gap"), F.expr(last).alias("__to"))
    n = f"({epoch_seconds_sql('__to')} - {epoch_seconds_sql(ts)}) div {step_seconds}"
    # In runs, so that no single array holds a long gap.
    runs = gaps.select(
        *keys, ts, value, "__nx", "__gap", F.expr(n).alias("__steps"),
    ).withColumn("__run", F.expr(f"explode(sequence(0L, __steps div {RUN}))"))
    at = F.expr(f"sequence(__run * {RUN}, least((__run + 1) * {RUN} - 1, __steps))")
    out = runs.select(*keys, ts, value, "__nx", "__gap", F.explode(at).alias("__i")).withColumn(
        "__g", plus_seconds(ts, f"__i * {step_seconds}")
    )
    filled = F.expr(
        f"CASE WHEN __i = 0 OR __nx IS NULL THEN {v} ELSE {v} + (__nx - {v}) * __i / __gap END"
    )
    return out.select(*keys, F.col("__g").alias("__at"), filled.alias(value)).withColumnRenamed(
        "__at", ts
    )


def _known(rows, ts: str, value: str, step_seconds: int) -> DataFrame:
    """On-grid readings that have a value; the first step is kept even without."""
    since = f"({epoch_seconds_sql(ts)} - {epoch_seconds_sql('__first_ts')})"
    return rows.where(
        f"{since} % {step_seconds} = 0 AND ({sql_name(value)} IS NOT NULL OR {sql_name(ts)} = __first_ts)"
    )


def _next_known(ts: str, value: str):
    return lambda d, w: d.withColumns(
        {"__nt": F.expr(w.sql(f"lead({sql_name(ts)})")),
         "__nx": F.expr(w.sql(f"lead({sql_name(value)})"))}
    )
