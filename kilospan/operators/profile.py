"""Row counts, quality figures and summaries of raw and prepared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilospan.plans.quantiles import exact_quantiles
from kilospan.plans.sizes import left_lookup


def reading_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_readings"))


def series_range(df: DataFrame, keys, ts: str, value: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
    )


def quality_profile(df: DataFrame, keys, ts: str, values) -> DataFrame:
    """One row: shape, missing cells per column, duplicate readings, time range."""
    first_copy = df.groupBy(*keys, ts).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count_if(F.col(v).isNull()).alias(f"null_{v}") for v in values],
    )
    return first_copy.agg(
        F.sum("__n").alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        (F.sum("__n") - F.count(F.lit(1))).alias("n_duplicates"),
        F.sum(F.when(F.col(ts).isNull(), F.col("__n")).otherwise(0)).alias("null_ts"),
        *[F.sum(f"null_{v}").alias(f"null_{v}") for v in values],
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
    )


def describe(df: DataFrame, value: str, by=(), superset: DataFrame | None = None) -> DataFrame:
    """count, mean, std, min, quartiles and max, all exact. ``superset`` as in
    :func:`exact_quantiles`."""
    by = list(by)
    row = [
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ]
    quartiles = exact_quantiles(df, {"__q": F.col(value)}, [0.25, 0.5, 0.75], by, superset=superset)
    if by:
        joined = left_lookup(df.groupBy(*by).agg(*row), quartiles, by)
        q = F.col("__q")
    else:
        found = quartiles.first()["__q"] or [None] * 3
        joined = df.agg(*row)
        q = F.array(*[F.lit(v).cast("double") for v in found])
    return joined.select(
        *by, "count", "mean", "std", "min",
        q[0].alias("p25"), q[1].alias("p50"), q[2].alias("p75"), "max",
    )


def rows_removed(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows in, out and removed of a cleaning step, counted in one plan."""
    marks = before.select(F.lit(1).alias("i"), F.lit(0).alias("o")).union(
        after.select(F.lit(0), F.lit(1))
    )
    return marks.agg(
        F.coalesce(F.sum("i"), F.lit(0)).alias("rows_in"),
        F.coalesce(F.sum("o"), F.lit(0)).alias("rows_out"),
        F.coalesce(F.sum("i") - F.sum("o"), F.lit(0)).alias("rows_removed"),
    )
