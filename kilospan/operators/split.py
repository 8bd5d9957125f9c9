"""Chronological splits. Every row lands in exactly one part."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kilospan.plans.series import Series


def split_at(df: DataFrame, ts: str, date: str, name: str = "split") -> DataFrame:
    edge = F.to_date(F.lit(date)).cast("timestamp_ntz")
    return df.withColumn(name, F.when(F.col(ts) < edge, "train").otherwise("test"))


def split_by_fraction(
    df: DataFrame, series: Series, train: float = 0.70, upto_val: float = 0.85, name: str = "split"
) -> DataFrame:
    """First ``train`` of each series, then validation up to ``upto_val``, then test."""
    placed = series.positions(df, "__pos", "__n")
    n = F.col("__n")
    part = (
        F.when(F.col("__pos") <= F.floor(F.lit(train) * n), "train")
        .when(F.col("__pos") <= F.floor(F.lit(upto_val) * n), "val")
        .otherwise("test")
    )
    return placed.withColumn(name, part).drop("__pos", "__n")


def split_by_calendar(
    df: DataFrame, ts: str, ranges: dict[str, tuple[str, str]], name: str = "split"
) -> DataFrame:
    """Inclusive date ranges by part; rows outside all of them are dropped."""
    part = F.lit(None).cast("string")
    for label, (start, end) in reversed(ranges.items()):
        first = F.to_date(F.lit(start)).cast("timestamp_ntz")
        past = F.date_add(F.to_date(F.lit(end)), 1).cast("timestamp_ntz")
        part = F.when((F.col(ts) >= first) & (F.col(ts) < past), label).otherwise(part)
    return df.withColumn(name, part).where(F.col(name).isNotNull())


def split_report(df: DataFrame, keys, ts: str, split: str = "split") -> DataFrame:
    """Rows, share and time range of each part of each series."""
    parts = df.groupBy(*keys, split).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )
    # one row per series and part: the window sees a handful of rows per key
    whole = F.sum("n_rows").over(Window.partitionBy(*keys))
    return parts.withColumn("share", F.col("n_rows") / whole)
