"""Ranks over a whole table, without one task holding all of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilospan.plans.sizes import LOCAL_ROWS, checkpointed, left_lookup, settle


def global_rank(
    df: DataFrame, order: list[Column], name: str = "rank", max_rows: int = LOCAL_ROWS
) -> DataFrame:
    """SQL ``rank`` by ``order``. A table beyond ``max_rows`` is range partitioned and
    each range ranks its own rows, starting after the rows of the ranges before it."""
    table, small = settle(df, max_rows)
    if small:
        return table.withColumn(name, F.rank().over(Window.orderBy(*order)))
    ranges = checkpointed(df.repartitionByRange(*order))
    ranges = ranges.withColumn("__range", F.spark_partition_id())
    counts = ranges.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "__range", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start")
    )
    within = F.rank().over(Window.partitionBy("__range").orderBy(*order))
    return (
        left_lookup(ranges, starts, ["__range"])
        .withColumn(name, (F.col("__start") + within).cast("int"))
        .drop("__range", "__start")
    )
