"""Bringing several regional sources into one table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilospan.plans.ranks import global_rank
from kilospan.plans.sizes import left_lookup


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def with_region_ids(df: DataFrame, region: str = "region", name: str = "customer_id") -> DataFrame:
    """Number the regions from 1 in name order."""
    ids = global_rank(df.select(region).distinct(), [F.col(region).asc()], name)
    return left_lookup(df, ids, [region])


def wide_to_long(df: DataFrame, ids: list[str], key: str = "region", value: str = "load_val"):
    """One column per region to one row per reading; empty cells are dropped."""
    values = [c for c in df.columns if c not in ids]
    return df.unpivot(ids, values, key, value).where(F.col(value).isNotNull())
