"""Lookup joins, and tables that are computed once."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCAL_ROWS = 100_000


def checkpoint_folder(spark) -> str:
    """The shared folder the cluster names; a scratch one only on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="kilospan-")
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage through reliable storage, so a lost executor costs no recompute."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_folder(spark))
    return df.checkpoint()


def settle(df: DataFrame, max_rows: int = LOCAL_ROWS) -> tuple[DataFrame, bool]:
    """Compute an aggregate once and report whether it is small.

    Up to ``max_rows`` rows come back as a literal table that is safe to
    broadcast. A larger result is checkpointed and must be joined by key.
    """
    if getattr(df, "settled_rows", None) is not None:
        return df, True
    if getattr(df, "settled_large", False):
        return df, False
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        table = checkpointed(df)
        table.settled_large = True
        return table, False
    table = df.sparkSession.createDataFrame(rows, schema=df.schema)
    table.settled_rows = rows
    return table, True


def match(df: DataFrame, table: DataFrame, on: list[str]) -> Column:
    """Equality of the named columns in which NULL equals NULL; no names match all."""
    cond = F.lit(True)
    for c in on:
        cond = cond & df[c].eqNullSafe(table[f"__on_{c}"])
    return cond


def left_lookup(df: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """Add the columns of a keyed ``table`` to every row of ``df``; NULL keys match.

    An ordinary equi-join: adaptive execution broadcasts a table that turns out small and
    splits hot keys where it is not.
    """
    table = table.withColumnsRenamed({c: f"__on_{c}" for c in on})
    joined = df.join(table, match(df, table, on), "left")
    return joined.drop(*[f"__on_{c}" for c in on])


def keep_keys(df: DataFrame, keys_table: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is in ``keys_table``."""
    return df.join(keys_table.select(*on), on, "left_semi")
