"""Ordered feature columns: lags, rolling statistics, targets, same-slot history.

The ``*_columns`` builders take a window and return named columns, so several of
them share one exchange and one sort inside a single ``Series.over`` call.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilospan.functions.clock import sql_name
from kilospan.plans.series import CARRY, FIRST, Along, Series


def lag_columns(value: str, lags: dict[str, int], w: Along, fill=None) -> dict[str, Column]:
    x = sql_name(value)
    out = {name: w.sql(f"lag({x}, {int(n)})") for name, n in lags.items()}
    if fill is not None:
        out = {name: f"coalesce({c}, {float(fill)!r}D)" for name, c in out.items()}
    return {name: F.expr(c) for name, c in out.items()}


def rolling_columns(
    value: str, rows: int, w: Along, names: tuple[str, str], partial: bool
) -> dict[str, Column]:
    """Mean and sample deviation of the last ``rows`` rows.

    Full windows only, unless ``partial``: then short ones count too and a
    deviation of a single value is 0.
    """
    x = sql_name(value)
    mean, dev = (w.sql(f"{f}({x})", 1 - rows) for f in ("avg", "stddev_samp"))
    if partial:
        return {n: F.expr(f"coalesce({c}, 0D)") for n, c in zip(names, (mean, dev))}
    full = f"{w.sql(f'count({x})', 1 - rows)} = {rows}"
    return {n: F.expr(f"CASE WHEN {full} THEN {c} END") for n, c in zip(names, (mean, dev))}


def past_columns(value: str, rows: int, w: Along, names: tuple[str, str]) -> dict[str, Column]:
    """Mean and deviation of up to ``rows`` rows before this one; none gives 0."""
    x = sql_name(value)
    stats = (w.sql(f"{f}({x})", -rows, -1) for f in ("avg", "stddev_samp"))
    return {n: F.expr(f"coalesce({c}, 0D)") for n, c in zip(names, stats)}


def next_columns(ts: str, values: dict[str, str], w: Along) -> dict[str, Column]:
    """The next row's value, the last row repeating its own, for values never NULL."""
    inner = f"{w.sql(f'lag({sql_name(ts)})')} IS NOT NULL"
    out = {}
    for name, v in values.items():
        x = sql_name(v)
        after = w.sql(f"lead({x})")
        out[name] = F.expr(f"coalesce({after}, CASE WHEN {inner} THEN {x} END)")
    return out


def lags(df: DataFrame, series: Series, value: str, steps: dict[str, int], fill=None) -> DataFrame:
    return series.over(
        df,
        lambda d, w: d.withColumns(lag_columns(value, steps, w, fill)),
        before=max(steps.values()),
    )


def rolling(
    df: DataFrame, series: Series, value: str, rows: int, names=("rolling_mean", "rolling_std"),
    partial: bool = False,
) -> DataFrame:
    return series.over(
        df,
        lambda d, w: d.withColumns(rolling_columns(value, rows, w, names, partial)),
        before=rows - 1,
    )


def past_stats(df: DataFrame, series: Series, value: str, rows: int, names=("past_mean", "past_std")):
    return series.over(
        df, lambda d, w: d.withColumns(past_columns(value, rows, w, names)), before=rows
    )


def same_slot_stats(
    df: DataFrame, series: Series, slot: str, value: str, days: int,
    names=("slot_mean", "slot_std"),
) -> DataFrame:
    """Mean and deviation of up to ``days`` earlier rows in the same slot of the day."""
    largest = series.measured(df).largest
    by_slot = replace(series, keys=(*series.keys, slot), step_seconds=None, largest=largest)
    if by_slot.cut:
        by_slot = replace(by_slot, largest=None)
    return past_stats(df, by_slot, value, days, names)


def lead_target(df: DataFrame, series: Series, value: str, name: str = "target") -> DataFrame:
    """Next row's value; where that is missing, the last one known (the first row of
    a series never serves as its own target)."""

    def compute(d: DataFrame, along: Along) -> DataFrame:
        w = along.spec
        d = d.withColumn("__prev", F.lag(series.ts).over(w))
        head = F.col("__prev").isNull() & (
            F.col(FIRST).isNull() | (F.col(series.ts) == F.col(FIRST))
        )
        later = F.when(~head, F.col(value))
        d = d.withColumn("__later", later)
        seen = F.last("__later", ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, 0)
        )
        known = F.when(F.col(CARRY)["ts"] != F.col(FIRST), F.col(CARRY)["x"])
        return d.withColumn(
            name, F.coalesce(F.lead("__later").over(w), seen, known)
        ).drop("__prev", "__later")

    return series.over(df, compute, before=1, after=1, carry=F.col(value))
