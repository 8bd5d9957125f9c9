"""Calendar, cyclical and one-hot expressions over column names or SQL text."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from kilospan.functions.clock import sql_name, step_of_day_sql


def day_of_week(ts: str) -> Column:
    """Monday is 0."""
    return F.expr(f"weekday({sql_name(ts)})")


def is_weekend(ts: str) -> Column:
    return F.expr(f"cast(weekday({sql_name(ts)}) >= 5 AS int)")


def cyclical(value: str, period: int, name: str) -> dict[str, Column]:
    angle = f"{sql_name(value)} * {2 * math.pi!r}D / {int(period)}"
    return {f"{name}_sin": F.expr(f"sin({angle})"), f"{name}_cos": F.expr(f"cos({angle})")}


def calendar_long(ts: str) -> dict[str, Column]:
    """The regional calendar set: hour to weekend flag."""
    parts = ("hour", "month", "year", "dayofyear", "quarter")
    named = {p: F.expr(f"{p}({sql_name(ts)})") for p in parts}
    return {
        "hour": named["hour"],
        "dayofweek": day_of_week(ts),
        "month": named["month"],
        "year": named["year"],
        "dayofyear": named["dayofyear"],
        "quarter": named["quarter"],
        "is_weekend": is_weekend(ts),
    }


def calendar_short(ts: str, step_minutes: int) -> dict[str, Column]:
    """The unified calendar set: slot, weekday, month, weekend flag."""
    return {
        "step_of_day": F.expr(step_of_day_sql(ts, step_minutes)),
        "day_of_week": day_of_week(ts),
        "month": F.expr(f"month({sql_name(ts)})"),
        "is_weekend": is_weekend(ts),
    }


def _one_hot_sql(index: str, size: int, element: str) -> str:
    return f"transform(sequence(0, {size - 1}), i -> cast(i = {index} AS {element}))"


def one_hot(index: str, size: int, element: str = "float") -> Column:
    return F.expr(_one_hot_sql(sql_name(index), size, element))


def basic_vector(value: str, ts: str, step_minutes: int, element: str = "float") -> Column:
    """value, one-hot slot, one-hot weekday, weekend flag in one array."""
    day = sql_name(ts)
    slots = _one_hot_sql(step_of_day_sql(ts, step_minutes), 1440 // step_minutes, element)
    days = _one_hot_sql(f"weekday({day})", 7, element)
    return F.expr(
        f"concat(array(cast({sql_name(value)} AS {element})), {slots}, {days}, "
        f"array(cast(weekday({day}) >= 5 AS {element})))"
    )
