"""Wall-clock arithmetic on TIMESTAMP_NTZ that never consults the session zone.

Arguments are column names or SQL text: one parsed expression costs the driver far
less than a dozen chained column calls.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def sql_name(c: str) -> str:
    """A column name quoted where it needs to be; other SQL text as it is."""
    if c.isidentifier() or any(s in c for s in "()`"):
        return c
    return f"`{c}`"


def epoch_seconds_sql(ts: str) -> str:
    ts = sql_name(ts)
    return (
        f"(unix_date(to_date({ts})) * 86400L + hour({ts}) * 3600 + minute({ts}) * 60 + second({ts}))"
    )


def epoch_seconds(ts: str) -> Column:
    """Whole seconds since 1970-01-01 on the reading's own clock."""
    return F.expr(epoch_seconds_sql(ts))


def epoch_micros(ts: str) -> Column:
    ts = sql_name(ts)
    return F.expr(
        f"unix_date(to_date({ts})) * {MICROS_PER_DAY}L + (hour({ts}) * 60 + minute({ts})) * 60000000L"
        f" + cast(extract(SECOND FROM {ts}) * 1000000 AS bigint)"
    )


def step_of_day_sql(ts: str, step_minutes: int) -> str:
    ts = sql_name(ts)
    return f"cast((hour({ts}) * 60 + minute({ts})) div {int(step_minutes)} AS int)"


def step_of_day(ts: str, step_minutes: int) -> Column:
    """Slot number within the day, 0-based."""
    return F.expr(step_of_day_sql(ts, step_minutes))


def floor_to_step(ts: str, step_minutes: int) -> Column:
    """Start of the step a reading falls in."""
    seconds = f"{step_of_day_sql(ts, step_minutes)} * {step_minutes * 60}"
    return plus_seconds(f"cast(to_date({sql_name(ts)}) AS timestamp_ntz)", seconds)


def plus_seconds(ts: str, seconds: str | int) -> Column:
    return F.expr(f"timestampadd(SECOND, {seconds}, {sql_name(ts)})")
