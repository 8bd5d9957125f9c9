"""Model samples: look-back windows as arrays, and their feature vectors."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilospan.functions.calendar import basic_vector
from kilospan.functions.clock import sql_name, step_of_day
from kilospan.operators.clean import between_dates, keep_first
from kilospan.operators.features import past_stats, same_slot_stats
from kilospan.operators.split import split_by_calendar
from kilospan.plans.series import Along, Series
from kilospan.plans.sizes import checkpointed, keep_keys

HISTORY_MARGIN = 10


def lookback_arrays(
    df: DataFrame, series: Series, arrays: dict[str, Column], rows: int, keep: list[str]
) -> DataFrame:
    """For each row with ``rows`` rows before it: those rows' values as arrays.

    A series of N rows gives N - rows samples. Samples hold ``rows`` copies of the
    data, so build them only for what will be trained on.
    """
    inputs = {f"__in_{n}": c for n, c in arrays.items()}

    def compute(d: DataFrame, w: Along) -> DataFrame:
        return d.withColumns(
            {n: F.expr(w.sql(f"collect_list({sql_name(f'__in_{n}')})", -rows, -1)) for n in arrays}
        ).where(F.size(next(iter(arrays))) == rows)

    out = series.over(df.withColumns(inputs), compute, before=rows)
    return out.select(*series.keys, series.ts, *arrays, *keep)


def present(df: DataFrame, wanted: list[str]) -> list[str]:
    """The feature columns out of ``wanted`` that the table has, in that order."""
    return [c for c in wanted if c in df.columns]


def top_entities(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` keys with most readings; ties go to the smaller key."""
    return _most(df.groupBy(key).agg(F.count(F.lit(1)).alias("n_readings")), key, n)


def _most(counts: DataFrame, key: str, n: int) -> DataFrame:
    return counts.orderBy(F.desc("n_readings"), F.asc(key)).limit(n)


def only_top_entities(df: DataFrame, key: str, n: int) -> DataFrame:
    return keep_keys(df, top_entities(df, key, n), [key])


def derived_features(df: DataFrame, series: Series, value: str, rows: int, step_minutes: int):
    """Past-rows and same-slot mean and deviation, all from earlier rows only."""
    series = series.measured(df)
    slotted = df.withColumn("time_slot", step_of_day(series.ts, step_minutes))
    recent = past_stats(slotted, series, value, rows, ("roll_mean", "roll_std"))
    return same_slot_stats(
        recent, series, "time_slot", value, rows, ("past_days_mean", "past_days_std")
    )


def sequence_dataset(
    df: DataFrame,
    series: Series,
    value: str,
    *,
    k_steps: int,
    n_entities: int,
    start: str,
    end: str,
    step_minutes: int,
    ranges: dict[str, tuple[str, str]],
    tiebreak: str | None = None,
) -> DataFrame:
    """Two-branch samples of the best-covered entities, labelled by calendar split.

    With ``tiebreak`` the rows may hold copies: entities are chosen by the distinct times
    of their raw keys, and only what the chosen ones have is deduped.
    """
    key = series.keys[0]
    rows = between_dates(df, series.ts, start, end)
    # One count serves the choice of entities, their least history and their length.
    n = F.count_distinct(series.ts) if tiebreak else F.count(F.lit(1))
    top = _most(rows.groupBy(key).agg(n.alias("n_readings")), key, n_entities).collect()
    enough = [r[key] for r in top if r["n_readings"] >= k_steps + HISTORY_MARGIN]
    series = replace(series, largest=max((r["n_readings"] for r in top), default=0))
    rows = rows.where(F.col(key).isin(enough))
    if tiebreak:
        rows = keep_first(rows, [*series.keys, series.ts], tiebreak)
        rows = checkpointed(rows) if series.cut else rows
    rows = derived_features(rows, series, value, k_steps, step_minutes)
    derived = F.array(
        *[F.col(c).cast("float") for c in ("roll_mean", "roll_std", "past_days_mean", "past_days_std")]
    )
    samples = lookback_arrays(
        rows.withColumn("y", F.col(value).cast("float")),
        series,
        {"basic": basic_vector(value, series.ts, step_minutes), "derived": derived},
        k_steps,
        ["y"],
    )
    return split_by_calendar(samples, series.ts, ranges)

