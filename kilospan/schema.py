"""Source schemas, the 20-column feature contract and the step frequency."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Frequency:
    """Step length of a series and every row count that follows from it."""

    step_minutes: int
    rolling_rows: int
    lookback_rows: int
    horizons: tuple[int, ...]

    def __post_init__(self):
        if self.step_minutes <= 0 or 1440 % self.step_minutes:
            raise ValueError("step_minutes must divide a day")

    @property
    def step_seconds(self) -> int:
        return self.step_minutes * 60

    @property
    def steps_per_day(self) -> int:
        return 1440 // self.step_minutes

    @property
    def lag_day(self) -> int:
        return self.steps_per_day

    @property
    def lag_week(self) -> int:
        return 7 * self.steps_per_day


HOURLY = Frequency(60, rolling_rows=24, lookback_rows=24, horizons=(168,))
HALF_HOURLY = Frequency(30, rolling_rows=12, lookback_rows=48, horizons=(48, 96, 336))

# Raw meter columns and the common names they map to.
KWH_COLUMNS = (
    "GENERAL_SUPPLY_KWH",
    "CONTROLLED_LOAD_KWH",
    "GROSS_GENERATION_KWH",
    "NET_GENERATION_KWH",
    "OTHER_KWH",
)
METER_SCHEMA = T.StructType(
    [
        T.StructField("CUSTOMER_ID", T.IntegerType()),
        T.StructField("READING_DATETIME", T.StringType()),
        T.StructField("CALENDAR_KEY", T.IntegerType()),
        T.StructField("EVENT_KEY", T.IntegerType()),
        *[T.StructField(c, T.FloatType()) for c in KWH_COLUMNS],
    ]
)

# The 20 columns of the feature table, in order.
UNIFIED_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.IntegerType()),
        T.StructField("datetime", T.TimestampNTZType()),
        T.StructField("load_val", T.FloatType()),
        T.StructField("load_scaled", T.FloatType()),
        T.StructField("step_of_day", T.ByteType()),
        T.StructField("day_of_week", T.ByteType()),
        T.StructField("month", T.ByteType()),
        T.StructField("is_weekend", T.ByteType()),
        T.StructField("step_sin", T.FloatType()),
        T.StructField("step_cos", T.FloatType()),
        T.StructField("month_sin", T.FloatType()),
        T.StructField("month_cos", T.FloatType()),
        T.StructField("lag_1", T.FloatType()),
        T.StructField("lag_2", T.FloatType()),
        T.StructField("lag_day", T.FloatType()),
        T.StructField("lag_week", T.FloatType()),
        T.StructField("rolling_mean", T.FloatType()),
        T.StructField("rolling_std", T.FloatType()),
        T.StructField("target_load", T.FloatType()),
        T.StructField("target_scaled", T.FloatType()),
    ]
)
UNIFIED_COLUMNS = UNIFIED_SCHEMA.names
SIMPLE_COLUMNS = [
    c for c in UNIFIED_COLUMNS if not c.startswith(("lag_", "rolling_"))
]

# Scaler defaults used where a bounds file lacks an entry.
DEFAULT_SCALER_MIN = 0.0
DEFAULT_SCALER_MAX = 2.929


def narrowed(df: DataFrame, schema: T.StructType = UNIFIED_SCHEMA) -> DataFrame:
    """Cast the columns that ``schema`` names to its storage types, in its order."""
    have = set(df.columns)
    return df.select(
        *[F.col(f.name).cast(f.dataType) for f in schema.fields if f.name in have]
    )


def pick_column(columns: list[str], patterns: tuple[str, ...], default=None) -> str:
    """The column whose lower-cased name contains one of ``patterns``; several are refused."""
    found = [c for c in columns if any(p.lower() in c.lower() for p in patterns)]
    if len(found) > 1:
        raise ValueError(f"several columns of {columns} match {patterns}: {found}")
    if found:
        return found[0]
    if default is not None and default in columns:
        return default
    raise ValueError(f"no column of {columns} matches {patterns}")
