"""Cleaning: parsing, dedupe, clipping, capping and scaling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilospan.functions import scalars as S
from kilospan.plans.quantiles import MAX_DISTINCT, exact_quantiles
from kilospan.plans.series import Series
from kilospan.plans.sizes import checkpointed, left_lookup

# Quantile of the cap, width of the fence, upper bound of a flat table.
CAP_QUANTILE = 0.999
FENCE_WIDTH = 1.5
FALLBACK_MAX = 10.0
# Rows a series needs in each part to be fitted and scored.
MIN_PART_ROWS = {"train": 10, "val": 5, "test": 5}


@dataclass(frozen=True)
class Bounds:
    """One pair of scaler limits, held as literals so that no join is needed."""

    lo: float
    hi: float


def parse_timestamps(df: DataFrame, ts: str, formats: tuple[str, ...] = ()) -> DataFrame:
    """Read a text time column leniently and drop the rows it cannot read."""
    return df.withColumn(ts, S.lenient_timestamp(ts, formats)).dropna(subset=[ts])


def keep_first(df: DataFrame, keys: list[str], tiebreak: str) -> DataFrame:
    """One row per key: the one with the least ``tiebreak`` (unique, not NULL).

    An aggregate, not a ranking window, so that copies collapse before the shuffle
    however many of them share a key.
    """
    values = [c for c in df.columns if c not in keys and c != tiebreak]
    first = [F.min_by(c, tiebreak).alias(c) for c in values]
    out = df.groupBy(*keys).agg(*first, F.min(tiebreak).alias(tiebreak))
    return out.select(*df.columns)


def first_readings(df: DataFrame, series: Series, tiebreak: str) -> tuple[DataFrame, Series]:
    """Readings with a time, the first of each key and time, and their measured series.

    Lengths are counted on the raw keys: copies only make the bound wider, and no reading
    is deduped twice. Where series are of even size one exchange serves the dedupe and the
    windows after it. Series that are to be cut are kept, as cutting counts before it moves.
    """
    rows = df.dropna(subset=[series.ts])
    series = series.measured(rows)
    rows = keep_first(series.gathered(rows), [*series.keys, series.ts], tiebreak)
    return (checkpointed(rows) if series.cut else rows), series


def clip_columns(df: DataFrame, columns, lower=None, upper=None) -> DataFrame:
    return df.withColumns({c: S.clip(c, lower, upper) for c in columns})


def quantile_caps(
    df: DataFrame, columns, q: float = CAP_QUANTILE, superset: DataFrame | None = None,
    at_most: int | None = None,
) -> dict[str, float]:
    """The cap of each column over the whole table, as literals."""
    named = {c: F.col(c) for c in columns}
    row = exact_quantiles(df, named, [q], superset=superset, at_most=at_most).first()
    return {c: row[c][0] if row[c] else None for c in columns}


def cap_columns(df: DataFrame, caps: dict[str, float | None]) -> DataFrame:
    return df.withColumns(
        {c: S.cap_if_positive(c, cap) for c, cap in caps.items() if cap is not None}
    )


def scaler_bounds(
    df: DataFrame, value: str, q: float = CAP_QUANTILE, fallback: float | None = FALLBACK_MAX,
    at_most: int | None = None, superset: DataFrame | None = None,
) -> DataFrame:
    """One row (min, max): 0 and the quantile of the values clipped at 0."""
    named = {"max": S.clip(value, lower=0.0)}
    got = exact_quantiles(df, named, [q], at_most=at_most, superset=superset)
    top = F.col("max")[0]
    if fallback is not None:
        # neither a flat table nor one without values has a width of its own
        top = F.when(top > 0, top).otherwise(F.lit(fallback))
    return got.select(F.lit(0.0).alias("min"), top.alias("max"))


def fetch_bounds(table: DataFrame) -> Bounds:
    """Bring the single bounds row to the driver for use as literals."""
    row = table.first()
    return Bounds(row["min"], row["max"])


def clip_and_scale(df: DataFrame, value: str, scaled: str, b: Bounds) -> DataFrame:
    clipped = df.withColumn(value, S.clip(value, b.lo, b.hi))
    return clipped.withColumn(scaled, S.minmax(value, b.lo, b.hi))


def scale_within(df: DataFrame, series: Series, value: str, scaled: str) -> DataFrame:
    """Scale each series by its own least and greatest value."""
    out = series.with_totals(df, {"__lo": F.min(value), "__hi": F.max(value)})
    return out.withColumn(scaled, S.minmax(value, "__lo", "__hi")).drop(
        "__lo", "__hi"
    )


def ensure_scaled(df: DataFrame, series: Series, value: str, scaled: str) -> DataFrame:
    """``scale_within`` unless the table already has the scaled column."""
    return df if scaled in df.columns else scale_within(df, series, value, scaled)


def _fence(quartiles: Column) -> dict[str, Column]:
    q1, q3 = quartiles[0], quartiles[1]
    reach = (q3 - q1) * FENCE_WIDTH
    return {"lower": q1 - reach, "upper": q3 + reach}


def iqr_fences(df: DataFrame, keys, value: str, superset: DataFrame | None = None) -> DataFrame:
    """Per series: lower and upper limit 1.5 quartile ranges outside the quartiles."""
    named = {"__q": F.col(value)}
    quartiles = exact_quantiles(df, named, [0.25, 0.75], list(keys), superset=superset)
    return quartiles.select(*keys, *[c.alias(n) for n, c in _fence(F.col("__q")).items()])


def with_fences(df: DataFrame, series: Series, value: str) -> DataFrame:
    """Add ``lower`` and ``upper``. Series of moderate length find them in the
    window exchange they need anyway; longer ones through distributed quantiles."""
    series = series.measured(df)
    if series.cut or series.largest > MAX_DISTINCT:
        # two passes for the quartiles and one to use them
        df = checkpointed(df)
        fences = iqr_fences(df, series.keys, value, superset=df)
        return left_lookup(df, fences, list(series.keys))
    whole = series.window().rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    both = F.percentile(value, F.array(F.lit(0.25), F.lit(0.75))).over(whole)
    return df.withColumn("__q", both).withColumns(_fence(F.col("__q"))).drop("__q")


def iqr_clip(df: DataFrame, series: Series, value: str) -> DataFrame:
    fenced = with_fences(df, series, value)
    return fenced.withColumn(
        value, S.clip(value, "lower", "upper")
    ).drop("lower", "upper")


def iqr_outliers(df: DataFrame, series: Series, value: str) -> DataFrame:
    """Count and share of values outside the fence, per series."""
    fenced = with_fences(df, series, value)
    flag = S.outside(value, "lower", "upper").cast("int")
    return fenced.groupBy(*series.keys).agg(
        F.sum(flag).alias("outliers"), (F.avg(flag) * 100).alias("outlier_pct")
    )


def _of_keys(keys: Series | list[str]) -> Series:
    return keys if isinstance(keys, Series) else Series(tuple(keys), "")


def with_min_history(df: DataFrame, keys: Series | list[str], rows: int) -> DataFrame:
    """Drop series with fewer than ``rows`` rows."""
    counted = _of_keys(keys).with_totals(df, {"__n": F.count(F.lit(1))})
    return counted.where(F.col("__n") >= rows).drop("__n")


def with_min_history_by_part(
    df: DataFrame, keys: Series | list[str], split: str = "split",
    rows: dict[str, int] = MIN_PART_ROWS,
) -> DataFrame:
    """Drop series that have too few rows in any of the named parts."""
    names = {f"__n{i}": part for i, part in enumerate(rows)}
    counts = {name: F.count_if(F.col(split) == part) for name, part in names.items()}
    counted = _of_keys(keys).with_totals(df, counts)
    for name, part in names.items():
        counted = counted.where(F.col(name) >= rows[part])
    return counted.drop(*names)


def between_dates(df: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """Rows from the start of ``start`` to the last instant of ``end``."""
    first = F.to_date(F.lit(start)).cast("timestamp_ntz")
    past = F.date_add(F.to_date(F.lit(end)), 1).cast("timestamp_ntz")
    return df.where((F.col(ts) >= first) & (F.col(ts) < past))
