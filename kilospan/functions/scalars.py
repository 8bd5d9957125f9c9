"""Null-safe scalar rules for cleaning, scaling and unit changes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kilospan.functions.clock import sql_name


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _text(v) -> str:
    """A bound as SQL text; numbers keep every digit, None is no bound."""
    if v is None:
        return "cast(NULL AS double)"
    return sql_name(v) if isinstance(v, str) else f"{float(v)!r}D"


def lenient_timestamp(text, formats: tuple[str, ...] = ()) -> Column:
    """Text to TIMESTAMP_NTZ; whatever cannot be read becomes NULL."""
    text = _col(text)
    tries = [text.try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries)


def nan_to_null(x) -> Column:
    x = _col(x)
    return F.when(~F.isnan(x), x)


def clip(x: str, lower=None, upper=None) -> Column:
    """Limit to [lower, upper]. Missing stays missing: greatest/least alone would
    turn a NULL or NaN into a bound. Bounds are numbers, names or SQL text."""
    x = y = sql_name(x)
    if lower is not None:
        y = f"greatest({y}, {_text(lower)})"
    if upper is not None:
        y = f"least({y}, {_text(upper)})"
    return F.expr(f"CASE WHEN NOT isnan({x}) AND {x} IS NOT NULL THEN {y} END")


def cap_if_positive(x: str, cap: float) -> Column:
    """Upper limit that applies only where the cap itself is above zero."""
    return clip(x, upper=cap) if cap > 0 else F.col(x)


def minmax(x: str, lo, hi) -> Column:
    """(x - lo) / (hi - lo); a range of no width scales to 0."""
    x, lo, hi = sql_name(x), _text(lo), _text(hi)
    return F.expr(
        f"CASE WHEN {hi} > {lo} THEN ({x} - {lo}) / ({hi} - {lo}) WHEN {x} IS NOT NULL THEN 0D END"
    )


def unscale(x: str, lo, hi, floor=None) -> Column:
    lo, hi = _text(lo), _text(hi)
    y = f"({sql_name(x)} * ({hi} - {lo}) + {lo})"
    return F.expr(y) if floor is None else clip(y, lower=floor)


def row_total(columns) -> Column:
    """Sum over columns that skips missing cells (all missing gives 0)."""
    return F.expr(" + ".join(f"coalesce(cast({sql_name(c)} AS double), 0D)" for c in columns))


def energy_to_power(kwh, step_minutes: int) -> Column:
    return _col(kwh) * F.lit(60.0 / step_minutes)


def rounded(x: str, places: int) -> Column:
    """Round a column half away from zero in binary arithmetic.

    ``round`` on a DOUBLE goes through decimals and costs more than the features it
    would round. From 2^52 / 10^places on a DOUBLE has no such places left, and the
    value stays as it is.
    """
    x, unit = sql_name(x), f"1e{places}D"
    return F.expr(
        f"CASE WHEN abs({x}) * {unit} < 4503599627370496D "
        f"THEN signum({x}) * floor(abs({x}) * {unit} + 0.5D) / {unit} + 0D ELSE {x} END"
    )


def outside(x: str, lower: str, upper: str) -> Column:
    x, lower, upper = sql_name(x), _text(lower), _text(upper)
    return F.expr(f"{x} < {lower} OR {x} > {upper}")
