"""Forecast error aggregates over an actual and a predicted column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# denominators' floors in the two percentage errors.
MAPE_EPSILON = 1e-7
ROW_PCT_EPSILON = 1e-4


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _scored(y, p) -> Column:
    """The actual where there is a prediction to hold it against."""
    return F.when(_col(p).isNotNull(), _col(y))


def mae(y, p) -> Column:
    return F.avg(F.abs(_col(y) - _col(p)))


def mse(y, p) -> Column:
    return F.avg((_col(y) - _col(p)) * (_col(y) - _col(p)))


def rmse(y, p) -> Column:
    return F.sqrt(mse(y, p))


def mape(y, p, eps: float = MAPE_EPSILON) -> Column:
    y, p = _col(y), _col(p)
    return F.avg(F.abs(y - p) / F.greatest(F.abs(y), F.lit(eps))) * 100


def r2(y, p) -> Column:
    """1 - SSE/SST over rows that have both values; a constant actual gives 1 if
    predicted perfectly, else 0, and no such row at all gives NULL."""
    y, p = _scored(y, p), _col(p)
    sse = F.sum((y - p) * (y - p))
    sst = F.var_pop(y) * F.count(y)
    return F.when(sst > 0, 1 - sse / sst).when(sse == 0, F.lit(1.0)).when(sse > 0, F.lit(0.0))


def all_errors(y, p, places: int | None = 4) -> dict[str, Column]:
    """Every error as one set of aggregates, all found in the same pass."""
    cols = {
        "n": F.count(_col(y) - _col(p)),
        "mae": mae(y, p),
        "mse": mse(y, p),
        "rmse": rmse(y, p),
        "mape": mape(y, p),
        "r2": r2(y, p),
        "n_clamped": F.count_if(F.abs(_scored(y, p)) < MAPE_EPSILON),
    }
    if places is None:
        return cols
    return {
        k: v if k.startswith("n") else F.round(v, places) for k, v in cols.items()
    }


def pct_error(y, p, eps: float | None = ROW_PCT_EPSILON) -> Column:
    """Row percentage error; without ``eps`` a zero actual gives NULL."""
    y, p = _col(y), _col(p)
    den = y + F.lit(eps) if eps else F.nullif(y, F.lit(0.0))
    return F.try_divide(F.abs(y - p), den) * 100
