"""Linear models fitted per series from sufficient statistics.

A least-squares fit needs of its training rows only the sums of products of its columns.
:func:`grams` adds these up per key in one aggregate, so a series of any length becomes a
small matrix in the map tasks already. Any model on a subset of the columns is a submatrix
of it: all variants of all series are solved from the same row, in batches of matrices.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilospan.operators.features import lag_columns
from kilospan.plans.series import Series
from kilospan.plans.sizes import left_lookup

ONE = "__one"


def grams(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Per key the upper triangle of the products of 1 and the columns, row by row, summed
    over rows in which none is NULL."""
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull()
    rows = df.where(whole).select(*keys, F.lit(1.0).alias(ONE), *[F.col(c).cast("double") for c in columns])
    names = [ONE, *columns]
    products = [F.sum(F.col(a) * F.col(b)) for i, a in enumerate(names) for b in names[i:]]
    return rows.groupBy(*keys).agg(F.array(*products).alias("gram"))


def solve(gram: np.ndarray, width: int, chosen: list[int]) -> np.ndarray:
    """Coefficients (intercept first) of the last column on the chosen ones, per matrix.

    ``gram`` holds an upper triangle of ``width`` columns per row. A matrix without an
    inverse gets the solution of least length.
    """
    full = np.zeros((len(gram), width, width))
    upper = np.triu_indices(width)
    full[:, upper[0], upper[1]] = gram
    full[:, upper[1], upper[0]] = gram
    at = [0, *chosen]
    a, b = full[:, at][:, :, at], full[:, at, -1]
    # to a unit diagonal: columns of very different size are as good as any
    size = np.sqrt(np.maximum(np.einsum("nii->ni", a), np.finfo(float).tiny))
    a, b = a / (size[:, :, None] * size[:, None, :]), b / size
    inverse = np.linalg.pinv(a, rcond=1e-12, hermitian=True)
    return np.einsum("nij,nj->ni", inverse, b) / size


def fit_variants(
    df: DataFrame, keys: list[str], target: str, variants: dict[str, list[str]]
) -> DataFrame:
    """Per key one array of coefficients (intercept first) for each named variant, a list of
    feature columns. Keys without a whole row have no fit."""
    features = list(dict.fromkeys(c for chosen in variants.values() for c in chosen))
    stats = grams(df, keys, [*features, target])
    schema = ", ".join(
        [f"`{k}` {stats.schema[k].dataType.simpleString()}" for k in keys]
        + [f"`{v}` array<double>" for v in variants]
    )
    places = {v: [features.index(c) + 1 for c in chosen] for v, chosen in variants.items()}
    width = len(features) + 2

    def run(batches):
        for batch in batches:
            flat = batch.column("gram").flatten().to_numpy(zero_copy_only=False)
            gram = flat.reshape(batch.num_rows, -1)
            fits = [pa.array(list(solve(gram, width, at)), pa.list_(pa.float64())) for at in places.values()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys), *fits], [*keys, *places]
            )

    return stats.mapInArrow(run, schema)


def variant_forecasts(
    df: DataFrame, series: Series, value: str, lags: dict[str, int],
    variants: dict[str, list[str]], split: str = "split",
) -> DataFrame:
    """One-step forecasts of every variant on the test part of every series: keys, ts,
    model, actual, predicted.

    Variants see the named lags of the value. Models are fitted per series on the rows
    ``split`` calls train; rows that lack a lag a variant looks at have no forecast of it.
    """
    keys = list(series.keys)
    rows = series.over(
        df, lambda d, w: d.withColumns(lag_columns(value, lags, w)), before=max(lags.values())
    )
    fits = fit_variants(rows.where(F.col(split) == "train"), keys, value, variants)
    test = left_lookup(rows.where(F.col(split) == "test"), fits, keys)

    def predicted(name: str, chosen: list[str]):
        fit = F.col(f"`{name}`")
        out = fit[0]
        for i, c in enumerate(chosen, 1):
            out = out + fit[i] * F.col(c)
        return out.alias(name)

    wide = test.select(
        *keys, series.ts, F.col(value).cast("double").alias("actual"),
        *[predicted(v, chosen) for v, chosen in variants.items()],
    )
    return wide.unpivot([*keys, series.ts, "actual"], list(variants), "model", "predicted").where(
        F.col("predicted").isNotNull() & F.col("actual").isNotNull()
    )
