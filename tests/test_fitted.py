"""Models fitted per series against numpy."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from kilospan.operators import fitted, forecast
from kilospan.plans.series import Series

START = dt.datetime(2021, 1, 1)
SERIES = Series.of("k", "ts")
VARIANTS = {"level": [], "line": ["l1"], "both": ["l1", "l2"]}


@pytest.fixture(scope="module")
def loads():
    rng = np.random.default_rng(5)
    out = {}
    for k in ("a", "b", None):
        x = [1.0, 2.0]
        for _ in range(200):
            x.append(0.5 * x[-1] - 0.2 * x[-2] + rng.normal())
        out[k] = np.array(x)
    out["flat"] = np.full(60, 3.0)
    out["short"] = np.array([1.0, 2.0])
    return out


@pytest.fixture(scope="module")
def df(spark, loads):
    rows = [
        (k, START + dt.timedelta(hours=i), float(v), "train" if i < 0.7 * len(x) else "test")
        for k, x in loads.items() for i, v in enumerate(x)
    ]
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, x double, split string")


def plain_fit(x, chosen):
    n = len(x)
    lag = {"l1": np.append([np.nan], x[:-1]), "l2": np.append([np.nan] * 2, x[:-2])}
    design = np.column_stack([np.ones(n), *[lag[c] for c in chosen]])
    train = (np.arange(n) < 0.7 * n) & (np.arange(n) >= 2)
    fit = np.linalg.lstsq(design[train], x[train], rcond=None)[0]
    return design @ fit, np.arange(n) >= 0.7 * n


def test_variants_equal_least_squares(df, loads):
    got = fitted.variant_forecasts(df, SERIES, "x", {"l1": 1, "l2": 2}, VARIANTS).toPandas()
    assert set(got.model) == set(VARIANTS)
    for k, x in loads.items():
        mine = got[got.k.isna() if k is None else got.k == k]
        if k == "short":
            assert mine.empty  # no train row has both lags
            continue
        for name, chosen in VARIANTS.items():
            want, test = plain_fit(x, chosen)
            rows = mine[mine.model == name].sort_values("ts")
            assert np.allclose(rows.predicted, want[test]) and np.allclose(rows.actual, x[test])


def test_one_aggregate_serves_all_variants(df):
    fits = fitted.fit_variants(df.withColumn("l1", F.col("x") * 1e-9), ["k"], "x", {"a": ["l1"], "b": []})
    plan = fits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    # columns of very different size
    row = fits.where("k = 'a'").first()
    assert row["a"][1] == pytest.approx(1e9, rel=1e-6)


def test_long_series_give_equal_models(df):
    cut = Series.of("k", "ts", rows_per_block=20)
    args = ("x", {"l1": 1, "l2": 2}, VARIANTS)
    key = lambda d: d.toPandas().sort_values(["k", "ts", "model"], ignore_index=True)
    a, b = (key(fitted.variant_forecasts(df, s, *args)) for s in (SERIES, cut))
    assert np.allclose(a.predicted, b.predicted) and a.model.equals(b.model)


def test_pooled_look_back_equals_least_squares(df, loads):
    some = df.where("k IN ('a', 'b')")
    got = forecast.look_back_forecasts(some, SERIES, "x", 2, keep=["split"]).toPandas()
    designs, ys = [], []
    for k in ("a", "b"):
        x = loads[k]
        d = np.column_stack([np.ones(len(x) - 2), x[1:-1], x[:-2]])
        train = np.arange(2, len(x)) < 0.7 * len(x)
        designs.append((d, train))
        ys.append(x[2:])
    fit = np.linalg.lstsq(
        np.concatenate([d[t] for d, t in designs]), np.concatenate([y[t] for y, (_, t) in zip(ys, designs)]), rcond=None
    )[0]
    for k, (d, train) in zip(("a", "b"), designs):
        rows = got[got.k == k].sort_values("ts")
        assert np.allclose(rows.predicted, (d @ fit)[~train])
    assert set(got.columns) == {"k", "ts", "split", "actual", "predicted"}
