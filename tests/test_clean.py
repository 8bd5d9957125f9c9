import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kilospan.functions import scalars as S
from kilospan.operators import clean
from kilospan.plans.quantiles import exact_quantiles
from kilospan.plans.series import Series

DAY = dt.datetime(2020, 1, 1)


def column(df, name):
    return [r[0] for r in df.select(name).collect()]


def test_parse_drops_unreadable(spark):
    rows = [("2020-01-01 00:30:00",), ("nonsense",), (None,), ("2020-13-01",), ("2020-01-02",)]
    got = clean.parse_timestamps(spark.createDataFrame(rows, "ts string"), "ts")
    assert dict(got.dtypes)["ts"] == "timestamp_ntz"
    assert column(got, "ts") == [dt.datetime(2020, 1, 1, 0, 30), dt.datetime(2020, 1, 2)]


def test_parse_extra_format(spark):
    df = spark.createDataFrame([("01/02/2013 00:30",)], "ts string")
    got = clean.parse_timestamps(df, "ts", ("dd/MM/yyyy HH:mm",))
    assert column(got, "ts") == [dt.datetime(2013, 2, 1, 0, 30)]


def test_keep_first_takes_least_tiebreak_and_is_idempotent(spark):
    rows = [("a", 1, 5.0, 2), ("a", 1, 7.0, 1), ("a", 2, None, 3), ("a", 2, 9.0, 4), (None, 1, 1.0, 5)]
    df = spark.createDataFrame(rows, "k string, t int, x double, seq bigint")
    once = clean.keep_first(df, ["k", "t"], "seq")
    want = {("a", 1, 7.0, 1), ("a", 2, None, 3), (None, 1, 1.0, 5)}
    assert set(map(tuple, once.collect())) == want
    assert set(map(tuple, clean.keep_first(once, ["k", "t"], "seq").collect())) == want


def test_clip_keeps_missing_missing(spark):
    df = spark.createDataFrame([(-1.0,), (3.0,), (9.0,), (None,), (math.nan,)], "x double")
    assert column(df.select(S.clip("x", 0.0, 5.0).alias("x")), "x") == [0.0, 3.0, 5.0, None, None]


def test_cap_only_if_positive(spark):
    df = spark.createDataFrame([(-5.0, 1.0), (-1.0, 99.0)], "a double, b double")
    got = clean.cap_columns(df, {"a": -3.0, "b": 10.0}).collect()
    assert [tuple(r) for r in got] == [(-5.0, 1.0), (-1.0, 10.0)]


def test_iqr_fixture(spark):
    rows = [("r", DAY + dt.timedelta(hours=i), float(x))
            for i, x in enumerate([10, 20, 30, 40, 50, 1000, -500])]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, x double")
    series = Series.of("k", "ts")
    fence = clean.iqr_fences(df, ["k"], "x").first()
    assert (fence["lower"], fence["upper"]) == (-30.0, 90.0)
    assert sorted(column(clean.iqr_clip(df, series, "x"), "x")) == [-30, 10, 20, 30, 40, 50, 90]
    assert clean.iqr_outliers(df, series, "x").first()["outliers"] == 2


def test_iqr_clip_of_cut_series(spark):
    rows = [(f"k{i % 2}", DAY + dt.timedelta(hours=i), float((i * 37) % 101)) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, x double")
    one = clean.iqr_clip(df, Series.of("k", "ts"), "x").toPandas()
    cut = clean.iqr_clip(df, Series.of("k", "ts", rows_per_block=20), "x").toPandas()
    key = ["k", "ts"]
    pd.testing.assert_frame_equal(
        one.sort_values(key, ignore_index=True), cut.sort_values(key, ignore_index=True)
    )


def test_bounds_fallback(spark):
    df = spark.createDataFrame([(-1.0,), (-2.0,)], "x double")
    assert clean.fetch_bounds(clean.scaler_bounds(df, "x")) == clean.Bounds(0.0, 10.0)
    assert clean.fetch_bounds(clean.scaler_bounds(df, "x", fallback=None)) == clean.Bounds(0.0, 0.0)


def test_scale_and_back(spark):
    df = spark.createDataFrame([(0.5,), (2.0,), (None,)], "x double")
    scaled = df.select(S.minmax("x", 0.5, 2.5).alias("s"))
    assert column(scaled, "s") == [0.0, 0.75, None]
    assert column(scaled.select(S.unscale("s", 0.5, 2.5).alias("x")), "x") == [0.5, 2.0, None]
    low = spark.createDataFrame([(-3.0,), (None,)], "x double")
    assert column(low.select(S.unscale("x", 0.0, 1.0, floor=0.0).alias("x")), "x") == [0.0, None]


def test_constant_series_scales_to_zero(spark):
    df = spark.createDataFrame([("a", 4.0), ("a", 4.0), ("b", None)], "k string, x double")
    got = clean.scale_within(df, Series.of("k", "k"), "x", "s").collect()
    assert sorted((r["k"], r["s"]) for r in got if r["k"] == "a") == [("a", 0.0), ("a", 0.0)]
    assert [r["s"] for r in got if r["k"] == "b"] == [None]


def test_row_total(spark):
    df = spark.createDataFrame([(1.0, None), (None, None)], "a double, b double")
    assert column(df.select(S.row_total(["a", "b"]).alias("t")), "t") == [1.0, 0.0]


def test_date_range_is_inclusive_to_the_last_instant(spark):
    times = [dt.datetime(2020, 1, 1, 23, 59, 59), dt.datetime(2020, 1, 2),
             dt.datetime(2020, 1, 3, 23, 59, 59, 999999), dt.datetime(2020, 1, 4)]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    assert column(clean.between_dates(df, "ts", "2020-01-02", "2020-01-03"), "ts") == times[1:3]


def test_min_history(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2, "k string")
    assert column(clean.with_min_history(df, ["k"], 3), "k") == ["a"] * 3


@pytest.mark.parametrize("by", [[], ["k"]])
def test_narrowed_quantiles_match_pandas(spark, by):
    import numpy as np

    rng = np.random.default_rng(42)
    n = 12_000
    pdf = pd.DataFrame({
        "k": np.where(rng.random(n) < 0.34, "hot", rng.integers(0, 4, n).astype(str)),
        "x": np.exp(rng.normal(size=n) * 4),
    })
    pdf.loc[:2000, "x"] = 7.0
    pdf.loc[2001:2050, "x"] = np.nan
    probs = [0.0, 0.25, 0.5, 0.999, 1.0]
    df = spark.createDataFrame(pdf)
    got = exact_quantiles(df, {"q": F.col("x")}, probs, by, max_distinct=60).toPandas()
    if not by:
        assert np.allclose(got["q"][0], pdf.x.quantile(probs), rtol=1e-12)
    else:
        want = pdf.groupby("k").x.quantile(probs).unstack()
        for k, q in zip(got["k"], got["q"]):
            assert np.allclose(q, want.loc[k], rtol=1e-12)


def test_min_history_by_part(spark):
    rows = [(k, p) for k, n in {"a": (10, 5, 5), "b": (9, 50, 50), "c": (10, 5, 4)}.items()
            for p, m in zip(("train", "val", "test"), n) for _ in range(m)]
    df = spark.createDataFrame(rows, "k string, split string")
    got = clean.with_min_history_by_part(df, ["k"])
    assert got.count() == 20 and got.select("k").distinct().first()[0] == "a"


def test_scaled_only_if_missing_and_columns_present(spark):
    from kilospan.operators.samples import present

    df = spark.createDataFrame([("a", DAY, 1.0), ("a", DAY + dt.timedelta(hours=1), 3.0)], "k string, ts timestamp_ntz, x double")
    series = Series.of("k", "ts")
    once = clean.ensure_scaled(df, series, "x", "s")
    assert sorted(column(once, "s")) == [0.0, 1.0]
    assert clean.ensure_scaled(once, series, "x", "s") is once
    assert present(once, ["hour_sin", "s", "x"]) == ["s", "x"]


def test_bounds_of_an_empty_table(spark):
    df = spark.createDataFrame([], "x double")
    assert tuple(clean.scaler_bounds(df, "x").first()) == (0.0, clean.FALLBACK_MAX)


def test_errors_only_where_a_prediction_is(spark):
    from kilospan.functions.errors import all_errors

    rows = [(float(i), None if i % 2 else i + 0.5) for i in range(10)]
    df = spark.createDataFrame(rows, "y double, p double")
    got = df.agg(*[c.alias(n) for n, c in all_errors("y", "p").items()]).first()
    part = df.where("p IS NOT NULL").agg(*[c.alias(n) for n, c in all_errors("y", "p").items()]).first()
    assert got == part and got["n"] == 5


def test_rounded_beyond_its_range(spark):
    df = spark.createDataFrame([(1e13,), (-2.5e300,), (1.23456749,)], "x double")
    assert column(df.select(S.rounded("x", 6).alias("x")), "x") == [1e13, -2.5e300, 1.234567]


def numbers(kind, n):
    rng = np.random.default_rng(n)
    return {
        "even": rng.normal(size=n), "ties": rng.integers(0, 3, n).astype(float),
        "wide": rng.choice([-1.7e308, 0.0, 1.7e308], n), "infinite": rng.choice([-np.inf, 0.0, 1.0, np.inf], n),
    }[kind]


@pytest.mark.parametrize("by", [[], ["k"]])
def test_selected_quantiles_equal_percentile(spark, by):
    """The two passes against Spark's own aggregate: small and large groups, ties, ranges
    wider than a number, infinities, NULL groups, groups of NULLs and no rows."""
    rows = [
        (f"{kind} {n}", float(v)) for kind in ("even", "ties", "wide", "infinite")
        for n in (1, 2, 199, 200, 5_000) for v in numbers(kind, n)
    ]
    rows += [(None, 1.5), (None, 2.5), ("nulls", None), ("nan", float("nan"))]
    df = spark.createDataFrame(rows, "k string, x double")
    probs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]
    clear = F.nanvl("x", F.lit(None))
    flat = lambda t: sorted((repr(tuple(r)[:-1]), repr(r["q"])) for r in t.collect())
    for d in (df, df.limit(0)):
        got = exact_quantiles(d, {"q": F.col("x")}, probs, by, max_distinct=-1, superset=d)
        want = d.groupBy(*by).agg(F.percentile(clear, F.array(*map(F.lit, probs))).alias("q"))
        assert flat(got) == flat(want)


def test_brackets_that_miss_are_widened(spark, monkeypatch):
    """A sketch that is worse than promised costs passes, not results."""
    from kilospan.plans import quantiles

    df = spark.range(50_000).select(F.rand(3).alias("x"))
    real = quantiles._sketch

    def wrong(values, columns, probs, by):
        ok = real(values, columns, probs, by)
        shifted = F.transform(F.col("q.grid"), lambda g: g + 0.3)
        return ok.withColumn("q", F.col("q").withField("grid", shifted))

    monkeypatch.setattr(quantiles, "_sketch", wrong)
    got = exact_quantiles(df, {"q": F.col("x")}, [0.25, 0.5], max_distinct=10, superset=df).first()["q"]
    want = df.agg(F.percentile("x", F.array(F.lit(0.25), F.lit(0.5)))).first()[0]
    assert got == want


def test_min_history_of_long_series(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id AS ts", "CASE WHEN id < 500 THEN 'train' WHEN id < 700 THEN 'val' ELSE 'test' END AS split")
    whole, cut = Series.of("k", "ts", largest=200), Series.of("k", "ts", largest=200, rows_per_block=10)
    for s in (whole, cut, ["k"]):
        assert clean.with_min_history(df, s, 143).count() == 143 * 6
        assert clean.with_min_history_by_part(df, s, rows={"train": 72, "test": 1}).select("k").distinct().count() == 3
