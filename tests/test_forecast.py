import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kilospan.functions import calendar as C
from kilospan.functions.errors import pct_error
from kilospan.operators import forecast, metrics, profile, sets, split
from kilospan.plans.series import Series
from kilospan.schema import HALF_HOURLY, HOURLY

START = dt.datetime(2023, 5, 1)


@pytest.fixture(scope="module")
def hours(spark):
    rng = np.random.default_rng(11)
    pdf = pd.concat([
        pd.DataFrame({"k": k, "ts": pd.date_range(START, periods=n, freq="h"),
                      "x": rng.normal(50, 9, n).round(3)})
        for k, n in {"a": 400, "b": 300, "short": 3}.items()
    ], ignore_index=True)
    return pdf, spark.createDataFrame(pdf, "k string, ts timestamp_ntz, x double")


S = Series.of("k", "ts").on_grid(3600)


def test_metrics_values(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (0.0, 0.5)], "actual double, predicted double")
    got = metrics.forecast_metrics(df, [], places=None).first()
    y, p = np.array([1, 3, 0.0]), np.array([2, 3, 0.5])
    assert got["mae"] == pytest.approx(np.abs(y - p).mean())
    assert got["rmse"] == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    assert got["mape"] == pytest.approx((np.abs(y - p) / np.maximum(np.abs(y), 1e-7)).mean() * 100)
    assert got["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert (got["n"], got["n_clamped"]) == (3, 1)


def test_r2_of_constant_actuals(spark):
    df = spark.createDataFrame([("hit", 2.0, 2.0), ("hit", 2.0, 2.0), ("miss", 2.0, 3.0), ("miss", 2.0, 2.0)],
                               "model string, actual double, predicted double")
    got = {r["model"]: r["r2"] for r in metrics.forecast_metrics(df, ["model"]).collect()}
    assert got == {"hit": 1.0, "miss": 0.0}


def test_pct_error_of_zero(spark):
    df = spark.createDataFrame([(0.0, 1.0)], "a double, p double")
    assert df.select(pct_error("a", "p", None)).first()[0] is None
    assert df.select(pct_error("a", "p")).first()[0] == pytest.approx(1e6)


def test_best_model_tie_goes_to_the_first_named(spark):
    df = spark.createDataFrame([("c", "m2", 5.0), ("c", "m1", 5.0), ("d", "m1", None), ("d", "m2", 1.0)],
                               "k string, model string, mape double")
    got = metrics.best_model_per_entity(df, "k", ["m1", "m2"]).collect()
    assert {(r["k"], r["best_model"]) for r in got} == {("c", "m1"), ("d", "m2")}
    pivot = {r["k"]: (r["m1"], r["m2"]) for r in metrics.mape_pivot(df, "k", ["m1", "m2"]).collect()}
    assert pivot == {"c": (5.0, 5.0), "d": (None, 1.0), "Average": (5.0, 3.0)}


def test_leaderboard_ranks_ties_and_missing(spark):
    m = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 2.0)], "model string, rmse double")
    reg = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y"), ("d", "y")], "model string, category string")
    got = {r["model"]: (r["rank"], r["rmse"]) for r in metrics.leaderboard(m, reg).collect()}
    assert got == {"a": (1, 1.0), "b": (1, 1.0), "c": (3, 2.0), "d": (4, None)}


def test_horizon_kpis_first_peak(spark):
    rows = [("k", START + dt.timedelta(hours=i), 1.0, p) for i, p in enumerate([2.0, 5.0, 5.0, 1.0])]
    df = forecast.with_errors(spark.createDataFrame(rows, "k string, ts timestamp_ntz, actual double, predicted double"))
    got = metrics.horizon_kpis(df, ["k"], "ts", reserve_pct=20).first()
    assert (got["peak"], got["peak_time"], got["base"], got["reserve"]) == (5.0, "01:00", 1.0, 6.0)
    alert = forecast.peak_alerts(df, ["k"], "ts", threshold=5.0).first()
    assert alert["alert"] and alert["n_breaches"] == 2 and alert["first_breach"].hour == 1
    assert not forecast.peak_alerts(df, ["k"], "ts", threshold=5.1).first()["alert"]


def test_evaluate_tables(spark, hours):
    pred = forecast.naive_forecasts(hours[1], S, "x", HOURLY)
    out = metrics.evaluate(pred, "k", forecast.NAIVE_MODELS, n=1)
    assert set(out) == {"metrics", "pivot", "by_model", "best", "distribution", "ends"}
    assert out["ends"].count() == 2
    assert out["pivot"].where("k = 'Average'").count() == 1


@pytest.mark.parametrize("block", [2_000_000, 40])
def test_naive_forecasts_match_pandas(hours, block):
    pdf, df = hours
    got = forecast.naive_forecasts(df, Series.of("k", "ts", rows_per_block=block).on_grid(3600), "x", HOURLY)
    got = got.toPandas()
    want = pdf.copy()
    g = want.groupby("k").x
    want["last_value"], want["same_slot_day"], want["same_slot_week"] = g.shift(1), g.shift(24), g.shift(168)
    want["slot_mean"] = pd.concat([g.shift(24 * i) for i in range(1, 8)], axis=1).mean(axis=1)
    want = want.melt(["k", "ts", "x"], forecast.NAIVE_MODELS, "model", "predicted").dropna()
    key = ["k", "ts", "model"]
    got, want = got.sort_values(key, ignore_index=True), want.sort_values(key, ignore_index=True)
    assert (got[key].astype(str) == want[key].astype(str)).all().all()
    assert np.allclose(got.predicted, want.predicted) and np.allclose(got.actual, want.x)


def test_seasonal_rollout(hours):
    pdf, df = hours
    got = forecast.rollout_seasonal(df, S, "x", HOURLY, 50, 24).toPandas()
    for k, g in pdf.groupby("k"):
        tail = g.sort_values("ts").x.tolist()[-24:]
        mine = got[got.k == k].sort_values("step")
        assert mine.predicted.tolist() == [tail[(s - 1) % len(tail)] for s in range(1, 51)]
        assert mine.ts.iloc[0] == g.ts.max() + pd.Timedelta(hours=1)


def test_linear_rollout_matches_a_loop(hours):
    pdf, df = hours
    coef, bias = [0.5, 0.2, -0.1, 0.3], 1.5
    got = forecast.rollout_linear(df, S, "x", HOURLY, 30, coef, bias).toPandas()
    assert set(got.k) == {"a", "b"}
    for k in ("a", "b"):
        hist = pdf[pdf.k == k].sort_values("ts").x.tolist()
        for _ in range(30):
            hist.append(bias + sum(c * hist[-1 - i] for i, c in enumerate(coef)))
        assert np.allclose(got[got.k == k].sort_values("step").predicted, hist[-30:])


def test_autoregression_recovers_its_coefficients(spark):
    rng = np.random.default_rng(2)
    x = [1.0, 2.0]
    for _ in range(600):
        x.append(0.6 * x[-1] - 0.3 * x[-2] + 2.0 + rng.normal() * 1e-6)
    rows = [("k", START + dt.timedelta(hours=i), v) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, x double")
    model = forecast.fit_autoregression(df, S, "x", 2)
    assert np.allclose(model.coefficients, [0.6, -0.3], atol=1e-3)
    assert model.intercept == pytest.approx(2.0, abs=1e-2)


def test_error_band(spark):
    df = spark.createDataFrame([("m", 1.0, 2.0), ("m", 4.0, 3.0)], "model string, actual double, predicted double")
    got = sorted(tuple(r) for r in forecast.error_band(df, ["model"]).select("lower", "upper").collect())
    assert got == [(1.0, 3.0), (2.0, 4.0)]
    assert forecast.error_band(df.withColumn("predicted", F.lit(0.0)), ["model"]).first()["lower"] == 0.0


def test_calendar_values(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 6, 15, 14, 45),)], "ts timestamp_ntz")
    row = df.select(*[c.alias(n) for n, c in C.calendar_long("ts").items()]).first()
    assert row.asDict() == {"hour": 14, "dayofweek": 0, "month": 6, "year": 2020, "dayofyear": 167,
                            "quarter": 2, "is_weekend": 0}
    assert df.select(*[c.alias(n) for n, c in C.calendar_short("ts", 30).items()]).first()["step_of_day"] == 29


def test_cyclical_range(spark):
    df = spark.createDataFrame([(h,) for h in (0, 6, 12, 18, 24)], "h int")
    rows = df.select(*[c.alias(n) for n, c in C.cyclical("h", 24, "h").items()]).collect()
    assert all(abs(v) <= 1 for r in rows for v in r)
    assert np.allclose(rows[0], rows[4], atol=1e-10)


def test_clock_ignores_the_session_zone(spark):
    """Naive stamps inside a skipped hour keep their own clock in any zone."""
    from kilospan.functions.clock import epoch_micros, epoch_seconds, floor_to_step, plus_seconds
    from kilospan.streaming.flows import as_event_time, as_naive

    t = dt.datetime(2021, 3, 28, 2, 30, 5, 123456)
    df = spark.createDataFrame([(t,)], "ts timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        row = df.select(
            epoch_seconds("ts"), epoch_micros("ts"), floor_to_step("ts", 30),
            plus_seconds("ts", 3600), as_naive(as_event_time("ts")),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    seconds = int((t.replace(microsecond=0) - dt.datetime(1970, 1, 1)).total_seconds())
    assert row[0] == seconds and row[1] == seconds * 10**6 + 123456
    assert row[2] == dt.datetime(2021, 3, 28, 2, 30)
    assert row[3] == t + dt.timedelta(hours=1) and row[4] == t


def test_date_split_has_each_row_once(spark):
    df = spark.range(3 * 365 * 24).select(F.expr("timestampadd(HOUR, id, timestamp_ntz'2016-01-01')").alias("ts"))
    got = {r["split"]: r["count"] for r in split.split_at(df, "ts", "2017-01-01").groupBy("split").count().collect()}
    assert got == {"train": 366 * 24, "test": 3 * 365 * 24 - 366 * 24}


def test_fraction_edges_follow_binary_floats(spark):
    """int(0.70 * 90) is 62 in binary floating point."""
    rows = [("k", START + dt.timedelta(hours=i)) for i in range(90)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz")
    got = split.split_by_fraction(df, Series.of("k", "ts"))
    assert got.where("split = 'train'").count() == int(0.70 * 90) == 62


def test_future_calendar(spark):
    df = spark.createDataFrame([("k", START)], "k string, ts timestamp_ntz")
    got = forecast.future_calendar(df, Series.of("k", "ts"), HALF_HOURLY, 96).orderBy("step").collect()
    assert len(got) == 96 and got[0]["ts"] == START + dt.timedelta(minutes=30)
    assert got[-1]["step_of_day"] == 0 and got[-1]["ts"] == START + dt.timedelta(days=2)


def test_region_ids_by_name(spark):
    df = spark.createDataFrame([("w", 1), ("a", 1), ("w", 2)], "region string, x int")
    got = {(r["region"], r["customer_id"]) for r in sets.with_region_ids(df).collect()}
    assert got == {("a", 1), ("w", 2)}


def test_quality_profile(spark):
    df = spark.createDataFrame([("a", START, 1.0), ("a", START, None), ("b", None, 2.0)],
                               "k string, ts timestamp_ntz, x double")
    got = profile.quality_profile(df, ["k"], "ts", ["x"]).first()
    assert (got["n_rows"], got["n_duplicates"], got["null_ts"], got["null_x"]) == (3, 1, 1, 1)
