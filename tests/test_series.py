"""Ordered operators: cut and uncut plans against pandas on irregular series."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kilospan.operators import features, resample, samples, split
from kilospan.plans.ranks import global_rank
from kilospan.plans.series import Series, first_rows

DAY = dt.datetime(2021, 3, 27)


@pytest.fixture(scope="module")
def pdf():
    """Irregular series: one holds a third of the rows, one a single row; bursts,
    gaps of months and missing values."""
    rng = np.random.default_rng(7)
    parts = []
    for k, n in {"hot": 900, "b": 400, "c": 390, "d": 390, "tiny": 7, "one": 1}.items():
        gaps = rng.choice([1, 30, 1800, 86_400, 5_000_000], size=n, p=[0.3, 0.2, 0.4, 0.08, 0.02])
        ts = pd.Timestamp(DAY) + pd.to_timedelta(np.cumsum(gaps), unit="s")
        x = np.round(rng.normal(5, 3, n), 3)
        x[rng.random(n) < 0.15] = np.nan
        parts.append(pd.DataFrame({"k": k, "ts": ts, "x": x}))
    return pd.concat(parts, ignore_index=True)


@pytest.fixture(scope="module")
def df(spark, pdf):
    out = spark.createDataFrame(pdf, "k string, ts timestamp_ntz, x double")
    return out.withColumn("x", F.nanvl("x", F.lit(None))).repartition(4)


SERIES = [Series.of("k", "ts"), Series.of("k", "ts", rows_per_block=40)]
IDS = ["whole", "cut"]


def same(got, want):
    got = got.toPandas().sort_values(["k", "ts"], ignore_index=True)
    want = want.sort_values(["k", "ts"], ignore_index=True)
    want["ts"] = want["ts"].astype(got["ts"].dtype)
    pd.testing.assert_frame_equal(
        got[sorted(got)], want[sorted(got)], check_dtype=False, rtol=1e-9, atol=1e-9
    )


@pytest.mark.parametrize("s", SERIES, ids=IDS)
def test_lags(df, pdf, s):
    want = pdf.copy()
    for n in (1, 24, 168):
        want[f"l{n}"] = want.groupby("k").x.shift(n)
    same(features.lags(df, s, "x", {"l1": 1, "l24": 24, "l168": 168}), want)


@pytest.mark.parametrize("s", SERIES, ids=IDS)
@pytest.mark.parametrize("partial", [True, False])
def test_rolling(df, pdf, s, partial):
    want = pdf.copy()
    for f in ("mean", "std"):
        want[f"rolling_{f}"] = want.groupby("k").x.transform(
            lambda g: getattr(g.rolling(12, min_periods=1 if partial else None), f)()
        )
        if partial:
            want[f"rolling_{f}"] = want[f"rolling_{f}"].fillna(0.0)
    same(features.rolling(df, s, "x", 12, partial=partial), want)


@pytest.mark.parametrize("s", SERIES, ids=IDS)
def test_past_stats(df, pdf, s):
    want = pdf.copy()
    roll = lambda f: want.groupby("k").x.transform(
        lambda g: getattr(g.shift(1).rolling(5, min_periods=1), f)()
    ).fillna(0.0)
    want["past_mean"], want["past_std"] = roll("mean"), roll("std")
    same(features.past_stats(df, s, "x", 5), want)


@pytest.mark.parametrize("s", SERIES, ids=IDS)
def test_same_slot(df, pdf, s):
    want = pdf.copy()
    want["slot"] = want.ts.dt.hour * 2 + want.ts.dt.minute // 30
    roll = lambda f: want.groupby(["k", "slot"]).x.transform(
        lambda g: getattr(g.shift(1).rolling(3, min_periods=1), f)()
    ).fillna(0.0)
    want["slot_mean"], want["slot_std"] = roll("mean"), roll("std")
    from kilospan.functions.clock import step_of_day

    got = features.same_slot_stats(df.withColumn("slot", step_of_day("ts", 30)), s, "slot", "x", 3)
    same(got, want)


@pytest.mark.parametrize("s", SERIES, ids=IDS)
def test_lead_target(df, pdf, s):
    want = pdf.copy()
    want["target"] = want.groupby("k").x.transform(lambda g: g.shift(-1).ffill())
    same(features.lead_target(df, s, "x"), want)


@pytest.mark.parametrize("s", SERIES, ids=IDS)
def test_positions_and_fraction_split(df, pdf, s):
    want = pdf.copy()
    want["pos"] = want.groupby("k").cumcount() + 1
    want["n"] = want.groupby("k").ts.transform("size")
    same(s.positions(df), want)
    parts = split.split_by_fraction(df, s).groupBy("k", "split").count().toPandas()
    got = {(r.k, r.split): r["count"] for _, r in parts.iterrows()}
    for k, n in pdf.k.value_counts().items():
        a, b = int(0.70 * n), int(0.85 * n)
        sizes = {"train": a, "val": b - a, "test": n - b}
        assert {p: got.get((k, p), 0) for p in sizes} == sizes


@pytest.mark.parametrize("s", SERIES, ids=IDS)
def test_lookback_samples(df, pdf, s):
    got = samples.lookback_arrays(
        df, s, {"a": F.struct(F.col("x").alias("v"))}, 6, ["x"]
    ).toPandas().sort_values(["k", "ts"], ignore_index=True)
    rows = []
    for k, g in pdf.groupby("k"):
        g = g.sort_values("ts")
        for i in range(6, len(g)):
            rows.append((k, g.ts.iloc[i], list(g.x.iloc[i - 6 : i])))
    assert len(got) == len(rows)
    for r, (k, ts, xs) in zip(got.itertuples(), sorted(rows)):
        assert (r.k, r.ts) == (k, ts)
        assert [e["v"] for e in r.a] == [None if np.isnan(v) else v for v in xs]


def hourly(rng, n=400):
    """Hourly series with holes, off-grid stamps, missing edges and a long gap."""
    parts = []
    for k in ("a", "b", "c"):
        ts = pd.date_range("2022-10-29 00:13", periods=n, freq="h")
        x = pd.Series(np.round(rng.normal(100, 20, n), 2))
        x[rng.random(n) < 0.2] = np.nan
        if k == "b":
            x[:3] = np.nan
            x[-4:] = np.nan
        g = pd.DataFrame({"k": k, "ts": ts, "x": x})
        keep = rng.random(n) > 0.3
        keep[100:160] = False
        keep[[0, n - 1]] = True
        g = g[keep]
        odd = g.sample(10, random_state=1).copy()
        odd["ts"] += pd.Timedelta(minutes=13)
        parts.append(pd.concat([g, odd[odd.ts < g.ts.max()]]))
    single = pd.DataFrame({"k": ["z"], "ts": [pd.Timestamp("2022-01-01")], "x": [4.0]})
    return pd.concat([*parts, single], ignore_index=True)


@pytest.mark.parametrize("s", SERIES, ids=IDS)
def test_interpolate_matches_pandas(spark, s):
    pdf = hourly(np.random.default_rng(3))
    df = spark.createDataFrame(pdf, "k string, ts timestamp_ntz, x double")
    df = df.withColumn("x", F.nanvl("x", F.lit(None)))
    want = []
    for k, g in pdf.groupby("k"):
        g = g.set_index("ts").sort_index()
        grid = pd.date_range(g.index.min(), g.index.max(), freq="h")
        filled = g.x.reindex(grid).interpolate(method="time")
        want.append(pd.DataFrame({"k": k, "ts": grid, "x": filled.values}))
    want = pd.concat(want)
    same(resample.interpolate(df, s, "x", 3600), want)
    gaps = {r["k"]: r["missing_steps"] for r in resample.missing_steps(df, s, 3600).collect()}
    for k, g in pdf.groupby("k"):
        grid = pd.date_range(g.ts.min(), g.ts.max(), freq="h")
        assert gaps[k] == len(grid) - g.ts.isin(grid).sum()


def test_reindex_fixture(spark):
    """198 rows with one repeat and three holes: 197, 200 on the grid, 3 missing."""
    from kilospan.operators.clean import keep_first

    hours = [i for i in range(200) if i not in (10, 11, 12)] + [5]
    rows = [("r", DAY + dt.timedelta(hours=h), 20_000.0 + h, i) for i, h in enumerate(hours)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, x double, seq int")
    s = Series.of("k", "ts")
    once = keep_first(df, ["k", "ts"], "seq")
    assert (df.count(), once.count()) == (198, 197)
    grid = resample.reindex(once, s, 3600)
    assert (grid.count(), grid.where("x IS NULL").count()) == (200, 3)
    assert resample.missing_steps(once, s, 3600).first()["missing_steps"] == 3
    filled = resample.interpolate(once, s, "x", 3600)
    assert filled.where("x IS NULL").count() == 0
    assert features.lags(filled, s, "x", {"l": 1}).dropna().count() == 199


def test_grid_blocks_equal_whole(spark):
    pdf = hourly(np.random.default_rng(5))
    df = spark.createDataFrame(pdf, "k string, ts timestamp_ntz, x double").dropna()
    filled = resample.interpolate(df, Series.of("k", "ts"), "x", 3600).toPandas()
    grid = spark.createDataFrame(filled, "k string, ts timestamp_ntz, x double")
    cut = Series.of("k", "ts", rows_per_block=30).on_grid(3600)
    want = filled.sort_values(["k", "ts"]).copy()
    want["l"] = want.groupby("k").x.shift(24)
    same(features.lags(grid, cut, "x", {"l": 24}), want)


def test_cut_plan_bounds_every_block(spark, df):
    """No window partition of a cut series exceeds its block and halo."""
    seen = []

    def compute(d, w):
        sizes = d.groupBy("k", "__block").agg(F.count(F.lit(1)).alias("n"))
        seen.append(sizes.agg(F.max("n")).first()[0])
        return d

    Series.of("k", "ts", rows_per_block=40).over(df, compute, before=12)
    assert seen[0] <= 40 * 2 + 12


@pytest.mark.parametrize("n", [5, 50])
def test_first_rows_beyond_the_rank_limit(spark, df, pdf, n):
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "20")
    try:
        got = first_rows(df.select("k", "ts"), ["k"], F.asc("ts"), n).toPandas()
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    want = pdf.sort_values("ts").groupby("k").head(n)
    assert set(zip(got.k, got.ts)) == set(zip(want.k, want.ts))


@pytest.mark.parametrize("limit", [10, 10_000])
def test_global_rank(spark, limit):
    values = [float(v) for v in np.random.default_rng(0).integers(0, 60, 200)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = global_rank(df, [F.col("v").asc()], max_rows=limit)
    want = df.withColumn("rank", F.rank().over(Window.orderBy("v")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.fixture()
def nothing_is_small(monkeypatch):
    """Make every lookup take the way beyond the size limit."""
    from kilospan.plans import quantiles, ranks, series, sizes

    real = sizes.settle
    small = lambda df, max_rows=0: real(df, 0)
    for module in (quantiles, ranks, series, sizes):
        monkeypatch.setattr(module, "settle", small, raising=False)


def test_cut_series_with_a_large_place_table(nothing_is_small, df, pdf):
    want = pdf.copy()
    want["l"] = want.groupby("k").x.shift(24)
    same(features.lags(df, SERIES[1], "x", {"l": 24}), want)
    want = pdf.copy()
    want["target"] = want.groupby("k").x.transform(lambda g: g.shift(-1).ffill())
    same(features.lead_target(df, SERIES[1], "x"), want)


@pytest.mark.parametrize("by", [[], ["k"]])
def test_quantiles_with_large_state(nothing_is_small, df, pdf, by):
    from kilospan.plans.quantiles import exact_quantiles

    got = exact_quantiles(df, {"q": F.col("x")}, [0.25, 0.9], by, max_distinct=30).toPandas()
    for r in got.itertuples():
        x = pdf.x if not by else pdf[pdf.k == r.k].x
        if x.notna().any():
            assert np.allclose(r.q, x.quantile([0.25, 0.9]))


def test_one_long_gap_is_filled_in_runs(spark):
    import datetime as dt

    from kilospan.operators import resample

    first = dt.datetime(2000, 1, 1)
    steps = 1_000_000
    df = spark.createDataFrame(
        [("a", first, 0.0), ("a", first + dt.timedelta(minutes=steps), float(steps))],
        "k string, ts timestamp_ntz, x double",
    )
    got = resample.interpolate(df, Series.of("k", "ts"), "x", 60)
    n, total, last = got.agg(F.count("*"), F.sum("x"), F.max("ts")).first()
    assert (n, last) == (steps + 1, first + dt.timedelta(minutes=steps))
    assert total == steps * (steps + 1) / 2
    spine = resample.grid_spine(df, Series.of("k", "ts"), 60)
    assert spine.count() == spine.distinct().count() == steps + 1


@pytest.fixture(scope="module")
def giant(spark):
    """Of 60,000 readings a third are one series: half of it within a second, the rest one
    each hour over a year and more."""
    other = spark.range(40_000).selectExpr(
        "concat('s', id % 400) AS k", "timestampadd(MINUTE, 30 * (id div 400), timestamp_ntz'2021-01-01') AS ts",
        "cast(id % 17 AS double) AS x",
    )
    burst = spark.range(10_000).selectExpr(
        "'hot' AS k", "timestampadd(MICROSECOND, 90 * id, timestamp_ntz'2021-06-01') AS ts", "cast(id % 7 AS double) AS x"
    )
    slow = spark.range(10_000).selectExpr(
        "'hot' AS k", "timestampadd(HOUR, id, timestamp_ntz'2021-01-01 00:30:00') AS ts", "cast(id % 5 AS double) AS x"
    )
    return other.union(burst).union(slow)


def test_a_giant_series_is_cut_evenly(giant, monkeypatch):
    from kilospan.plans import series as plans

    kept = []
    real = plans.checkpointed
    monkeypatch.setattr(plans, "checkpointed", lambda d: kept.append(real(d)) or kept[-1])
    size = 500
    s = Series.of("k", "ts", rows_per_block=size).measured(giant)
    rows = s._counted_blocks(giant, 24, 1, None)
    # a few pieces for each block of rows, however the readings lie in time
    nodes = sum(t.count() for t in kept)
    assert nodes <= 4 * plans.PIECES * 20_000 / size
    blocks = rows.where("k = 'hot'").groupBy(plans.BLOCK).count().toPandas()
    own = rows.where(f"k = 'hot' AND {plans.OWN}").groupBy(plans.BLOCK).count().toPandas()
    assert own["count"].sum() == 20_000 and len(own) >= 20_000 / (2 * size)
    assert blocks["count"].max() < 2 * blocks["count"].median()
    assert rows.where(f"k != 'hot' AND {plans.BLOCK} != 0").count() == 0


def test_a_giant_series_gives_equal_results(giant):
    whole, cut = Series.of("k", "ts"), Series.of("k", "ts", rows_per_block=500)
    for compute in (
        lambda s: features.lags(giant, s, "x", {"l": 24}),
        lambda s: features.rolling(giant, s, "x", 12, partial=True),
        lambda s: features.lead_target(giant.withColumn("x", F.when(F.col("x") > 0, F.col("x"))), s, "x"),
        lambda s: s.positions(giant),
    ):
        got, want = compute(cut), compute(whole)
        assert got.exceptAll(want.select(*got.columns)).isEmpty() and got.count() == 60_000


def test_totals_of_cut_series(giant):
    totals = {"n": F.count("x"), "most": F.max("x")}
    got = Series.of("k", "ts", rows_per_block=500).with_totals(giant, totals)
    want = Series.of("k", "ts").with_totals(giant, totals)
    assert got.exceptAll(want.select(*got.columns)).isEmpty() and got.count() == 60_000
