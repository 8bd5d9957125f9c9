"""Properties that must hold for any input."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kilospan.functions import scalars as S
from kilospan.operators import clean, resample, split
from kilospan.plans.series import Series

START = dt.datetime(2024, 2, 28)
few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
readings = st.lists(
    st.tuples(st.sampled_from("ab"), st.integers(0, 60), st.one_of(st.none(), st.floats(-50, 50))),
    min_size=1, max_size=40,
)
S_KT = Series.of("k", "ts")


def frame(spark, rows):
    data = [(k, START + dt.timedelta(hours=h), x, i) for i, (k, h, x) in enumerate(rows)]
    return spark.createDataFrame(data, "k string, ts timestamp_ntz, x double, seq int")


@few
@given(rows=readings)
def test_grid_is_contiguous_and_known_points_stay(spark, rows):
    once = clean.keep_first(frame(spark, rows), ["k", "ts"], "seq")
    known = {(r["k"], r["ts"]): r["x"] for r in once.collect()}
    filled = [tuple(r) for r in resample.interpolate(once, S_KT, "x", 3600).collect()]
    for k in {k for k, _ in known}:
        times = sorted(t for kk, t, _ in filled if kk == k)
        mine = [t for kk, t in known if kk == k]
        span = int((max(mine) - min(mine)).total_seconds() // 3600) + 1
        assert times == [min(mine) + dt.timedelta(hours=i) for i in range(span)]
        values = [x for (kk, _), x in known.items() if kk == k and x is not None]
        for kk, t, x in filled:
            if kk != k:
                continue
            if known.get((k, t)) is not None:
                assert x == known[k, t]
            elif x is not None:
                assert min(values) - 1e-9 <= x <= max(values) + 1e-9


@few
@given(rows=readings)
def test_split_keeps_every_row_once(spark, rows):
    once = clean.keep_first(frame(spark, rows), ["k", "ts"], "seq")
    for s in (S_KT, Series.of("k", "ts", rows_per_block=5)):
        parts = split.split_by_fraction(once, s)
        assert sorted(r["seq"] for r in parts.collect()) == sorted(r["seq"] for r in once.collect())


@few
@given(xs=st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=30),
       lo=st.floats(-100, 100), width=st.floats(0.5, 1000))
def test_clip_scale_and_back(spark, xs, lo, width):
    hi = lo + width
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    df = df.withColumn("c", S.clip("x", lo, hi)).withColumn("s", S.minmax("c", lo, hi))
    back = df.withColumn("b", S.unscale("s", lo, hi))
    for r in back.collect():
        assert lo <= r["c"] <= hi and -1e-9 <= r["s"] <= 1 + 1e-9
        assert abs(r["b"] - r["c"]) <= 1e-9 * max(1.0, abs(lo), abs(hi))


@few
@given(xs=st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=30), places=st.integers(0, 6))
def test_rounding_stays_within_half_a_unit(spark, xs, places):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    for r in df.select("x", S.rounded("x", places).alias("y")).collect():
        assert abs(r["x"] - r["y"]) <= 0.5 * 10**-places + 1e-9


@few
@given(rows=readings)
def test_outlier_clip_stays_inside_its_fence(spark, rows):
    once = clean.keep_first(frame(spark, rows), ["k", "ts"], "seq").where(F.col("x").isNotNull())
    fenced = clean.with_fences(once, S_KT, "x").withColumn("c", S.clip("x", "lower", "upper"))
    assert fenced.where("c < lower OR c > upper").count() == 0
