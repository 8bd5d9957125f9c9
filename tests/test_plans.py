"""Shapes of physical plans: exchanges, pushdown, no Python, no Cartesian products."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  registers all queries
import kilospan.queries
from kilospan.operators import clean, metrics
from kilospan.operators.clean import Bounds
from kilospan.plans import recipes, sizes
from kilospan.plans.series import Series
from kilospan.schema import HALF_HOURLY, UNIFIED_COLUMNS

QUERIES = kilospan.queries.QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def even(spark):
    """Readings spread evenly over many customers."""
    return spark.range(4000).selectExpr(
        "cast(id % 100 AS int) AS k",
        "timestampadd(MINUTE, 30 * (id div 100), timestamp_ntz'2024-01-01') AS ts",
        "id % 13 / 4 AS x", "id AS seq",
    )


def test_unified_features_shuffles_once(even):
    got = recipes.unified_features(
        even, Series.of("k", "ts"), "x", HALF_HOURLY, Bounds(0.0, 3.0), tiebreak="seq"
    )
    text = plan(got)
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert text.count("Window [") == 1
    moved = re.search(r"Exchange hashpartitioning.*", text)
    assert moved and "sin" not in moved.group(0).lower()
    assert got.columns == UNIFIED_COLUMNS


def test_a_dominant_series_is_deduped_before_it_moves(spark, even):
    hot = even.withColumn("k", F.when(F.col("seq") % 3 == 0, 0).otherwise(F.col("k")))
    series = Series.of("k", "ts").measured(hot)
    assert not series.cut and series.gathered(hot) is hot
    text = plan(clean.keep_first(hot, ["k", "ts"], "seq"))
    assert text.index("partial_min_by") > text.index("Exchange hashpartitioning(k")


def test_rank_limit_comes_before_the_shuffle(even):
    text = plan(metrics.horizon_head(even, ["k"], "ts", 48))
    assert text.rindex("WindowGroupLimit") > text.index("Exchange")


def test_date_filter_is_pushed_down(spark, sf):
    got = QUERIES["date_range"](spark, sf)
    text = plan(got)
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text and "props" not in text


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_python_and_no_products(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_lookups_are_lazy_equi_joins(spark, even):
    table = even.groupBy("k").agg(F.avg("x").alias("m"))
    small = sizes.left_lookup(even, table, ["k"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = sizes.left_lookup(even, table, ["k"])
        assert "SortMergeJoin" in plan(large) and "Broadcast" not in plan(large)
        rows = sorted(map(tuple, large.collect()))
        kept = sizes.keep_keys(even, table.where("k < 50"), ["k"])
        assert kept.count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == sorted(map(tuple, small.collect()))


def test_null_keys_find_their_row(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "k string, x int")
    table = spark.createDataFrame([(None, 10), ("a", 20)], "k string, y int")
    got = sizes.left_lookup(df, table, ["k"])
    assert sorted(map(tuple, got.select("x", "y").collect())) == [(1, 10), (2, 20)]


def test_checkpoints_need_a_shared_folder_on_a_cluster(spark):
    class Elsewhere:
        class sparkContext:
            master = "spark://somewhere"

        class conf:
            get = staticmethod(lambda *_: None)

    with pytest.raises(RuntimeError):
        sizes.checkpoint_folder(Elsewhere)


ONE_DEDUPE = [
    "lag_features", "lag_features_cut", "lag_zero_fill", "rolling_full", "rolling_partial",
    "rolling_partial_cut", "lead_target", "lead_target_cut", "past_k_stats", "same_slot_stats",
    "split_fraction", "split_fraction_cut", "split_report", "sequence_samples",
    "minmax_scale_self", "min_history",
]


@pytest.mark.parametrize("name", ONE_DEDUPE)
def test_readings_are_deduped_once(spark, sf, name, monkeypatch):
    """Of all plans a query runs, one dedupes; lengths come from the raw keys."""
    from kilospan.operators import samples
    from kilospan.plans import series

    plans = []
    real = sizes.checkpointed

    def noted(df):
        plans.append(plan(df))
        return real(df)

    for module in (sizes, series, clean, samples):
        monkeypatch.setattr(module, "checkpointed", noted)
    plans.append(plan(QUERIES[name](spark, sf)))
    # a dedupe is an aggregate by key and time, in the map tasks and behind their exchange
    by_reading = r"Aggregate\(keys=\[customer_id#\w+, ts#\w+\]"
    assert [n for n in (len(re.findall(by_reading, p)) for p in plans) if n] == [2]


SELECTED = ["cap_p999", "meter_clean", "describe_load", "iqr_outliers", "scaler_bounds", "quantiles"]


@pytest.mark.parametrize("name", SELECTED)
def test_quantiles_are_selected_beyond_the_limit(spark, sf, name, monkeypatch):
    """With a limit of ten rows every quantile takes the two passes."""
    import oracle

    from kilospan.plans import quantiles

    monkeypatch.setattr(quantiles, "MAX_DISTINCT", 10)
    monkeypatch.setattr(quantiles.exact_quantiles, "__kwdefaults__", {
        **quantiles.exact_quantiles.__kwdefaults__, "max_distinct": 10,
    })
    monkeypatch.setattr(clean, "MAX_DISTINCT", 10)
    monkeypatch.setattr(recipes, "MAX_DISTINCT", 10)
    passes = []
    real = quantiles._selected
    monkeypatch.setattr(quantiles, "_selected", lambda *a: passes.append(1) or real(*a))
    got = QUERIES[name](spark, sf).toPandas()
    want = oracle.connect(sf).execute(kilospan.queries.ORACLES[name]).df()
    assert oracle.differences(got, want) == [] and len(got)
    assert passes == [1]


@pytest.mark.parametrize("n_columns, by", [(1, []), (7, []), (3, ["k"])])
def test_quantiles_take_two_passes(spark, tmp_path, n_columns, by, monkeypatch):
    from kilospan.plans import quantiles

    path = str(tmp_path / "x")
    columns = {f"c{i}": F.col(f"c{i}") for i in range(n_columns)}
    spark.range(20_000).select(
        (F.col("id") % 3).alias("k"), *[F.rand(i).alias(c) for i, c in enumerate(columns)]
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    plans = []
    real = quantiles.checkpointed
    monkeypatch.setattr(quantiles, "checkpointed", lambda d: plans.append(plan(d)) or real(d))
    got = quantiles.exact_quantiles(rows, columns, [0.001, 0.5, 0.999], by, max_distinct=100, superset=rows)
    plans.append(plan(got))
    assert sum(p.count("FileScan") for p in plans) == 2
    want = rows.groupBy(*by).agg(
        *[F.percentile(c, F.array(*map(F.lit, [0.001, 0.5, 0.999]))).alias(c) for c in columns]
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
