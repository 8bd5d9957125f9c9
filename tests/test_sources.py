import datetime as dt
import math
import os

import pytest
from pyspark.sql import functions as F

from kilospan.operators import features
from kilospan.operators.clean import Bounds, keep_first, scaler_bounds
from kilospan.plans import recipes
from kilospan.plans.series import Series
from kilospan.schema import (
    HALF_HOURLY, KWH_COLUMNS, METER_SCHEMA, UNIFIED_COLUMNS, UNIFIED_SCHEMA, narrowed, pick_column,
)
from kilospan.sources import readings, tables


@pytest.fixture()
def meter_csv(tmp_path):
    lines = ["CUSTOMER_ID, READING_DATETIME, CALENDAR_KEY, EVENT_KEY, " + ", ".join(KWH_COLUMNS)]
    start = dt.datetime(2020, 1, 1)
    for i in range(1000):
        ts = start + dt.timedelta(minutes=30 * i)
        load = -0.5 if i == 5 else (i % 17) / 8
        lines.append(f"{100 + i % 3 * 100}, {ts}, 1, 2, {load}, 0.25, 0, 0, 0")
    lines.append("100, broken, 1, 2, 1, 0, 0, 0, 0")
    lines.append("100, 2020-01-01 00:00:00, 1, 2, 99, 0, 0, 0, 0")
    path = tmp_path / "meters.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def write_region(folder, name, column, rows):
    path = folder / name
    path.write_text(f"Datetime,{column}\n" + "".join(f"{t},{x}\n" for t, x in rows))
    return str(path)


def test_typed_scan_with_projection(spark, meter_csv):
    got = readings.read_meters(spark, meter_csv, ["CUSTOMER_ID", "GENERAL_SUPPLY_KWH"])
    assert got.dtypes == [("CUSTOMER_ID", "int"), ("GENERAL_SUPPLY_KWH", "float")]
    assert got.count() == 1002
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "READING_DATETIME" not in plan.split("ReadSchema")[1]


def test_meter_clean_from_file(spark, meter_csv):
    raw = readings.read_meters(spark, meter_csv, ordered=True)
    got = recipes.meter_clean(raw, "CUSTOMER_ID", "READING_DATETIME", readings.FILE_ORDER)
    assert got.count() == 1000
    row = got.where("CUSTOMER_ID = 100 AND READING_DATETIME = '2020-01-01'").first()
    assert row["GENERAL_SUPPLY_KWH"] == 0.0 and row["TOTAL_KWH"] == 0.25
    assert got.agg(F.min("GENERAL_SUPPLY_KWH")).first()[0] == 0.0


def test_unified_contract_from_file(spark, meter_csv):
    raw = readings.read_meters(spark, meter_csv, ordered=True)
    series = Series.of("CUSTOMER_ID", "READING_DATETIME")
    got = recipes.unified_features(
        raw, series, "GENERAL_SUPPLY_KWH", HALF_HOURLY, Bounds(0.0, 2.0),
        tiebreak=readings.FILE_ORDER,
    )
    assert got.columns == UNIFIED_COLUMNS and got.count() == 1000
    stored = narrowed(got)
    assert [f.dataType for f in stored.schema] == [f.dataType for f in UNIFIED_SCHEMA]
    assert got.dropna().count() == 1000
    simple = recipes.simple_features(
        raw, series, "GENERAL_SUPPLY_KWH", HALF_HOURLY, Bounds(0.0, 2.0),
        tiebreak=readings.FILE_ORDER,
    )
    assert len(simple.columns) == 14 and simple.count() == 1000


def test_file_order_keeps_the_first_line(spark, meter_csv):
    raw = readings.read_meters(spark, meter_csv, ordered=True)
    once = keep_first(raw, ["CUSTOMER_ID", "READING_DATETIME"], readings.FILE_ORDER)
    row = once.where("CUSTOMER_ID = 100 AND READING_DATETIME = '2020-01-01 00:00:00'").first()
    assert row["GENERAL_SUPPLY_KWH"] == 0.0


def test_regions_by_place_and_by_name(spark, tmp_path):
    a = write_region(tmp_path, "EAST_hourly.csv", "EAST_MW", [("2020-01-01 00:00:00", 5), ("x", 6)])
    b = write_region(tmp_path, "WEST_hourly.csv", "WEST_MW", [("2020-01-01 01:00:00", 7.5), ("2020-01-01 02:00:00", "")])
    want = {("EAST", 0, 5.0), ("WEST", 1, 7.5), ("WEST", 2, None)}
    flat = lambda df: {(r["region"], r["ts"].hour, r["load_val"]) for r in df.collect()}
    assert flat(readings.read_regions(spark, [a, b])) == want
    with pytest.warns(UserWarning, match="skipped"):
        listed = readings.read_region_files(spark, [a, str(tmp_path / "gone_hourly.csv"), b])
    assert flat(listed) == want
    with pytest.warns(UserWarning), pytest.raises(FileNotFoundError):
        readings.read_region_files(spark, [str(tmp_path / "gone.csv")])


def test_meter_columns_go_by_name(spark, tmp_path):
    values = {"CUSTOMER_ID": "7", "READING_DATETIME": "2020-01-01 00:00:00", "CALENDAR_KEY": "1", "EVENT_KEY": "2"}
    values |= dict.fromkeys(KWH_COLUMNS, "0.5")

    def write(name, names, extra=()):
        lines = [", ".join([*names, *extra]), ", ".join([*[values[n.strip()] for n in names], *extra])]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        return str(tmp_path / name)

    names = list(METER_SCHEMA.names)
    swapped = write("b.csv", [names[1], names[0], *names[2:]])
    wider = write("a.csv", names, ("REMARK",))
    both = readings.read_meters(spark, [swapped, wider], ordered=True)
    assert both.columns == [*names, readings.FILE_ORDER]
    rows = both.orderBy(readings.FILE_ORDER).collect()
    assert [(r["CUSTOMER_ID"], r["READING_DATETIME"], r["OTHER_KWH"]) for r in rows] == [
        (7, "2020-01-01 00:00:00", 0.5)
    ] * 2
    assert rows[0][readings.FILE_ORDER] < 1 << readings.BLOCK_BITS <= rows[1][readings.FILE_ORDER]
    few = write("c.csv", names[:3])
    with pytest.raises(ValueError, match="EVENT_KEY"):
        readings.read_meters(spark, few)
    assert readings.read_meters(spark, few, ["CUSTOMER_ID"]).first()[0] == 7
    twice = tmp_path / "d.csv"
    twice.write_text("CUSTOMER_ID, customer_id\n1, 2\n")
    with pytest.raises(ValueError):
        readings.read_meters(spark, str(twice), ["CUSTOMER_ID"])


def test_file_order_dedupes_in_a_hash_aggregate(spark, meter_csv):
    raw = readings.read_meters(spark, meter_csv, ["CUSTOMER_ID", "EVENT_KEY", "OTHER_KWH"], ordered=True)
    once = keep_first(raw, ["CUSTOMER_ID", "EVENT_KEY"], readings.FILE_ORDER)
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_region_files_fall_back_and_refuse_doubt(spark, tmp_path):
    write_region(tmp_path, "EAST_preprocessed.csv", "load_val", [("2020-01-01 00:00:00", 5)])
    write_region(tmp_path, "all_unified_preprocessed.csv", "load_val", [("2020-01-01 00:00:00", 9)])
    got = readings.read_regions(spark, str(tmp_path / "*_hourly.csv"), fallback=str(tmp_path))
    assert [(r["region"], r["load_val"]) for r in got.collect()] == [("EAST", 5.0)]
    (tmp_path / "odd_hourly.csv").write_text("load_a,Datetime,load_b\n1,2020-01-01 00:00:00,2\n")
    with pytest.raises(ValueError, match="several"):
        readings.read_regions(spark, str(tmp_path / "odd_hourly.csv"))
    (tmp_path / "turned_hourly.csv").write_text("X_MW, Datetime\n1,2020-01-01 00:00:00\n")
    row = readings.read_regions(spark, str(tmp_path / "turned_hourly.csv")).first()
    assert (row["region"], row["load_val"]) == ("turned", 1.0)


def test_wide_regions(spark, tmp_path):
    path = tmp_path / "all.csv"
    path.write_text("Datetime,A,B\n2020-01-01 00:00:00,1,\n2020-01-01 01:00:00,2,3\n")
    got = readings.read_wide_regions(spark, str(path))
    assert {(r["region"], r["ts"].hour, r["load_val"]) for r in got.collect()} == {
        ("A", 0, 1.0), ("A", 1, 2.0), ("B", 1, 3.0)
    }


def test_names_from_files(spark, tmp_path):
    (tmp_path / "two_branch_100.csv").write_text("p\n1\n")
    parts = readings.model_and_entity_from_file()
    df = spark.read.option("header", True).csv(str(tmp_path)).select(
        *[c.alias(n) for n, c in parts.items()]
    )
    assert tuple(df.first()) == ("two_branch", "100")


def test_pick_column():
    assert pick_column(["Datetime", "AEP_MW"], ("mw", "load")) == "AEP_MW"
    assert pick_column(["a", "b"], ("mw",), default="b") == "b"
    with pytest.raises(ValueError):
        pick_column(["a"], ("mw",))


@pytest.mark.parametrize("codec", ["snappy", "gzip", "zstd", "none"])
def test_parquet_round_trip(spark, tmp_path, codec):
    df = spark.createDataFrame([(1, 0.5, "a"), (2, math.pi, "b"), (3, None, None)],
                               "id int, value double, name string")
    path = str(tmp_path / "t")
    assert tables.write_parquet(df, path, codec, sort_by=["id"]) == 3
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == sorted(map(tuple, df.collect()))


def test_conversion_report(spark, tmp_path):
    df = spark.range(10_000).selectExpr("cast(id AS int) id", "id / 7 AS value", "'cat' AS category")
    src = str(tmp_path / "csv")
    tables.write_csv(df, src)
    report = tables.csv_to_parquet(spark, src, str(tmp_path / "pq"), df.schema).first()
    assert report["n_rows"] == 10_000
    assert report["parquet_bytes"] < report["csv_bytes"] and report["ratio"] > 1
    real = sum(os.path.getsize(os.path.join(src, f)) for f in os.listdir(src) if f.endswith(".csv"))
    assert report["csv_bytes"] == real


def test_unknown_codec(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.write_parquet(spark.range(1), str(tmp_path / "x"), "rar")


def test_entity_filter_reaches_the_scan(spark, tmp_path):
    df = spark.range(100).selectExpr("id % 5 AS k", "id AS ts", "id * 2 AS x")
    path = str(tmp_path / "t")
    assert tables.write_by_entity(df, path, "k", "ts") == 100
    got = tables.entity_series(spark.read.parquet(path).select("k", "ts"), "k", "ts", 3)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,3)" in plan and "x:bigint" not in plan
    assert [r["ts"] for r in got.collect()] == list(range(3, 100, 5))
    stored = spark.read.parquet(path)
    assert tables.entity_or_first(stored, "k", 4) == 4
    assert tables.entity_or_first(stored, "k", 77) == 0


def test_bounds_record(spark, tmp_path):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    path = str(tmp_path / "bounds")
    tables.write_bounds(scaler_bounds(df, "x"), path)
    assert tables.read_bounds(spark, path) == Bounds(0.0, pytest.approx(2.998))
    (tmp_path / "part.json").write_text('{"min": 0.5}')
    assert tables.read_bounds(spark, str(tmp_path / "part.json")) == Bounds(0.5, 2.929)


def test_metrics_record(spark, tmp_path):
    df = spark.createDataFrame([("m", 7, 1.0, 2.0, 3.0, None)],
                               "model string, k int, mae double, rmse double, mape double, r2 double")
    path = str(tmp_path / "metrics")
    tables.metrics_records(df, F.col("k")).write.json(path)
    assert tuple(tables.read_metrics(spark, path).first()) == ("m", "7", 1.0, 2.0, 3.0, None)


def test_samples_store_by_split(spark, tmp_path):
    df = spark.createDataFrame([([[1.0, 2.0]], "train"), ([[3.0, 4.0]], "test")],
                               "basic array<array<float>>, split string")
    path = str(tmp_path / "s")
    tables.write_parquet(df, path, partition_by=["split"])
    assert sorted(d for d in os.listdir(path) if "=" in d) == ["split=test", "split=train"]
    assert spark.read.parquet(path).where("split = 'test'").first()["basic"] == [[3.0, 4.0]]


def test_meter_schema_covers_the_source():
    assert METER_SCHEMA.names[:4] == ["CUSTOMER_ID", "READING_DATETIME", "CALENDAR_KEY", "EVENT_KEY"]


def jobs_of(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    try:
        run()
    finally:
        spark.sparkContext.setJobGroup("other", "other")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_headers_of_many_files_take_two_jobs(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(2000):
        names = "CUSTOMER_ID,READING_DATETIME" if i % 3 else "READING_DATETIME,CUSTOMER_ID"
        cells = f"{i},2020-01-01" if i % 3 else f"2020-01-01,{i}"
        (folder / f"m{i:04d}.csv").write_text(f"{names}\n{cells}\n" if i % 100 else "")
    files = []
    first = jobs_of(spark, "list", lambda: files.extend(readings._files(spark, str(folder))))
    found = {}
    second = jobs_of(spark, "head", lambda: found.update(readings._headers(spark, str(folder), None, files)))
    assert (first, second) == (1, 1)
    assert {k: len(v) for k, v in found.items()} == {
        ("CUSTOMER_ID", "READING_DATETIME"): 1333 - 13, ("READING_DATETIME", "CUSTOMER_ID"): 667 - 7
    }
    rows = readings.read_meters(spark, str(folder), ["CUSTOMER_ID"], ordered=True)
    got = [r[0] for r in rows.orderBy(readings.FILE_ORDER).collect()]
    assert got == [i for i in range(2000) if i % 100]


def test_large_files_are_not_read_for_their_headers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readings, "SMALL_FILE", 100)
    for i in range(3):
        lines = [f"CUSTOMER_ID,X{i}", *(f"{j},{i}" for j in range(60_000))]
        (tmp_path / f"big{i}.csv").write_text("\n" * i + "\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    files = readings._files(spark, str(tmp_path))
    found = readings._headers(spark, str(tmp_path), None, files)
    assert set(found) == {("CUSTOMER_ID", f"X{i}") for i in range(3)}
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
    rows = readings.read_meters(spark, str(tmp_path), ["CUSTOMER_ID"], ordered=True)
    assert rows.count() == 180_000
    got = rows.orderBy(readings.FILE_ORDER).select("CUSTOMER_ID").toPandas()["CUSTOMER_ID"].tolist()
    assert got == list(range(60_000)) * 3


def test_quoted_headers_and_marks(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('\ufeff"CUSTOMER_ID" , "A, B",\n7,1,2\n'.encode())
    files = readings._files(spark, str(tmp_path))
    assert list(readings._headers(spark, str(tmp_path), None, files)) == [("CUSTOMER_ID", "A, B", "_c2")]


def test_file_order_beyond_half_a_million_files(spark, tmp_path):
    (tmp_path / "z.csv").write_text("CUSTOMER_ID\n1\n2\n")
    (mine,) = readings._files(spark, str(tmp_path))
    others = [readings.RawFile(f"file:/none/{i:07d}.csv", 128 << 20) for i in range(800_000)]
    raw = spark.read.option("header", True).csv(mine.path)
    got = [r[0] for r in readings.with_file_order(raw, [*others, mine]).select(readings.FILE_ORDER).collect()]
    assert got == [(800_000 << readings.BLOCK_BITS) + i for i in range(2)]
    with pytest.raises(ValueError, match="63 bits"):
        readings.with_file_order(raw, [readings.RawFile("x", 1 << 50)] * (1 << 13))


def test_a_store_grows_and_needs_no_exchange(spark, tmp_path):
    path = str(tmp_path / "store")
    start = dt.datetime(2020, 1, 1)
    rows = lambda lo, hi: spark.createDataFrame(
        [(k, start + dt.timedelta(hours=i), float(i)) for i in range(lo, hi) for k in (1, 2, None)],
        "k int, ts timestamp_ntz, x double",
    )
    store = tables.ReadingStore("grown_store", path, "k", "ts", buckets=4)
    store.append(rows(0, 10))
    store.append(rows(10, 25), Series.of("k", "ts", largest=60, total=75))
    series = Series.of("k", "ts").measured(store.open(spark))
    assert (series.largest, series.total) == (25, 75)
    got = features.rolling(features.lags(store.open(spark), series, "x", {"a": 1}), series, "x", 3, partial=True)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.where("a = x - 1").count() == 24 * 3
    once = keep_first(store.open(spark), ["k", "ts"], "x")
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString()
    # another session knows the path alone
    spark.sql("DROP TABLE grown_store")
    again = tables.ReadingStore("grown_again", path, "k", "ts", buckets=4).open(spark)
    assert again.count() == 75
    assert "Exchange" not in features.lags(again, series, "x", {"a": 1})._jdf.queryExecution().executedPlan().toString()


def test_appends_to_one_output(spark, tmp_path):
    target = str(tmp_path / "out")
    for i in range(3):
        part = spark.range(i * 10, i * 10 + 10).select("id", F.lit(i).alias("part"))
        assert tables.write_parquet(part, target, sort_by=["id"], partition_by=["part"], mode="append") == 10
    got = spark.read.parquet(target)
    assert got.count() == 30 and sorted(r[0] for r in got.select("id").collect()) == list(range(30))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.write_parquet(spark.range(1).withColumn("part", F.lit(0)), target)
