"""Streams against the batch operators on the same files."""

import datetime as dt

import pytest

from kilospan.operators import clean
from kilospan.schema import HALF_HOURLY
from kilospan.streaming import flows

START = dt.datetime(2024, 3, 31)
SCHEMA = "k string, ts timestamp_ntz, x double, seq int"


def rows(minutes, k="a"):
    return [(k, START + dt.timedelta(minutes=m), float(m), i) for i, m in enumerate(minutes)]


@pytest.fixture()
def folder(spark, tmp_path):
    path = str(tmp_path / "in")

    def add(data, mode="append"):
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode(mode).parquet(path)

    add.path = path
    add.out = str(tmp_path / "out")
    add.progress = str(tmp_path / "progress")
    return add


def run(spark, stream, folder):
    flows.run_available(stream, folder.out, folder.progress)
    return spark.read.schema(stream.schema).parquet(folder.out)


def test_incremental_ingest_resumes(spark, folder):
    folder(rows([0, 30]))
    stream = lambda: flows.read_stream(spark, folder.path, SCHEMA, max_files=1)
    assert run(spark, stream(), folder).count() == 2
    folder(rows([60]))
    assert run(spark, stream(), folder).count() == 3


def test_csv_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("k, t\na, 1\nb, 2\n")
    stream = flows.read_stream(spark, str(tmp_path / "in"), "k string, t int", "csv")
    flows.run_available(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_dedupe_across_files(spark, folder):
    folder(rows([0, 30, 0]))
    folder(rows([30, 60]))
    stream = flows.dedupe(flows.read_stream(spark, folder.path, SCHEMA, max_files=1), ["k"], "ts", "1 day")
    got = run(spark, stream.select("k", "ts"), folder)
    assert got.count() == 3


def test_keep_first_across_files(spark, folder):
    folder([("a", START, 1.0, 7), ("a", START, 2.0, 3), ("b", START, 9.0, 1)])
    folder([("a", START, None, 2), ("a", START + dt.timedelta(hours=1), 4.0, 8)])
    folder([("a", START + dt.timedelta(hours=9), 5.0, 9)])
    stream = flows.read_stream(spark, folder.path, SCHEMA, max_files=1)
    got = run(spark, flows.keep_first(stream, ["k"], "ts", "seq", "2 hours"), folder)
    assert got.columns == ["k", "ts", "x", "seq"]
    assert {(r["k"], r["ts"].hour, r["x"], r["seq"]) for r in got.collect()} == {
        ("a", 0, None, 2), ("b", 0, 9.0, 1), ("a", 1, 4.0, 8)
    }


def first_table(folder, **kw):
    return flows.FirstReadings(folder.out, SCHEMA, ["k", "ts"], "seq", **kw)


def first_rows(spark, folder, table):
    stream = flows.read_stream(spark, folder.path, SCHEMA, max_files=1)
    flows.run_first_readings(stream, table, folder.progress)
    return {(r["k"], r["ts"], r["x"], r["seq"]) for r in table.read(spark).collect()}


def batch_first(spark, folder):
    got = clean.keep_first(spark.read.schema(SCHEMA).parquet(folder.path), ["k", "ts"], "seq")
    return {(r["k"], r["ts"], r["x"], r["seq"]) for r in got.collect()}


@pytest.mark.parametrize("merge_every", [1, 2, 16])
def test_first_readings_lose_nothing(spark, folder, merge_every):
    table = first_table(folder, merge_every=merge_every)
    day = dt.timedelta(days=1)
    folder([("a", START, 1.0, 7), ("a", START, 2.0, 3), ("b", START, 9.0, 1), (None, START, 4.0, 2)])
    folder([("a", START + 30 * day, 5.0, 8), ("a", None, 6.0, 9)])
    assert first_rows(spark, folder, table) == batch_first(spark, folder)
    # a month late: an earlier copy, a later copy and a reading of its own, after a restart
    folder([("a", START, None, 2), ("b", START, 0.0, 6)])
    folder([("b", START + day, 3.0, 10), ("a", None, 1.0, 4)])
    got = first_rows(spark, folder, table)
    assert got == batch_first(spark, folder)
    assert ("a", START, None, 2) in got and ("a", START + 30 * day, 5.0, 8) in got


def test_a_repeated_batch_changes_nothing(spark, folder):
    table = first_table(folder, merge_every=2)
    batches = [
        spark.createDataFrame(rows([0, 30, 0]), SCHEMA),
        spark.createDataFrame([("a", START, 8.0, -1), ("c", START, 1.0, 5)], SCHEMA),
    ]
    for number, batch in enumerate(batches):
        table.add(batch, number)
    want = sorted(map(tuple, table.read(spark).collect()))
    for number, batch in enumerate(batches):
        table.add(batch, number)
        assert sorted(map(tuple, table.read(spark).collect())) == want
    assert want[0][1:] == (START, 8.0, -1)


def test_a_table_without_runs_is_empty(spark, folder):
    assert first_table(folder).read(spark).count() == 0


def test_clean_equals_batch(spark, folder):
    folder(rows([0, 15, 45, 700]))
    bounds = clean.Bounds(10.0, 500.0)
    build = lambda df: flows.clean_scaled(df, "ts", "x", bounds, HALF_HOURLY)
    got = run(spark, build(flows.read_stream(spark, folder.path, SCHEMA)), folder)
    want = build(spark.read.parquet(folder.path))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_windows_close_and_late_rows_are_left_out(spark, folder):
    folder(rows([5, 20, 40]))
    folder(rows([600]))
    stream = lambda: flows.window_load(
        flows.read_stream(spark, folder.path, SCHEMA, max_files=1), ["k"], "ts", "x", delay="1 hour"
    )
    assert run(spark, stream(), folder).count() == 2
    folder([("a", START + dt.timedelta(minutes=10), 1000.0, 9)])
    folder(rows([900]))
    got = {r["ts"]: (r["load"], r["n_readings"]) for r in run(spark, stream(), folder).collect()}
    assert got[START] == (25.0, 2)
    assert got[START + dt.timedelta(minutes=30)] == (40.0, 1)
    assert START + dt.timedelta(minutes=900) not in got


def test_alerts(spark, folder):
    folder(rows([5, 40, 600]))
    loads = flows.window_load(flows.read_stream(spark, folder.path, SCHEMA), ["k"], "ts", "x")
    got = run(spark, flows.alerts(loads, 30.0), folder)
    assert [r["load"] for r in got.collect()] == [40.0]


def test_sliding_stats(spark, folder):
    folder(rows([0, 30, 60, 2000]))
    stats = flows.sliding_stats(flows.read_stream(spark, folder.path, SCHEMA), ["k"], "ts", "x")
    got = {r["window_start"]: r for r in run(spark, stats, folder).collect()}
    row = got[START]
    assert (row["mean"], row["std"], row["n_readings"]) == (30.0, 30.0, 3)
    assert got[START + dt.timedelta(minutes=60)]["std"] == 0.0
