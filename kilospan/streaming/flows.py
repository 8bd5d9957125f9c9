"""Continuous forms of ingest, cleaning, windowed load and alerts.

Windowed operators give a result once and need a watermark to know when. The first copy of
each reading can be known only when no copy may come any more, so :func:`run_first_readings`
keeps a table up to date instead: it never drops a late copy and holds nothing back.

Readings carry a naive clock. Event time must be TIMESTAMP, so the clock is carried
as if it were UTC and turned back at the end; the session zone plays no part.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kilospan.functions.calendar import calendar_short, cyclical
from kilospan.functions.clock import epoch_micros
from kilospan.operators import clean
from kilospan.schema import Frequency

EPOCH = "1970-01-01 00:00:00"


def as_event_time(ts) -> Column:
    return F.timestamp_micros(epoch_micros(ts))


def as_naive(ts) -> Column:
    start = F.lit(EPOCH).cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), start)


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files=None):
    """Files of a folder as they arrive; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("ignoreLeadingWhiteSpace", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def with_watermark(df: DataFrame, ts: str, delay: str, name: str = "event_time") -> DataFrame:
    return df.withColumn(name, as_event_time(ts)).withWatermark(name, delay)


def dedupe(df: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Drop repeats of a reading that arrive within the watermark delay. The copy that
    comes first is given out at once; :func:`keep_first` waits and picks."""
    timed = with_watermark(df, ts, delay)
    return timed.dropDuplicatesWithinWatermark([*keys, ts])


def keep_first(
    df: DataFrame, keys: list[str], ts: str, tiebreak: str, delay: str
) -> DataFrame:
    """The copy of each reading with the least ``tiebreak``, given out once the watermark
    has passed the reading's time: until then an earlier copy may still come."""
    timed = with_watermark(df, ts, delay)
    values = [c for c in df.columns if c not in (*keys, ts, tiebreak)]
    first = timed.groupBy("event_time", *keys).agg(
        F.min(tiebreak).alias(tiebreak), *[F.min_by(c, tiebreak).alias(c) for c in values]
    )
    return first.withColumn(ts, as_naive(F.col("event_time"))).select(*df.columns)


class FirstReadings:
    """A table of first readings that micro-batches are merged into.

    A micro-batch writes its own first rows as one run, named by its number, so a batch that
    is repeated after a failure replaces what it wrote. The first row of each key over all
    runs is the first reading: runs may overlap, be read twice or stand beside their own
    merge, since the least of a set stays the least when members repeat. After every
    ``merge_every`` runs they are merged into one, and only then removed.
    """

    def __init__(self, path: str, schema, keys: list[str], tiebreak: str, merge_every: int = 16):
        self.path, self.schema = path.rstrip("/"), schema
        self.keys, self.tiebreak, self.merge_every = list(keys), tiebreak, merge_every

    def read(self, spark: SparkSession) -> DataFrame:
        """The first copy of every reading so far."""
        if not self._folders(spark):
            return spark.createDataFrame([], self.schema)
        runs = spark.read.schema(self.schema).parquet(f"{self.path}/*")
        return clean.keep_first(runs, self.keys, self.tiebreak)

    def add(self, batch: DataFrame, number: int) -> None:
        first = clean.keep_first(batch, self.keys, self.tiebreak)
        first.write.mode("overwrite").parquet(f"{self.path}/run-{number:012d}")
        if (number + 1) % self.merge_every == 0:
            self.merge(batch.sparkSession)

    def merge(self, spark: SparkSession) -> None:
        """All runs as one; the ones it was made of go when it is complete."""
        covered = self._folders(spark)
        self.read(spark).write.parquet(f"{self.path}/merged-{uuid.uuid4().hex}")
        for folder in covered:
            self._files(spark).delete(folder, True)

    def _files(self, spark: SparkSession):
        where = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return where.getFileSystem(spark._jsc.hadoopConfiguration())

    def _folders(self, spark: SparkSession) -> list:
        """Complete runs and merges."""
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/*/_SUCCESS")
        return [s.getPath().getParent() for s in self._files(spark).globStatus(where) or []]


def run_first_readings(df: DataFrame, table: FirstReadings, checkpoint: str) -> None:
    """Merge everything that has arrived into the table, then stop; a restart goes on from
    there. Copies may come in any order and at any time."""
    run = (
        df.writeStream.foreachBatch(table.add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()


def clean_scaled(df: DataFrame, ts: str, value: str, bounds: clean.Bounds, freq: Frequency):
    """Row-wise cleaning with fixed bounds: clip, scale, calendar, cyclical columns."""
    if dict(df.dtypes)[ts] == "string":
        df = clean.parse_timestamps(df, ts)
    rows = clean.clip_and_scale(df.dropna(subset=[ts]), value, f"{value}_scaled", bounds)
    rows = rows.withColumns(calendar_short(ts, freq.step_minutes))
    return rows.withColumns(
        {
            **cyclical("step_of_day", freq.steps_per_day, "step"),
            **cyclical("month", 12, "month"),
        }
    )


def window_load(
    df: DataFrame, keys: list[str], ts: str, value: str, width: str = "30 minutes",
    delay: str = "1 hour",
) -> DataFrame:
    """Load per key and step, given out once the watermark closes the step."""
    timed = with_watermark(df, ts, delay)
    sums = timed.groupBy(F.window("event_time", width), *keys).agg(
        F.sum(value).alias("load"), F.count(F.lit(1)).alias("n_readings")
    )
    return sums.select(*keys, as_naive(F.col("window.start")).alias(ts), "load", "n_readings")


def sliding_stats(
    df: DataFrame, keys: list[str], ts: str, value: str, width: str = "6 hours",
    slide: str = "30 minutes", delay: str = "1 hour",
) -> DataFrame:
    """Mean and deviation over overlapping event-time windows."""
    timed = with_watermark(df, ts, delay)
    stats = timed.groupBy(F.window("event_time", width, slide), *keys).agg(
        F.avg(value).alias("mean"),
        F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("std"),
        F.count(F.lit(1)).alias("n_readings"),
    )
    return stats.select(
        *keys, as_naive(F.col("window.start")).alias("window_start"),
        as_naive(F.col("window.end")).alias("window_end"), "mean", "std", "n_readings",
    )


def alerts(windows: DataFrame, threshold: float, load: str = "load") -> DataFrame:
    """Closed steps whose load reaches the threshold."""
    return windows.where(F.col(load) >= threshold)


def run_available(df: DataFrame, target: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Process everything that is there, then stop; a restart goes on from there."""
    run = (
        df.writeStream.format(fmt).outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    run.awaitTermination()
