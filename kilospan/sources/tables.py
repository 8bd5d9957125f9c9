"""Stored tables: Parquet and CSV sinks, conversion reports, small JSON records."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kilospan.operators.clean import Bounds
from kilospan.plans.series import Series
from kilospan.plans.sizes import checkpoint_folder
from kilospan.schema import DEFAULT_SCALER_MAX, DEFAULT_SCALER_MIN

CODECS = ("snappy", "gzip", "zstd", "none")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the folder the cluster shares."""
    return f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Fixed value: the default pattern would cut timestamps to milliseconds.
NTZ_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).option("timestampNTZFormat", NTZ_FORMAT).csv(path)


def write_parquet(
    df: DataFrame, path: str, codec: str = "snappy", sort_by: list[str] = (),
    partition_by: list[str] = (), mode: str = "errorifexists",
) -> int:
    """Write and return the row count, counted on the way through.

    ``sort_by`` orders rows inside each file, which gives row groups narrow value
    ranges and lets a filter on an entity skip most of them.
    """
    if codec not in CODECS:
        raise ValueError(f"codec must be one of {CODECS}")
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.mode(mode).option("compression", codec).partitionBy(*partition_by).parquet(path)
    return seen.get["n"]


def write_by_entity(df: DataFrame, path: str, key: str, ts: str, codec: str = "snappy") -> int:
    """Parquet ordered by entity and time in files of even size, a long entity
    spread over several of them."""
    ranged = df.repartitionByRange(F.col(key), F.col(ts))
    return write_parquet(ranged, path, codec, sort_by=[key, ts])


@dataclass(frozen=True)
class ReadingStore:
    """Readings in files by hash of the series key, ordered by key and time inside a file.

    A window, dedupe or aggregate per key over the opened table needs no exchange, however
    often the table was appended to; joins of two stores with as many buckets need none
    either. The table is external: ``open`` finds it by its path in any session.
    """

    name: str
    path: str
    key: str
    ts: str
    buckets: int = 200

    def append(self, df: DataFrame, series: Series | None = None) -> None:
        """Add rows; the first call makes the table.

        Rows are brought together by key first, so that an append adds one file per bucket.
        If ``series`` says that one key holds more than twice a bucket's share, they are
        written from where they lie: more files, but no task that writes a third of them.
        """
        even = series is None or series.largest is None or not series.total or (
            series.largest * self.buckets <= 2 * series.total
        )
        rows = df.repartition(self.buckets, F.col(self.key)) if even else df
        self._known(df.sparkSession, df.schema)
        (
            rows.select(*df.sparkSession.table(self.name).columns).write.format("parquet")
            .mode("append").bucketBy(self.buckets, self.key).sortBy(self.key, self.ts)
            .saveAsTable(self.name)
        )

    def open(self, spark: SparkSession, schema=None) -> DataFrame:
        """The stored table; ``schema`` is read from its files if this session has not yet
        seen it."""
        if not spark.catalog.tableExists(self.name):
            self._known(spark, schema or spark.read.parquet(self.path).schema)
        return spark.table(self.name)

    def _known(self, spark: SparkSession, schema) -> None:
        """Tell the session's catalog of the path and its layout."""
        if spark.catalog.tableExists(self.name):
            return
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE {self.name} ({columns}) USING parquet "
            f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`, `{self.ts}`) "
            f"INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )


def stored_bytes(spark: SparkSession, path: str, pattern: str = "*") -> int:
    """Size of the files below a path, without reading their content."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern).load(path)
    )
    return files.agg(F.sum("length")).first()[0] or 0


def csv_to_parquet(
    spark: SparkSession, source: str, target: str, schema, codec: str = "snappy",
    select: list[Column] | None = None,
) -> DataFrame:
    """Convert and report: rows, bytes on both sides, their ratio and the minutes."""
    start = time.monotonic()
    rows = (
        spark.read.schema(schema).option("header", True)
        .option("ignoreLeadingWhiteSpace", True)
        .option("timestampNTZFormat", NTZ_FORMAT).csv(source)
    )
    n = write_parquet(rows if select is None else rows.select(*select), target, codec)
    minutes = (time.monotonic() - start) / 60
    before = stored_bytes(spark, source, "*.csv")
    after = stored_bytes(spark, target, "*.parquet")
    return spark.createDataFrame(
        [(n, before, after, before / after if after else None, minutes)],
        "n_rows bigint, csv_bytes bigint, parquet_bytes bigint, ratio double, minutes double",
    )


def convert_csv(df: DataFrame) -> DataFrame:
    """Write a table as CSV, convert that to Parquet and read the result back."""
    spark = df.sparkSession
    source, target = scratch(spark, "csv"), scratch(spark, "parquet")
    write_csv(df, source)
    report = csv_to_parquet(spark, source, target, df.schema).first()
    if report["n_rows"] == 0:
        raise ValueError("nothing was converted")
    return spark.read.parquet(target)


def entity_series(df: DataFrame, key: str, ts: str, entity) -> DataFrame:
    """One entity's rows in time order; the filter reaches the scan."""
    return df.where(F.col(key) == F.lit(entity)).orderBy(ts)


def entity_or_first(df: DataFrame, key: str, entity):
    """The entity if it has rows, else the least one present."""
    if not df.where(F.col(key) == F.lit(entity)).isEmpty():
        return entity
    return df.agg(F.min(key)).first()[0]


# -- records ---------------------------------------------------------------------


def write_bounds(table: DataFrame, path: str) -> None:
    """``table`` is the one-row (min, max) of ``scaler_bounds``."""
    table.coalesce(1).write.json(path)


def read_bounds(spark: SparkSession, path: str) -> Bounds:
    row = spark.read.schema("min double, max double").json(path).select(
        F.coalesce("min", F.lit(DEFAULT_SCALER_MIN)).alias("min"),
        F.coalesce("max", F.lit(DEFAULT_SCALER_MAX)).alias("max"),
    ).first()
    return Bounds(row["min"], row["max"])


METRICS_SCHEMA = (
    "model string, customer_id string, "
    "metrics_physical_scale struct<MAE: double, RMSE: double, MAPE: double, R2: double>"
)


def metrics_records(metrics: DataFrame, entity: Column) -> DataFrame:
    """Score rows as nested records."""
    nested = F.struct(
        F.col("mae").alias("MAE"), F.col("rmse").alias("RMSE"),
        F.col("mape").alias("MAPE"), F.col("r2").alias("R2"),
    )
    return metrics.select(
        "model", entity.cast("string").alias("customer_id"),
        nested.alias("metrics_physical_scale"),
    )


def read_metrics(spark: SparkSession, paths) -> DataFrame:
    """Flat scores from stored records; what a record lacks stays NULL."""
    rows = spark.read.schema(METRICS_SCHEMA).json(paths)
    m = F.col("metrics_physical_scale")
    return rows.select(
        "model", "customer_id", m["MAE"].alias("mae"), m["RMSE"].alias("rmse"),
        m["MAPE"].alias("mape"), m["R2"].alias("r2"),
    )
