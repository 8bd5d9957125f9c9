"""Reading raw meter and regional text files.

Every file may have a header of its own. All headers are read by one distributed job in
which a task reads no further than the first line of its file; the driver gets one row per
file. Files with the same header are then one scan.
"""

from __future__ import annotations

import csv
import warnings
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilospan.functions.scalars import lenient_timestamp, nan_to_null
from kilospan.operators.sets import union_all, wide_to_long
from kilospan.schema import KWH_COLUMNS, METER_SCHEMA, pick_column

FILE_ORDER = "__order"
# Least bits for the place in a file: a row's number in its task takes 33 of them.
BLOCK_BITS = 34
# Files up to this size are read together; larger ones by a task each, which stops early.
SMALL_FILE = 8 << 20
# Beyond any file, and far enough from 2**63 that sums over files fit.
WHOLE_FILE = 1 << 42
# Paths of that many bytes are broadcast as file numbers.
NUMBERS_BYTES = 128 << 20


@dataclass(frozen=True)
class RawFile:
    path: str
    size: int


def _csv(spark: SparkSession):
    return spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True)


def _files(spark: SparkSession, paths, pattern: str | None = None) -> list[RawFile]:
    """Files behind paths, folders and patterns, in name order; no content is read."""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    rows = reader.load(paths).select("_metadata.file_path", "_metadata.file_size").collect()
    return sorted((RawFile(*r) for r in rows), key=lambda f: f.path)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    old = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def _first_lines(spark: SparkSession, paths, pattern: str | None, largest: int) -> dict[str, str]:
    """The first line of every file that has one.

    A task stops when it has seen the line, so a large file costs one batch of lines; to
    that end such a file must be one task. Small files share tasks and are read through.
    """
    import pyarrow as pa

    reader = spark.read
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    alone = largest > SMALL_FILE
    names = ["path", "line"]

    def first(batches):
        seen = set()
        for batch in batches:
            paths, lines = (batch.column(c).to_pylist() for c in names)
            for path, line in zip(paths, lines):
                if path not in seen:
                    seen.add(path)
                    yield pa.RecordBatch.from_pydict({"path": [path], "line": [line]})
            if alone and seen:
                return

    whole = {"spark.sql.files.maxPartitionBytes": str(WHOLE_FILE), "spark.sql.files.openCostInBytes": str(WHOLE_FILE)}
    with _settings(spark, whole if alone else {}):
        lines = reader.text(paths).where("trim(value) != ''")
        # a split that does not begin its file has no header
        lines = lines.where("_metadata.file_block_start = 0")
        rows = lines.selectExpr("_metadata.file_path AS path", "value AS line").mapInArrow(
            first, "path string, line string"
        )
        return dict(rows.collect())


def _headers(spark: SparkSession, paths, pattern: str | None, files: list[RawFile]) -> dict[tuple[str, ...], list[str]]:
    """Listed files by their header: trimmed names, none of them twice. Empty files have
    none."""
    largest = max((f.size for f in files), default=0)
    lines = _first_lines(spark, paths, pattern, largest) if files else {}
    parsed: dict[str, tuple[str, ...]] = {}
    found: dict[tuple[str, ...], list[str]] = {}
    for file in files:
        line = lines.get(file.path)
        if line is None:
            continue
        if line not in parsed:
            cells = next(csv.reader([line.lstrip("\ufeff")], skipinitialspace=True))
            names = tuple(c.strip() or f"_c{i}" for i, c in enumerate(cells))
            bare = [n.lower() for n in names]
            if len(set(bare)) < len(bare):
                raise ValueError(f"{file.path} has columns of the same name: {names}")
            parsed[line] = names
        found.setdefault(parsed[line], []).append(file.path)
    return found


def with_file_order(df: DataFrame, files: list[RawFile], name: str = FILE_ORDER) -> DataFrame:
    """Mark each row's place in the listed files with one BIGINT, so that "first" has a
    meaning: the file's number, and below it the split's offset and the row in the split.

    Call it directly on the scan. A row takes two bytes at least, so the rows of a split
    are fewer than its bytes and never reach the offset of the next one. The place in a file
    takes as many bits as the largest file needs; ValueError if the files' numbers then do
    not fit (500 million files of up to 8 GB, or 8 million of 500 GB).
    """
    spark = df.sparkSession
    largest = max((f.size for f in files), default=0)
    bits = max(BLOCK_BITS, (largest + (1 << 33)).bit_length())
    if len(files).bit_length() + bits > 63:
        raise ValueError(f"{len(files)} files of up to {largest} bytes have no order in 63 bits")
    numbers = spark.createDataFrame(
        [(i, f.path) for i, f in enumerate(files)], "__number bigint, __file string"
    )
    if sum(len(f.path) + 16 for f in files) <= NUMBERS_BYTES:
        numbers = F.broadcast(numbers)
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = df.select(
        "*", F.col("_metadata.file_path").alias("__path"),
        (F.col("_metadata.file_block_start") + row).alias("__row"),
    )
    joined = placed.join(numbers, F.col("__path") == F.col("__file"))
    place = F.shiftleft("__number", bits) + F.col("__row")
    return joined.withColumn(name, place).drop("__path", "__row", "__number", "__file")


def _scan(spark, files, names, types, ordered_by: list[RawFile] | None) -> DataFrame:
    """Files of one header, each column under its own name with its declared type."""
    schema = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
    df = _csv(spark).schema(schema).option("enforceSchema", True).csv(files)
    return with_file_order(df, ordered_by) if ordered_by else df


def read_meters(spark: SparkSession, paths, columns=None, ordered: bool = False) -> DataFrame:
    """Typed scan of meter files by column name.

    Columns may stand in any order and among others. A name that is asked for (all
    declared ones, unless ``columns`` says which) must be there once. Files with the same
    header are one scan.
    """
    wanted = list(columns or METER_SCHEMA.names)
    types = {f.name: f.dataType for f in METER_SCHEMA.fields}
    files = _files(spark, paths)
    frames = []
    for names, mine in _headers(spark, paths, None, files).items():
        missing = [c for c in wanted if c not in names]
        if missing:
            raise ValueError(f"{mine[0]} has no columns {missing}: {names}")
        df = _scan(spark, mine, names, types, files if ordered else None)
        typed = [nan_to_null(c).alias(c) if c in KWH_COLUMNS else F.col(c) for c in wanted]
        frames.append(df.select(*typed, *([FILE_ORDER] if ordered else [])))
    if not frames:
        raise FileNotFoundError(f"no meter file in {paths}")
    return union_all(frames)


def name_from_file(suffixes=("_hourly.csv", "_preprocessed.csv")) -> Column:
    """Entity name: the file name without its known ending."""
    ends = "|".join(s.replace(".", r"\.") for s in suffixes)
    name = F.regexp_replace(F.col("_metadata.file_name"), r"%20", " ")
    return F.regexp_replace(name, f"({ends})$", "")


def model_and_entity_from_file(ending: str = r"\.csv") -> dict[str, Column]:
    """``<model>_<entity>.csv`` to its two parts; the entity follows the last ``_``."""
    name = F.col("_metadata.file_name")
    pattern = rf"^(.*)_([^_]+){ending}$"
    return {
        "model": F.regexp_extract(name, pattern, 1),
        "customer_id": F.regexp_extract(name, pattern, 2),
    }


def read_regions(
    spark: SparkSession, paths, ordered: bool = False, fallback=None,
    fallback_pattern: str = "*_preprocessed.csv",
) -> DataFrame:
    """Regional files of any layout as one table: region, ts, load_val.

    Time and load column are found by name in each header; files with the same header are
    one scan. Where ``paths`` match no file, the files in the ``fallback`` folder are read.
    """
    pattern = None
    try:
        files = _files(spark, paths)
    except AnalysisException as e:
        if fallback is None or e.getCondition() != "PATH_NOT_FOUND":
            raise
        files = []
    if not files and fallback is not None:
        paths, pattern = fallback, fallback_pattern
        files = [f for f in _files(spark, paths, pattern) if "unified" not in f.path.rpartition("/")[2]]
    frames = [
        _region_rows(_scan(spark, mine, names, {}, files if ordered else None), names, ordered)
        for names, mine in _headers(spark, paths, pattern, files).items()
    ]
    if not frames:
        raise FileNotFoundError(f"no regional file in {paths}")
    return union_all(frames)


def _region_rows(raw: DataFrame, names, ordered: bool = False) -> DataFrame:
    when = pick_column(list(names), ("date", "time"))
    rest = [c for c in names if c != when]
    load = pick_column(rest, ("mw", "load"), default=rest[0] if len(rest) == 1 else None)
    return raw.select(
        name_from_file().alias("region"),
        lenient_timestamp(F.col(f"`{when}`")).alias("ts"),
        nan_to_null(F.col(f"`{load}`").try_cast("double")).alias("load_val"),
        *([FILE_ORDER] if ordered else []),
    ).where(F.col("ts").isNotNull())


def read_region(spark: SparkSession, path: str) -> DataFrame:
    """One regional file of any layout: its time and load column are found by name."""
    return read_regions(spark, path)


def read_region_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Listed files as one table; a missing one is reported and passed over."""
    found = []
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        if where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where):
            found.append(path)
        else:
            warnings.warn(f"no such file, skipped: {path}", stacklevel=2)
    if not found:
        raise FileNotFoundError(f"none of {paths} exists")
    return read_regions(spark, found)


def read_wide_regions(spark: SparkSession, path: str) -> DataFrame:
    """One file with a time column and one column per region, as long rows."""
    raw = _csv(spark).csv(path)
    when = pick_column(raw.columns, ("date", "time"))
    values = [c for c in raw.columns if c != when]
    typed = raw.select(
        lenient_timestamp(when).alias("ts"),
        *[nan_to_null(F.col(c).try_cast("double")).alias(c) for c in values],
    ).where(F.col("ts").isNotNull())
    return wide_to_long(typed, ["ts"])
