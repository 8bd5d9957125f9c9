"""What the operators share: scratch tables, Arrow texts as bytes, hashed words."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach; a scratch one only where none is set, locally."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="kilospan-llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder. Tables there may go when the application ends."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/kilospan-{app}/{name}-{uuid.uuid4().hex[:12]}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """Compute once, write to the shared folder and read back: lineage ends there."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """From now on, what this session hands to Python goes in batches of about BATCH_BYTES, or
    a row. Spark's own limit is 64 MB, which the executor's JVM holds beside its heap and every
    worker once more. A limit that the session has been given stays."""
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def same(df: DataFrame, other: DataFrame, on: list[str]) -> Column:
    cond = F.lit(True)
    for c in on:
        cond = cond & df[c].eqNullSafe(other[c])
    return cond


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow text column and the n + 1 offsets; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    n = len(texts)
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES):
    """Ranges of rows of up to ``limit`` bytes each, of one row at least."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def seeds(n: int, salt: int) -> np.ndarray:
    """n odd 64-bit constants, the same on every machine."""
    base = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)
    return mix64(base + np.uint64(salt)) | np.uint64(1)


STEP = int(seeds(1, 77)[0])
BACK = pow(STEP, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP**i and STEP**-i for i < n, modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", STEP), ("down", BACK)):
            row = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
            row[0] = 1
            _POWERS[name] = np.multiply.accumulate(row)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class WordReader:
    """Words of raw bytes: where they lie, and a 64-bit hash of each with A-Z lowered.

    A hash depends on the word's bytes alone, so it is the same in every batch, task and
    run. Texts longer than a slice are read in pieces cut between words, so memory is
    bounded by the slice and the longest word.
    """

    def __init__(self, is_word: np.ndarray):
        self.is_word = is_word.astype(bool)
        lower = np.arange(256)
        lower[65:91] += 32
        self.value = seeds(256, 5)[lower]

    def read(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, first byte and end byte of every word."""
        if len(data) <= SLICE_BYTES:
            return self._read(data)
        parts, lo = [], 0
        while lo < len(data):
            hi = min(lo + SLICE_BYTES, len(data))
            while hi < len(data):
                gap = np.flatnonzero(~self.is_word[data[max(lo, hi - 4096) : hi]])
                if len(gap):
                    hi = max(lo, hi - 4096) + int(gap[-1]) + 1
                    break
                hi = min(hi + SLICE_BYTES, len(data))
            h, a, b = self._read(data[lo:hi])
            parts.append((h, a + lo, b + lo))
            lo = hi
        return tuple(np.concatenate(p) for p in zip(*parts))

    def _read(self, data: np.ndarray):
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = self.is_word[data]
        edges = np.flatnonzero(np.diff(inside))
        first, end = edges[::2], edges[1::2]
        up, down = _powers(len(data) + 1)
        run = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.value[data] * up[: len(data)], out=run[1:])
        size = (end - first).astype(np.uint64)
        h = mix64((run[end] - run[first]) * down[first] + size * np.uint64(STEP))
        return h, first, end


def spaced_words() -> WordReader:
    """Words are what lies between the bytes 0x20 and 0x09-0x0D."""
    is_word = np.ones(256, bool)
    is_word[[0x20, 9, 10, 11, 12, 13]] = False
    return WordReader(is_word)


def plain_words() -> WordReader:
    """Words are runs of ASCII letters, digits and anything beyond ASCII."""
    is_word = np.zeros(256, bool)
    is_word[0x30:0x3A] = is_word[0x41:0x5B] = is_word[0x61:0x7B] = is_word[0x80:] = True
    return WordReader(is_word)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)
