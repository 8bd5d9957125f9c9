"""Importance resampling towards a target: draw the documents whose features the target
has more often than the corpus.

Features are hashed into buckets by CRC-32. The checksum is linear in the bits of its
input, so the part of a byte depends on the byte and its distance from the end alone. These
parts stand in a table of positions; all features of a slice are spans of one array of such
parts, and ``bitwise_xor.reduceat`` over the spans gives their checksums at once, up to a
constant of the length. Spans longer than the table are cut into blocks from their end, and
each block's sum is moved on by a table that appends a block of zeros.

Three passes: counts per bucket of corpus and target (a bounded number of buckets, added up
per task), the weight of each document, and the draw. A document's noise follows from its
id, so a draw is the same in every run. The draw ranks by range partitions, so no task gets
more than its share of the documents.

Null and empty texts have no features and weight 0. Documents with a null id draw with the
noise of the empty id and come last among ties. Rows that share an id share its noise; each
is a document of its own. An empty corpus gives no rows, an empty target equal odds.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilospan.llm.common import kept, plain_words, row_slices, text_bytes

BUCKETS = 10_000
RUNS = (1, 2)
TABLE_BYTES = 64
SEED = 7
PERCENT = 25
LEAST_WORDS = 20


class PositionCrc:
    """CRC-32 of many spans of one byte array.

    ``parts[d, b]`` is what byte b adds to the checksum when d bytes follow it, and
    ``zeros[n]`` the checksum of n zero bytes: crc(x) = zeros[len(x)] ^ XOR of the parts.
    """

    def __init__(self, width: int = TABLE_BYTES):
        self.width = width
        zero = [zlib.crc32(bytes(d + 1)) for d in range(width)]
        self.parts = np.array(
            [[zlib.crc32(bytes([b]) + bytes(d)) ^ zero[d] for b in range(256)] for d in range(width)],
            np.uint32,
        )
        # a register with byte b at place k, after a block of zeros: linear, byte by byte
        self.moved = np.array(
            [[self._moved(b << (8 * k)) for b in range(256)] for k in range(4)], np.uint32
        )
        self.zeros = np.array([zlib.crc32(bytes(n)) for n in range(4 * width)], np.uint32)

    def _moved(self, register: int) -> int:
        # zlib starts from any register; its two complements cancel out in the difference
        block = bytes(self.width)
        return zlib.crc32(block, register) ^ zlib.crc32(block, 0)

    def move(self, x: np.ndarray) -> np.ndarray:
        m = self.moved
        return m[0][x & 255] ^ m[1][(x >> 8) & 255] ^ m[2][(x >> 16) & 255] ^ m[3][x >> 24]

    def of(self, data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Checksums of data[first[i]:end[i]]; no span is empty."""
        size = end - first
        out = np.zeros(len(first), np.uint32)
        short = size <= self.width
        out[short] = self._sums(data, first[short], end[short])
        if not short.all():
            out[~short] = self._folded(data, first[~short], end[~short])
        return out ^ self._length_constants(size)

    def _sums(self, data, first, end) -> np.ndarray:
        """XOR of the parts over spans no longer than the table."""
        if not len(first):
            return np.zeros(0, np.uint32)
        size = end - first
        begin = np.cumsum(size) - size
        total = int(begin[-1] + size[-1])
        at = np.repeat(first - begin, size) + np.arange(total)
        left = np.repeat(end, size) - 1 - at
        return np.bitwise_xor.reduceat(self.parts[left, data[at]], begin)

    def _folded(self, data, first, end) -> np.ndarray:
        """Blockwise from the front: move the sum so far on by a block, add the next."""
        width = self.width
        blocks = -(-(end - first) // width)
        total = np.zeros(len(first), np.uint32)
        rows = np.arange(len(first))
        for left in range(int(blocks.max()), 0, -1):
            rows = np.flatnonzero(blocks >= left)
            hi = end[rows] - (left - 1) * width
            lo = np.maximum(first[rows], hi - width)
            total[rows] = self.move(total[rows]) ^ self._sums(data, lo, hi)
        return total

    def _length_constants(self, size: np.ndarray) -> np.ndarray:
        inside = size < len(self.zeros)
        out = self.zeros[np.where(inside, size, 0)]
        for i in np.flatnonzero(~inside):
            out[i] = zlib.crc32(bytes(int(size[i])))
        return out


_CRC: list[PositionCrc] = []


def position_crc() -> PositionCrc:
    if not _CRC:
        _CRC.append(PositionCrc())
    return _CRC[0]


def feature_buckets(
    data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS, runs: tuple[int, ...] = RUNS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text number of every feature, and the number of words of every text.

    ``data`` holds the UTF-8 bytes of texts that begin and end at ``offsets``.
    """
    n = len(offsets) - 1
    text_of, first, end = _words(data, offsets)
    n_words = np.bincount(text_of, minlength=n)
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), n_words
    # words one after the other, a blank behind each: a run of words is one span
    size = end - first
    start = np.cumsum(size + 1) - (size + 1)
    line = np.full(int(start[-1] + size[-1]) + 1, 0x20, np.uint8)
    total = int(size.sum())
    step = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
    line[np.repeat(start, size) + step] = data[np.repeat(first, size) + step]
    upper = (line >= 65) & (line <= 90)
    line[upper] += 32

    crc, bucket, owner = position_crc(), [], []
    for length in runs:
        last = len(first) - length + 1
        if last <= 0:
            continue
        whole = text_of[:last] == text_of[length - 1 :]
        lo = start[:last][whole]
        hi = (start + size)[length - 1 :][whole]
        bucket.append(crc.of(line, lo, hi).astype(np.int64) % buckets)
        owner.append(text_of[:last][whole])
    return np.concatenate(bucket), np.concatenate(owner), n_words


def _words(data: np.ndarray, offsets: np.ndarray):
    """Text number, first byte and end of every word. No word reaches over two texts."""
    is_word = plain_words().is_word
    n = len(offsets) - 1
    # a gap byte behind each text keeps its last word apart from the next one's first
    inside = np.zeros(len(data) + n + 1, np.int8)
    shift = np.repeat(np.arange(1, n + 1), np.diff(offsets))
    inside[np.arange(len(data)) + shift] = is_word[data]
    edges = np.flatnonzero(np.diff(inside)) + 1
    first, end = edges[::2], edges[1::2]
    text_of = np.searchsorted(offsets[1:] + np.arange(1, n + 1), first, "right")
    return text_of, first - text_of - 1, end - text_of - 1


def bucket_counts(
    docs: DataFrame, text: str = "text", buckets: int = BUCKETS, runs: tuple[int, ...] = RUNS
) -> DataFrame:
    """How many features of all texts fall into each bucket: ``bucket``, ``n``. Buckets
    without features have no row."""
    rows = docs.select(docs[text].cast("string").alias("text"))

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for lo, hi in row_slices(offsets):
                own = data[offsets[lo] : offsets[hi]]
                found, _, _ = feature_buckets(own, offsets[lo : hi + 1] - offsets[lo], buckets, runs)
                total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    parts = rows.mapInArrow(run, "bucket bigint, n bigint")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, target to corpus, rounded down."""
    n, m = sum(corpus.values()), sum(target.values())
    out = np.zeros(buckets, np.int64)
    for b in range(buckets):
        up = float(target.get(b, 0) + 1) * float(n + buckets)
        down = float(corpus.get(b, 0) + 1) * float(m + buckets)
        out[b] = math.floor(1000 * math.log(up / down))
    return out


def weights(
    docs: DataFrame, gain: np.ndarray, runs: tuple[int, ...] = RUNS, id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_features`` and ``weight``, the mean gain of its
    features, rounded down."""
    rows = docs.select(docs[id_column].alias("doc_id"), docs[text].cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_words", "n_features", "weight"]

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for lo, hi in row_slices(offsets):
                own = data[offsets[lo] : offsets[hi]]
                found, owner, n_words = feature_buckets(
                    own, offsets[lo : hi + 1] - offsets[lo], len(gain), runs
                )
                n = np.bincount(owner, minlength=hi - lo)
                total = np.zeros(hi - lo, np.int64)
                np.add.at(total, owner, gain[found])
                weight = total // np.maximum(n, 1)
                columns = [pa.array(c.astype(np.int64)) for c in (n_words, n, weight)]
                ids = batch.column("doc_id").slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([ids, *columns], names)

    return rows.mapInArrow(run, f"doc_id {id_type}, n_words bigint, n_features bigint, weight bigint")


def noise(id_column: str = "doc_id", seed: int = SEED):
    """Thousandths of Gumbel noise, rounded down, the same for an id in every run."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("bigint")
    share = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln(share))).cast("bigint")


def ranked(rows: DataFrame, order: list, name: str = "rank") -> DataFrame:
    """Number all rows from 1 in the given order, by range partitions.

    The sorted rows are written with their place in their partition; what remains is to add
    the number of rows in the partitions before, one number per partition.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    below = (1 << 33) - 1
    placed = kept(
        sorted_rows.withColumn("__id", F.monotonically_increasing_id()).select(
            *rows.columns,
            F.shiftright("__id", 33).cast("int").alias("__part"),
            (F.col("__id").bitwiseAND(F.lit(below)) + 1).alias("__place"),
        ),
        "ranked",
    )
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).orderBy("__part").collect()
    earlier, ahead = 0, []
    for row in sizes:
        ahead.append((row["__part"], earlier))
        earlier += row["n"]
    # one row per shuffle partition, whose number is a setting
    table = F.broadcast(spark.createDataFrame(ahead, "__part int, __ahead bigint"))
    return placed.join(table, "__part").withColumn(name, F.col("__ahead") + F.col("__place")).drop(
        "__part", "__place", "__ahead"
    )


def resample(
    docs: DataFrame, target: DataFrame, *, percent: int = PERCENT, least_words: int = LEAST_WORDS,
    seed: int = SEED, buckets: int = BUCKETS, runs: tuple[int, ...] = RUNS,
) -> DataFrame:
    """Every document with ``n_words``, ``n_features``, ``weight``, ``score`` and, if it is
    drawn, its ``rank`` from 1. Drawn are ``percent`` of the documents of at least
    ``least_words`` words: those with the highest weight plus noise."""
    # both are bounded by the number of buckets
    have = {r["bucket"]: r["n"] for r in bucket_counts(docs, buckets=buckets, runs=runs).collect()}
    want = {r["bucket"]: r["n"] for r in bucket_counts(target, buckets=buckets, runs=runs).collect()}
    weighed = weights(docs, gains(have, want, buckets), runs)
    scored = kept(
        weighed.withColumn("score", F.col("weight") + noise(seed=seed)).withColumn(
            "__tie", F.monotonically_increasing_id()
        ),
        "scored",
    )
    long_enough = F.col("n_words") >= least_words
    n = scored.where(long_enough).count()
    drawn = percent * n // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("__tie")]
    places = ranked(scored.where(long_enough), order)
    places = places.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(~long_enough).withColumn("rank", F.lit(None).cast("bigint"))
    return places.unionByName(rest).drop("__tie")
