"""Best-fit packing planned over a histogram of lengths.

1. Every text is encoded once; texts beyond the capacity are cut, and each piece leaves one
   narrow row in a written table.
2. The histogram of lengths (as many rows as the capacity, whatever the corpus) is packed by
   best-fit decreasing over counts: one step places all pieces of one length.
3. The plan says which ranks within a length go where. Pieces are ranked within their
   length and join the plan on it.

Ranks come from hashed buckets of each length, so a length that half of the pieces share is
spread over many tasks; a running sum over the bucket counts makes the ranks gapless.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kilospan.llm.common import kept, row_slices, text_bytes
from kilospan.llm.tokens import coder

CAPACITY = 2048
ROWS_PER_BUCKET = 200_000
LEAST_BUCKETS = 32

PIECES = "doc_id {id}, piece int, start bigint, length bigint, ids_crc32 bigint, spread bigint"
PLAN = "length bigint, first_rank bigint, end_rank bigint, first_sequence bigint, each bigint, place bigint"


def piece_rows(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int | None = 0,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """One row per piece of at most ``capacity`` ids.

    A document is its ids and then ``end_id`` (none if None); a null text is empty. One
    that is longer than the capacity becomes pieces of exactly that length, but for the
    first, which holds the rest. A document without any id has no piece. Rows are taken as
    they are: null ids, equal ids and repeated rows each make pieces of their own.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = PIECES.format(id=kind) + (", ids binary" if with_ids else "")
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def cut(batches):
        encode = coder(tokenizer).encode
        for batch in batches:
            _, at = text_bytes(batch.column(1))
            for lo, hi in row_slices(at):
                texts = [t or "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
                out = {c: [] for c in ("row", "piece", "start", "length", "crc", "ids")}
                for row, packed in enumerate(encode(texts)):
                    packed += end
                    n = len(packed) // 4
                    first = n % capacity or capacity
                    edges = [0, *range(first, n + 1, capacity)] if n else [0]
                    for i, (a, b) in enumerate(zip(edges, edges[1:])):
                        ids = packed[4 * a : 4 * b]
                        out["row"].append(row)
                        out["piece"].append(i)
                        out["start"].append(a)
                        out["length"].append(b - a)
                        out["crc"].append(zlib.crc32(ids))
                        if with_ids:
                            out["ids"].append(ids)
                rows = np.array(out["row"], np.int64)
                crc = np.array(out["crc"], np.int64)
                piece = np.array(out["piece"], np.int32)
                spread = (crc * 2654435761 + piece * 40503 + np.arange(len(crc))) & 0x7FFFFFFF
                columns = [
                    batch.column(0).slice(lo, hi - lo).take(pa.array(rows)),
                    pa.array(piece),
                    pa.array(np.array(out["start"], np.int64)),
                    pa.array(np.array(out["length"], np.int64)),
                    pa.array(crc),
                    pa.array(spread.astype(np.int64)),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "spread"]
                if with_ids:
                    columns.append(pa.array(out["ids"], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(cut, schema)


def best_fit_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple]:
    """Best-fit decreasing over counts: rows of ``PLAN``.

    Sequences with the same content form one group. A length goes to the fullest group it
    fits; what is left opens new sequences. A step splits one group at most per length, so
    groups are bounded by the number of lengths, not by the number of pieces.
    """
    groups: dict[int, list] = {}  # free ids -> [[number of sequences, ((length, each), ...)]]
    done: list[list] = []

    def put(free, number, content):
        if number:
            (groups.setdefault(free, []) if free else done).append([number, content])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            fit = min((f for f in groups if f >= length), default=None)
            if fit is None:
                each = capacity // length
                number, content = -(-left // each), ()
                fit = capacity
            else:
                number, content = groups[fit].pop()
                if not groups[fit]:
                    del groups[fit]
                each = fit // length
            full = min(number, left // each)
            put(fit - each * length, full, (*content, (length, each)))
            left -= full * each
            number -= full
            if left and number:  # fewer than fill one more sequence
                put(fit - left * length, 1, (*content, (length, left)))
                left, number = 0, number - 1
            if content:
                put(fit, number, content)
    done += [g for gs in groups.values() for g in gs]

    rows, first_sequence, ranks = [], 0, dict.fromkeys(counts, 0)
    for number, content in done:
        place = 0
        for length, each in content:
            first = ranks[length]
            ranks[length] = first + number * each
            rows.append((length, first, ranks[length], first_sequence, each, place))
            place += each * length
        first_sequence += number
    return rows


def ranked(pieces: DataFrame, buckets: int) -> DataFrame:
    """Adds ``rank``: gapless from 0 within a length, whatever the skew of lengths."""
    pieces = pieces.withColumn("bucket", F.col("spread") % buckets)
    sizes = pieces.groupBy("length", "bucket").agg(F.count("*").alias("size"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sizes.select(
        "length", "bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base")
    )
    within = Window.partitionBy("length", "bucket").orderBy("spread")
    numbered = pieces.withColumn("nth", F.row_number().over(within) - 1)
    return numbered.join(starts, ["length", "bucket"]).withColumn(
        "rank", F.col("base") + F.col("nth")
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a written table of pieces.

    ``pieces`` needs ``length`` (1 to capacity) and ``spread``; other columns stay. An empty
    table gives an empty result. The plan has at most one row per pair of group and length,
    a bound set by the capacity alone, so it is broadcast.
    """
    spark = pieces.sparkSession
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    total = sum(counts.values())
    plan = spark.createDataFrame(best_fit_plan(counts, capacity), PLAN)
    buckets = max(LEAST_BUCKETS, -(-total // ROWS_PER_BUCKET))
    rows = ranked(pieces, buckets)
    fits = (
        (rows["length"] == plan["length"])
        & (rows["rank"] >= plan["first_rank"])
        & (rows["rank"] < plan["end_rank"])
    )
    nth = F.col("rank") - F.col("first_rank")
    return rows.join(F.broadcast(plan), fits).select(
        *[rows[c] for c in pieces.columns],
        (F.col("first_sequence") + F.floor(nth / F.col("each"))).cast("bigint").alias("sequence_id"),
        (F.col("place") + nth % F.col("each") * rows["length"]).cast("bigint").alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The packed token rows: per sequence its ids (binary, little-endian 32-bit) and where
    each piece starts. ``packed`` comes from pieces made ``with_ids``. A group is one
    sequence, so it holds no more than the capacity."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.aggregate("parts.ids", F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"),
        F.transform(
            "parts", lambda p: F.struct(p["offset"], p["length"], p["doc_id"], p["piece"])
        ).alias("pieces"),
    )


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int | None = 0,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Pieces of whole documents with their sequence and place; see :func:`piece_rows`."""
    made = piece_rows(docs, tokenizer, capacity, end_id, id_col, text_col, with_ids)
    return pack(kept(made, "pieces"), capacity).drop("spread")
