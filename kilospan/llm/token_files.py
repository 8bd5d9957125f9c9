"""Token ids as Arrow files of fixed-size lists.

A shard is one Arrow file (the stream with a footer). Its rows are sequences of ``width``
ids and a mask of the same width, so row r lies at a place known in advance: batch
r // ROWS, row r % ROWS. A reader maps the file and takes the row without copying. The
ids of consecutive documents run on through the rows; only the tail of a shard's last row
is padding, and its mask says so. Beside it lies an index file with doc_id, start and
number of ids of each document in the shard.

A task writes under a name of its own and reports it in the manifest. Spark keeps the
result of one attempt per task, so a file of a lost or repeated attempt is never read.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kilospan.llm.common import kept, row_slices, scratch, text_bytes
from kilospan.llm.tokens import coder

WIDTH = 2048
ROWS = 64
MANIFEST = "shard int, path string, index_path string, n_docs bigint, n_ids bigint, n_rows bigint"


def _ids_schema(width: int, wide: bool) -> pa.Schema:
    kind = pa.uint32() if wide else pa.uint16()
    return pa.schema([("ids", pa.list_(kind, width)), ("mask", pa.list_(pa.bool_(), width))])


def open_place(path: str) -> tuple[fs.FileSystem, str]:
    """A file system and a path in it, for local paths and URIs alike."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class ShardWriter:
    """Cuts a run of ids into rows and writes them batch by batch."""

    def __init__(self, sink, width: int, wide: bool):
        self.width, self.kind = width, np.dtype("<u4" if wide else "<u2")
        self.schema = _ids_schema(width, wide)
        self.file = pa.ipc.new_file(sink, self.schema)
        self.waiting, self.n_ids, self.n_rows = np.zeros(0, self.kind), 0, 0

    def add(self, ids: np.ndarray) -> None:
        self.n_ids += len(ids)
        run = np.concatenate([self.waiting, ids.astype(self.kind)])
        block = self.width * ROWS
        full = len(run) // block * block
        for lo in range(0, full, block):
            self._write(run[lo : lo + block], block)
        self.waiting = run[full:]

    def _write(self, run: np.ndarray, real: int) -> None:
        mask = np.arange(len(run)) < real
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(run), self.width),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.width),
        ]
        self.file.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.n_rows += len(run) // self.width

    def close(self) -> None:
        if len(self.waiting):
            run = np.zeros(-(-len(self.waiting) // self.width) * self.width, self.kind)
            run[: len(self.waiting)] = self.waiting
            self._write(run, len(self.waiting))
        self.file.close()


class ShardReader:
    """Random access to a shard. A local file is mapped, so rows are views of it."""

    def __init__(self, path: str):
        system, place = open_place(path)
        local = isinstance(system, fs.LocalFileSystem)
        self.source = pa.memory_map(place) if local else system.open_input_file(place)
        self.file = pa.ipc.open_file(self.source)

    def row(self, r: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of one sequence; the ids are not copied."""
        batch, at = self.file.get_batch(r // ROWS), r % ROWS
        width = batch.column(0).type.list_size
        ids = batch.column(0).flatten().slice(at * width, width)
        mask = batch.column(1).flatten().slice(at * width, width)
        return ids.to_numpy(zero_copy_only=True), mask.to_numpy(zero_copy_only=False)

    def runs(self):
        """All real ids, batch after batch."""
        for b in range(self.file.num_record_batches):
            batch = self.file.get_batch(b)
            ids = batch.column(0).flatten().to_numpy(zero_copy_only=True)
            mask = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            yield ids[: int(mask.sum())]

    def close(self) -> None:
        self.source.close()


def write_token_files(
    docs: DataFrame, tokenizer: str, folder: str, end_id: int | None = None,
    width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Writes all documents in ascending id order and returns the manifest (one row per
    shard, shards numbered in that order).

    A null text is empty. Null ids come first; equal ids stay in one shard, ordered by
    text. An empty table writes no shard. Ids are stored in 16 bits where the vocabulary
    and ``end_id`` fit, else in 32. ``folder`` must be reachable from every executor.
    """
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
    kind = docs.schema[id_col].dataType
    id_type = pa.string() if kind.simpleString() == "string" else pa.int64()

    def write(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        code = coder(tokenizer)
        wide = max(code.tokenizer.get_vocab_size(), (end_id or 0) + 1) > 1 << 16
        name = f"shard-{shard:06d}-{uuid.uuid4().hex[:8]}"
        system, place = open_place(folder)
        writer = sink = index = index_sink = None
        index_schema = pa.schema([("doc_id", id_type), ("start", pa.int64()), ("n", pa.int64())])
        n_docs = 0
        for batch in batches:
            _, at = text_bytes(batch.column(1))
            for lo, hi in row_slices(at):
                if writer is None:
                    system.create_dir(place, recursive=True)
                    sink = system.open_output_stream(f"{place}/{name}.arrow")
                    writer = ShardWriter(sink, width, wide)
                    index_sink = system.open_output_stream(f"{place}/{name}.index.arrow")
                    index = pa.ipc.new_file(index_sink, index_schema)
                texts = [t or "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
                packed = [p + end for p in code.encode(texts)]
                size = np.array([len(p) // 4 for p in packed], np.int64)
                start = writer.n_ids + np.cumsum(size) - size
                writer.add(np.frombuffer(b"".join(packed), "<u4"))
                columns = [batch.column(0).slice(lo, hi - lo).cast(id_type), pa.array(start), pa.array(size)]
                index.write_batch(pa.RecordBatch.from_arrays(columns, schema=index_schema))
                n_docs += hi - lo
        if writer is None:
            return
        writer.close()
        index.close()
        sink.close()
        index_sink.close()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([shard], pa.int32()), pa.array([f"{folder}/{name}.arrow"]),
                pa.array([f"{folder}/{name}.index.arrow"]), pa.array([n_docs], pa.int64()),
                pa.array([writer.n_ids], pa.int64()), pa.array([writer.n_rows], pa.int64()),
            ],
            ["shard", "path", "index_path", "n_docs", "n_ids", "n_rows"],
        )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return kept(ordered.mapInArrow(write, MANIFEST), "manifest")


def read_back(manifest: DataFrame, id_type: str = "bigint") -> DataFrame:
    """Per document, from the files alone: start in the whole run, ids and their crc32.

    ``start`` adds the ids of all earlier shards: a running sum over the manifest, which
    has one short row per file. Files are read batch by batch.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.select(
        "path", "index_path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base")
    )

    def read(batches):
        for batch in batches:
            for shard in batch.to_pylist():
                yield from _documents(shard["path"], shard["index_path"], shard["base"])

    schema = f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint"
    spread = shards.repartition(max(1, manifest.count()), "path")
    return spread.mapInArrow(read, schema)


def _documents(path: str, index_path: str, base: int):
    system, place = open_place(index_path)
    reader = ShardReader(path)
    runs, run = reader.runs(), np.zeros(0, np.uint32)
    with system.open_input_file(place) as source:
        index = pa.ipc.open_file(source)
        for b in range(index.num_record_batches):
            rows = index.get_batch(b)
            sums = []
            for n in rows.column(2).to_numpy():
                crc = 0
                while n:
                    if not len(run):
                        run = next(runs)
                    part = run[:n]
                    crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                    run, n = run[len(part) :], n - len(part)
                sums.append(crc)
            start = pa.array(rows.column(1).to_numpy() + base)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), start, rows.column(2), pa.array(sums, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )
    reader.close()


def token_folder(docs: DataFrame) -> str:
    """A new folder for token files in the shared folder."""
    return scratch(docs.sparkSession, "token-files")
