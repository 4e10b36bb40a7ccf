"""Token ids as Arrow stream files of equal-length sequences, and their way back.

Each shard is two files. `<shard>.arrow` is an Arrow stream whose batches hold a fixed-size list of ids and one of mask
bits for each sequence, uncompressed, so a memory-mapped file gives any sequence without copying. `<shard>.docs.arrow`
says which ids belong to which document. Shards follow each other in ascending order of doc_id.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runweave.llm import words
from runweave.llm.encoding import encoder
from runweave.llm.store import Workspace

#: Sequences in a batch of a file, and documents in a batch of its index.
BATCH, DOCS = 256, 4096
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def sequence_schema(length: int, wide: bool) -> pa.Schema:
    ids = pa.uint32() if wide else pa.uint16()
    return pa.schema([("input_ids", pa.list_(pa.field("item", ids, False), length)),
                      ("mask", pa.list_(pa.field("item", pa.bool_(), False), length))])


class ShardWriter:
    """Writes one shard under temporary names and names it at the end, so a task that runs again replaces it whole."""

    def __init__(self, folder: str, shard: int, length: int, wide: bool):
        self.files, root = pafs.FileSystem.from_uri(folder)
        self.files.create_dir(root, recursive=True)
        self.final = [f"{root}/{shard:06d}{end}" for end in (".arrow", ".docs.arrow")]
        self.made = [f"{path}.{uuid.uuid4().hex}.part" for path in self.final]
        self.length, self.schema = length, sequence_schema(length, wide)
        self.kind = np.dtype(np.uint32 if wide else np.uint16)
        self.streams = [self.files.open_output_stream(path) for path in self.made]
        self.out = pa.ipc.new_stream(self.streams[0], self.schema)
        self.index = pa.ipc.new_stream(self.streams[1], INDEX)
        self.waiting, self.n_waiting, self.written = [], 0, 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, raw: bytes) -> None:
        """One document's ids, as little-endian unsigned 32-bit numbers."""
        self.rows.append((doc_id, self.written + self.n_waiting, len(raw) // 4))
        self.waiting.append(np.frombuffer(raw, "<u4").astype(self.kind))
        self.n_waiting += len(raw) // 4
        if self.n_waiting >= BATCH * self.length:
            self._flush(self.n_waiting // self.length)
        if len(self.rows) >= DOCS:
            self._flush_index()

    def _flush(self, sequences: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, self.kind)
        real = min(len(ids), sequences * self.length)
        self.waiting, self.n_waiting = [ids[real:]], len(ids) - real
        self.written += real
        for low in range(0, sequences, BATCH):
            some = slice(low * self.length, min(low + BATCH, sequences) * self.length)
            part = ids[:real][some]
            size = some.stop - some.start
            full = np.zeros(size, self.kind)
            full[:len(part)] = part
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(values), type=field.type)
                     for values, field in zip((full, np.arange(size) < len(part)), self.schema)]
            self.out.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def _flush_index(self) -> None:
        if self.rows:
            self.index.write_batch(pa.RecordBatch.from_arrays(
                [pa.array(column, pa.int64()) for column in zip(*self.rows)], schema=INDEX))
        self.rows = []

    def close(self) -> int:
        """Pads the last sequence, names the files and returns the number of ids."""
        if self.n_waiting:
            self._flush(-(-self.n_waiting // self.length))
        self._flush_index()
        for closing in (self.out, self.index, *self.streams):
            closing.close()
        for made, final in zip(self.made, self.final):
            self.files.move(made, final)
        return self.written


class Shard:
    """Random access to one shard: on a local disk by memory map, so ids and masks are views of the file."""

    def __init__(self, folder: str, shard: int):
        self.files, root = pafs.FileSystem.from_uri(folder)
        paths = [f"{root}/{shard:06d}{end}" for end in (".arrow", ".docs.arrow")]
        local = isinstance(self.files, pafs.LocalFileSystem)
        self.batches, self.index = (list(pa.ipc.open_stream(
            pa.memory_map(path) if local else self.files.open_input_file(path))) for path in paths)
        self.length = self.batches[0].schema.field(0).type.list_size if self.batches else 1
        self.first = np.cumsum([0, *(batch.num_rows for batch in self.batches)])

    def sequence(self, k: int) -> tuple[np.ndarray, pa.Array]:
        """Ids (a view) and mask bits of sequence k."""
        at = int(np.searchsorted(self.first, k, side="right")) - 1
        low = (k - int(self.first[at])) * self.length
        ids, mask = (self.batches[at].column(c).values for c in range(2))
        return ids.slice(low, self.length).to_numpy(zero_copy_only=True), mask.slice(low, self.length)

    def ids(self, start: int, count: int) -> np.ndarray:
        """Ids from `start` on, across sequences."""
        parts, end = [], start + count
        while start < end:
            at = int(np.searchsorted(self.first, start // self.length, side="right")) - 1
            base = int(self.first[at]) * self.length
            high = min(end, int(self.first[at + 1]) * self.length)
            parts.append(self.batches[at].column(0).values.slice(start - base, high - start).to_numpy(zero_copy_only=True))
            start = high
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def _write(folder: str, path: str, keeps_space: bool, end_id: int, length: int, wide: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, writer, rows = TaskContext.get().partitionId(), None, 0
        encode, end = encoder(path, keeps_space), int(end_id).to_bytes(4, "little")
        for batch in words.pieces(batches):
            writer = writer or ShardWriter(folder, shard, length, wide)
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), encode(texts)):
                writer.add(doc_id, raw + end)
            rows += batch.num_rows
        if writer:
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([rows], pa.int64()),
                                              pa.array([writer.close()], pa.int64())], ["shard", "docs", "tokens"])
    return run


def write_sequences(docs: DataFrame, folder: str, path: str, keeps_space: bool = False, end_id: int = 2,
                    length: int = 1024, wide: bool = False) -> DataFrame:
    """Writes `docs` (doc_id, text) as shards in `folder`, and returns (shard, docs, tokens, before), one row a shard.

    `before` is the number of ids in the shards before. Documents are in ascending order of doc_id (null first, ties by
    text) and each ends with `end_id`; ids run on from sequence to sequence, and only the last sequence of a shard is
    padded (mask false). wide: ids of 32 bits, for vocabularies over 65,536. Null texts are empty; other columns are not
    read; an empty table writes no shard. The folder must be one that all executors share.
    """
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(shards, "doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", "text")
    rows = ordered.mapInArrow(_write(folder, path, keeps_space, end_id, length, wide), "shard int, docs long, tokens long")
    before, out = 0, []
    for row in sorted(rows.collect(), key=lambda row: row.shard):  # one row a shard, as many as Spark has partitions
        out.append((row.shard, row.docs, row.tokens, before))
        before += row.tokens
    return spark.createDataFrame(out, "shard int, docs long, tokens long, before long")


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, before in zip(batch.column("shard").to_pylist(), batch.column("before").to_pylist()):
                shard = Shard(folder, number)
                for index in shard.index:
                    starts, sizes = index.column("start").to_numpy(), index.column("n_tokens").to_numpy()
                    sums = [zlib.crc32(shard.ids(a, n).astype("<u4").tobytes()) for a, n in zip(starts.tolist(), sizes.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [index.column("doc_id"), pa.array(starts + before), index.column("n_tokens"), pa.array(sums, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def read_documents(shards: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the shards, from the files; start counts all ids before."""
    spread = shards.select("shard", "before").repartition(
        int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions")), "shard")
    return spread.mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, path: str, keeps_space: bool = False, end_id: int = 2, length: int = 1024) -> DataFrame:
    """Writes `docs` to a new folder under spark.checkpoint.dir and reads the documents back."""
    folder = Workspace(docs.sparkSession, "sequences").path("shards")
    return read_documents(write_sequences(docs, folder, path, keeps_space, end_id, length), folder)
