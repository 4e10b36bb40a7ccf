"""Sum-of-squares packing of documents into sequences of a fixed number of tokens."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runweave.llm import words
from runweave.llm.encoding import encoder

#: Documents that are packed together in one task; each group may leave a few sequences partly filled.
GROUP = 50_000


def sum_of_squares(sizes: list[int], capacity: int) -> tuple[list[int], list[int], int]:
    """Bin and offset of each size, in the order given, and the number of bins.

    Each size goes where the sum, over gaps, of the squared number of open bins with that gap becomes smallest: into an
    open bin of some gap, or into a new one. Of equal choices the smallest gap wins.
    """
    bins, offsets, made = [], [], 0
    open_ = np.zeros(capacity + 1, np.int64)  # open bins by gap; full bins are not open
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    never = np.iinfo(np.int64).max
    for size in sizes:
        adds = 2 * open_[: capacity - size + 1] + 1
        adds[0] = 0
        change = adds[:-1] + 1 - 2 * open_[size:capacity]  # by gap from size to capacity - 1
        change[open_[size:capacity] == 0] = never
        best = int(change.argmin()) if len(change) else 0
        if len(change) and change[best] <= adds[-1]:
            gap = size + best
            at = stacks[gap].pop()
            open_[gap] -= 1
        else:
            gap, at, made = capacity, made, made + 1
        bins.append(at)
        offsets.append(capacity - gap)
        if gap > size:
            stacks[gap - size].append(at)
            open_[gap - size] += 1
    return bins, offsets, made


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int], int]:
    """Bin and offset of each size, in the order given: the open bin with the least gap that holds it, or a new one."""
    gaps: list[tuple[int, int]] = []
    bins, offsets, made = [], [], 0
    for size in sizes:
        k = bisect.bisect_left(gaps, (size, -1))
        gap, at = gaps.pop(k) if k < len(gaps) else (capacity, made)
        made = max(made, at + 1)
        bins.append(at)
        offsets.append(capacity - gap)
        if gap > size:
            bisect.insort(gaps, (gap - size, at))
    return bins, offsets, made


def pack_sizes(sizes: list[int], capacity: int) -> tuple[list[int], list[int], int]:
    """sum_of_squares, of whose bins the loose ones are then emptied and filled again by best_fit if that takes fewer.

    The rule keeps bins of every gap in stock for sizes still to come; when none come any more, best fit closes them.
    Loose are the bins with a gap, and of the full ones none, or the quarter, half or three quarters that were full last,
    whichever gives the fewest bins.
    """
    bins, offsets, made = sum_of_squares(sizes, capacity)
    if not sizes:
        return bins, offsets, made
    at = np.array(bins)
    last = np.zeros(made, np.int64)
    last[at] = np.arange(len(sizes))  # the latest size of each bin
    full = np.flatnonzero(np.bincount(at, sizes, made) == capacity)
    full = full[np.argsort(last[full])]
    best = (made, None, None)
    for quarters in (4, 3, 2, 1):
        kept = full[:len(full) * quarters // 4]
        loose = np.flatnonzero(~np.isin(at, kept))
        again = best_fit([sizes[k] for k in loose], capacity)
        if len(kept) + again[2] < best[0]:
            best = (len(kept) + again[2], kept, (loose, again))
    if best[1] is None:
        return bins, offsets, made
    made, kept, (loose, again) = best
    seat = np.zeros(len(last), np.int64)
    seat[kept] = np.arange(len(kept))
    bins = seat[at].tolist()
    for k, own, offset in zip(loose.tolist(), again[0], again[1]):
        bins[k], offsets[k] = len(kept) + own, offset
    return bins, offsets, made


def _lengths(path: str, keeps_space: bool, end_id: int, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, keeps_space)
        end = int(end_id).to_bytes(4, "little")
        for batch in words.pieces(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            sizes, sums, ids = [], [], []
            for raw in encode(texts):
                raw += end
                n = len(raw) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                sizes.append(n)
                sums.append([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(cuts, cuts[1:])])
                ids.append(raw)
            columns = [batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(sums, pa.list_(pa.int64()))]
            names = ["doc_id", "n", "sums"]
            if with_ids:
                columns, names = [*columns, pa.array(ids, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)
    return run


def _place(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "sums")))]
        if not rows:
            return
        # largest first; the rest of the key makes a task that runs again give the same rows
        rows.sort(key=lambda row: (-((row[1] - 1) % capacity), row[0] is None, row[0] or 0, row[1], row[2]))
        firsts = [(n - 1) % capacity + 1 for _, n, _ in rows]
        bins, offsets, made = pack_sizes(firsts, capacity)
        base = TaskContext.get().partitionId() << 40
        columns = [[] for _ in range(7)]
        for (doc_id, n, sums), first, at, offset in zip(rows, firsts, bins, offsets):
            for piece, total in enumerate(sums):
                length = capacity if piece else first
                if piece:
                    at, offset, made = made, 0, made + 1
                start = first + (piece - 1) * capacity if piece else 0
                for column, value in zip(columns, (doc_id, piece, start, length, total, base + at, offset)):
                    column.append(value)
            if len(columns[0]) >= 50_000:
                yield _pieces_batch(columns)
                columns = [[] for _ in range(7)]
        if columns[0]:
            yield _pieces_batch(columns)
    return run


PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def _pieces_batch(columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PIECES)], schema=PIECES)


def token_lengths(docs: DataFrame, path: str, keeps_space: bool = True, end_id: int = 2, capacity: int = 1024,
                  with_ids: bool = False) -> DataFrame:
    """(doc_id, n, sums) of each row of `docs`: its number of ids with the end id, and the crc32 of its pieces' ids.

    with_ids adds the ids themselves (little-endian unsigned 32 bit) as a binary column, for writing the sequences out.
    """
    schema = "doc_id long, n long, sums array<long>" + ", ids binary" * with_ids
    return docs.select("doc_id", "text").mapInArrow(_lengths(path, keeps_space, end_id, capacity, with_ids), schema)


def pack(docs: DataFrame, path: str, keeps_space: bool = True, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every row of `docs`.

    A row longer than `capacity` ids is cut so that all pieces but the first are full; full pieces are sequences of
    their own, and the first pieces are packed, largest first, by pack_sizes in groups of about GROUP documents.

    - Null texts are empty: one piece that holds the end id. Null or repeated doc_ids are packed row by row.
    - Documents are dealt to groups by a hash of id and content, so no source or key fills a group. Other columns are
      not read; an empty table gives an empty result.
    """
    groups = max(1, -(-docs.count() // GROUP))
    rows = token_lengths(docs, path, keeps_space, end_id, capacity)
    dealt = rows.repartition(groups, F.xxhash64("doc_id", "n", "sums"))
    return dealt.mapInArrow(_place(capacity), "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                              "sequence_id long, offset long")
