"""Vector compression by product codes, exact in whole numbers.

Components become integers, vectors are cut into equal parts, and a codebook of each part position is refined by rounds
of nearest entry and mean. Distances come from a matrix product: integers are broken into limbs so small that every
sum of a float64 product stays below 2**53, the limbs' products are put together in int64, and the first smallest
distance wins. So codes, errors and codebooks do not depend on the machine, the tasks or the order of rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from runweave.llm.store import Workspace

#: Components that a task turns into distances at a time, and the bits of a limb of the sums that tasks send on.
BLOCK, SUM_BITS = 1 << 18, 30
_LONG_MAX = (1 << 63) - 1


@dataclass(frozen=True)
class Codebooks:
    """entries[part] are the integer vectors of a part position, `width` components each."""

    entries: tuple[tuple[tuple[int, ...], ...], ...]
    width: int
    scale: int

    @property
    def parts(self) -> int:
        return len(self.entries)

    def sha256(self) -> str:
        """Hex digest of all decimal components by part, entry and position, joined by commas."""
        flat = (str(x) for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(",".join(flat).encode()).hexdigest()

    def decode(self, code: str) -> list[float]:
        """The vector that a code stands for: the middle of its entries' cells, in the vectors' own unit."""
        chosen = [int(code[2 * k:2 * k + 2], 16) for k in range(self.parts)]
        return [(x + 0.5) / self.scale for part, k in zip(self.entries, chosen) for x in part[k]]


def usable(vectors: DataFrame) -> DataFrame:
    """Rows whose `embedding` is not null and holds only finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vectors.where(F.coalesce(F.forall("embedding", finite), F.lit(False)))


def _floor(x: float, scale: int) -> int:
    return math.floor(x * scale) if abs(x) < 2.0 ** 53 else int(x) * scale


def whole_numbers(column: pa.ListArray, columns: int, scale: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, integers by row and column) of runs of rows; components behind a vector's end are 0.

    int64 where all numbers of the run are below 2**60, else Python's integers, which have no bound.
    """
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
    step = max(1, BLOCK // max(columns, 1))
    for low in range(0, len(column), step):
        own = column.slice(low, step)
        lengths = np.diff(ends[low:low + step], prepend=ends[low - 1] if low else 0)
        raw = own.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        place = np.arange(columns) < lengths[:, None]
        if len(raw) == 0 or np.abs(raw).max() < 2.0 ** 60 / scale:
            out = np.zeros((len(own), columns), np.int64)
            out[place] = np.floor(raw * scale)
        else:
            out = np.zeros((len(own), columns), object)
            out[place] = [_floor(x, scale) for x in raw.tolist()]
        yield low, out


def _limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """float64 arrays whose sum weighted by 2**(bits * k) is x; all but the signed last are in 0..2**bits - 1."""
    out = []
    while x.size and np.abs(x).max() >= 1 << bits:
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
    return [*out, x.astype(np.float64)]


def dot_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x @ y.T of int64 matrices, exact modulo 2**64, by float64 products of limbs."""
    bits = (53 - max(1, x.shape[1]).bit_length()) // 2
    out = np.zeros((len(x), len(y)), np.int64)
    for i, left in enumerate(_limbs(x, bits)):
        for j, right in enumerate(_limbs(y, bits)):
            if bits * (i + j) < 64:
                out += (left @ right.T).astype(np.int64) << (bits * (i + j))
    return out


def nearest_entries(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first nearest entry, squared distance) of each row; both arrays int64, or objects of any size."""
    if x.dtype != object and entries.dtype != object:
        reach = max(int(np.abs(x).max(initial=0)) + int(np.abs(entries).max(initial=0)), 1)
        if x.shape[1] * reach * reach <= _LONG_MAX:
            shift = np.einsum("ij,ij->i", entries, entries) - 2 * dot_products(x, entries)
            chosen = shift.argmin(1)
            return chosen, shift[np.arange(len(x)), chosen] + np.einsum("ij,ij->i", x, x)
    chosen, best = np.zeros(len(x), np.int64), np.zeros(len(x), object)
    wide = entries.astype(object)
    for k, row in enumerate(x.astype(object)):
        distances = ((wide - row) ** 2).sum(1) + 0
        chosen[k] = min(range(len(wide)), key=distances.__getitem__)
        best[k] = distances[chosen[k]]
    return chosen, best


def _arrays(books: Codebooks) -> list[np.ndarray]:
    small = all(abs(x) < 1 << 60 for part in books.entries for entry in part for x in entry)
    return [np.array(part, np.int64 if small else object).reshape(len(part), books.width) for part in books.entries]


def _sums(books: Codebooks):
    """Rows -> (part, entry, position, limb, value): sums of the parts of each entry in limbs; position -1 is their count."""

    def add(total: dict, part: int, chosen: np.ndarray, own: np.ndarray) -> None:
        order = np.argsort(chosen, kind="stable")
        used, starts, counts = np.unique(chosen[order], return_index=True, return_counts=True)
        own = own[order]
        # halves of a number add up within int64 whatever the rows of a block
        high = np.add.reduceat(own >> 30, starts, axis=0).tolist()
        low = np.add.reduceat(own & ((1 << 30) - 1), starts, axis=0).tolist()
        for k, entry in enumerate(used.tolist()):
            so_far = total.setdefault((part, entry), [0] * (books.width + 1))
            so_far[0] += int(counts[k])
            for at in range(books.width):
                so_far[at + 1] += (high[k][at] << 30) + low[k][at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = _arrays(books)
        total: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            for _, rows in whole_numbers(batch.column("embedding"), books.width * books.parts, books.scale):
                for part, known in enumerate(entries):
                    own = rows[:, part * books.width:(part + 1) * books.width]
                    add(total, part, nearest_entries(own, known)[0], own)
        out = []
        for (part, entry), numbers in total.items():
            for at, number in enumerate(numbers):
                sign, rest, limb = (-1 if number < 0 else 1), abs(number), 0
                while rest:
                    out.append((part, entry, at - 1, limb, sign * (rest & ((1 << SUM_BITS) - 1))))
                    rest, limb = rest >> SUM_BITS, limb + 1
        columns = list(zip(*out)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int32()) for c in columns[:4]), pa.array(columns[4], pa.int64())],
            ["part", "entry", "position", "limb", "value"])

    return run


def _refined(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry replaced by the mean of the parts nearest to it, rounded down; unused entries stay."""
    sums = vectors.select("embedding").mapInArrow(_sums(books), "part int, entry int, position int, limb int, value long")
    sums = sums.groupBy("part", "entry", "position", "limb").agg(F.sum("value").alias("value"))
    total: dict[tuple[int, int, int], int] = {}
    for row in sums.toLocalIterator():
        key = (row.part, row.entry, row.position)
        total[key] = total.get(key, 0) + (row.value << (SUM_BITS * row.limb))

    def entry(part: int, k: int, old: tuple[int, ...]) -> tuple[int, ...]:
        count = total.get((part, k, -1), 0)
        return tuple(total.get((part, k, at), 0) // count for at in range(books.width)) if count else old

    return Codebooks(tuple(tuple(entry(p, k, old) for k, old in enumerate(part)) for p, part in enumerate(books.entries)),
                     books.width, books.scale)


def fit(vectors: DataFrame, parts: int = 16, size: int = 64, rounds: int = 2, scale: int = 256) -> Codebooks | None:
    """The codebooks of (vec_id, embedding), trained on every usable row; None without any.

    Each part position starts from that part of the `size` rows of smallest vec_id (of equal ids, those of the smaller
    vector; rows without an id come last). With fewer rows the codebooks are smaller. Parts are as wide as the longest
    vector needs; what a shorter one lacks counts as 0.

    The driver holds the codebooks: size times the length of a vector. A task sends at most that many sums, and `size`
    ids for the start.
    """
    rows = usable(vectors.select("vec_id", "embedding"))
    longest = rows.agg(F.max(F.size("embedding"))).first()[0]
    if longest is None:
        return None
    width = -(-longest // parts)
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding")]
    ids = [row.vec_id for row in rows.select("vec_id").where("vec_id is not null").orderBy("vec_id").limit(size).collect()]
    start = rows.where(F.col("vec_id") <= ids[-1]) if len(ids) == size else rows
    first = start.orderBy(*order).limit(size).collect()
    padded = [[_floor(x, scale) for x in row.embedding] + [0] * (width * parts - len(row.embedding)) for row in first]
    books = Codebooks(tuple(tuple(tuple(v[p * width:(p + 1) * width]) for v in padded) for p in range(parts)), width, scale)
    for _ in range(rounds):
        books = _refined(rows, books)
    return books


def _codes(books: Codebooks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = _arrays(books)
        for batch in batches:
            codes, errors = [], []
            for _, rows in whole_numbers(batch.column("embedding"), books.width * books.parts, books.scale):
                chosen, total = np.zeros((len(rows), books.parts), np.uint8), np.zeros(len(rows), object)
                for part, known in enumerate(entries):
                    chosen[:, part], far = nearest_entries(rows[:, part * books.width:(part + 1) * books.width], known)
                    total = total + far.astype(object)
                codes += [row.tobytes().hex() for row in chosen]
                errors += [int(x) if x <= _LONG_MAX else None for x in total]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                ["vec_id", "label", "code", "error"])
    return run


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error) of each usable row: two hex digits for each part's nearest entry, the lower index of
    equally near ones, and the squared distances summed over the parts (null where they exceed a long)."""
    rows = usable(vectors.select("vec_id", "label", "embedding"))
    schema = StructType([rows.schema["vec_id"], rows.schema["label"], StructField("code", StringType()),
                         StructField("error", LongType())])
    return rows.mapInArrow(_codes(books), schema)


def compress(vectors: DataFrame, parts: int = 16, size: int = 64, rounds: int = 2, scale: int = 256) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each usable row of (vec_id, embedding, label).

    - A null vector, or one with a null, NaN or infinite component, takes no part. An empty vector is all zeros, a
      shorter one ends in zeros (see `fit`).
    - Repeated and null ids and repeated rows are answered row by row. Null labels are one label.
    - An error beyond a long is null, and so is the sum of a label that holds one or exceeds a long.
    - An empty table gives no rows. Other columns are not read. size is at most 256.

    The table is read anew by each round, never shuffled; only the codes, without the vectors, are written, since errors
    are summed by label with partial sums before they are joined back.
    """
    spark = vectors.sparkSession
    books = fit(vectors, parts, size, rounds, scale)
    if books is None:
        return spark.createDataFrame([], StructType([vectors.schema["vec_id"], StructField("code", StringType()), *(
            StructField(n, LongType()) for n in ("error", "label_error")), StructField("codebooks_sha256", StringType())]))
    coded = Workspace(spark, "vector-codes").keep(encode(vectors, books), "coded")
    by_label = coded.groupBy(F.col("label").alias("of_label")).agg(F.when(
        F.count("*") == F.count("error"), F.try_sum("error")).alias("label_error"))
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("of_label")), "left")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
