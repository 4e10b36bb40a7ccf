"""What each filter of a chain removes, in every order of the chain.

Documents that fail a filter are kept as sorted posting lists, one for each part, filter and range of ids. The unions of
lists and what a list holds beyond a union are found by merges that gallop: the members of the shorter list are searched
in the longer one, and the stretches between them are skipped. All asked-for numbers are sums of list sizes, so the
ranges add up, and no document is looked at once for each order.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runweave.llm.store import Workspace
from runweave.llm.words import pieces

#: The filters; the last one needs the whole table, the others a text alone.
FILTERS = "ABCDE"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = re.compile(rb"[#$%&*|]")
#: Documents of a range of ids, and parts whose sums a task holds before it hands them on.
RANGE, PARTS = 1 << 16, 500

_FACTS = "doc_id long, part string, failed int, digest binary"
_POSTING = ("part string, first_id long, last_id long, n_docs long, ids array<long>, weights array<long>, "
            + ", ".join(f"{name} array<int>" for name in (*FILTERS, "good", "toxic")))
_SUMS = ["n", "gone", "removed", "fails", "alone", "good_lost", "toxic_lost", "shapley"]


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The filters that each text fails by itself, as bits, and the digest that equal texts share."""
    for rows in pieces(batches):
        texts = pc.fill_null(rows.column("text"), "")
        chars = pc.utf8_length(texts).to_pylist()
        failed, digests = [], []
        for data, n_chars in zip(texts.cast(pa.binary()).to_pylist(), chars):
            words = data.split()  # at the white space of ASCII: \x20 and \x09-\x0D
            capitals = len(data) - len(data.translate(None, CAPITALS))
            failed.append((len(words) < 200) | (100 * len(set(words)) < 50 * len(words)) << 1
                          | (100 * capitals > 3 * n_chars) << 2 | bool(MARKS.search(data)) << 3)
            digests.append(hashlib.sha256(data).digest())
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pc.fill_null(rows.column("part"), ""), pa.array(failed, pa.int32()),
             pa.array(digests, pa.binary())], ["doc_id", "part", "failed", "digest"])


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, failed, n): equal rows of `docs` (doc_id, text, lang) counted, with the filters they fail as bits.

    Bit k is set if the k-th filter of FILTERS fails; A to D see one text, E is the text of a smaller doc_id. Texts are
    equal if their SHA-256 is. The texts themselves are read once and never shuffled.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("part"),
                       F.col("text").cast("string").alias("text")).mapInArrow(_facts, _FACTS)
    rows = rows.groupBy("doc_id", "part", "failed", "digest").agg(F.count("*").alias("n"))
    rows = Workspace(docs.sparkSession, "filter-audit").keep(rows, "facts")
    # joined by the id, not by the text alone: a text that a third of all documents share is no hot key
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null").withColumn("is_first", F.lit(True))
    rows = rows.join(first, ["doc_id", "digest"], "left")
    copied = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    bit = F.when(copied, 1 << FILTERS.index("E")).otherwise(0)
    return rows.select("doc_id", "part", F.col("failed").bitwiseOR(bit).alias("failed"), "n")


def _posting_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by id -> a row of posting lists for each part of each RANGE rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        while sum(b.num_rows for b in held) + batch.num_rows >= RANGE:
            room = RANGE - sum(b.num_rows for b in held)
            yield _lists_of([*held, batch.slice(0, room)])
            held, batch = [], batch.slice(room)
        held.append(batch)
    if sum(b.num_rows for b in held):
        yield _lists_of(held)


def _lists_of(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(batches).combine_chunks()
    codes = rows.column("part").combine_chunks().dictionary_encode()
    codes, names = codes.indices.to_numpy(), codes.dictionary.to_pylist()
    ids = pc.fill_null(rows.column("doc_id"), np.iinfo(np.int64).min).to_numpy()
    failed, n = rows.column("failed").to_numpy(), rows.column("n").to_numpy()
    marks = [failed >> k & 1 for k in range(len(FILTERS))] + [rows.column(c).to_numpy() for c in ("good", "toxic")]
    out = []
    order = np.argsort(codes, kind="stable")
    for code, own in enumerate(np.split(order, np.searchsorted(codes[order], np.arange(1, len(names))))):
        some = own[np.any([m[own] for m in marks], axis=0)]
        out.append([names[code], int(ids[own[0]]), int(ids[own[-1]]), int(n[own].sum()), ids[some], n[some],
                    *(np.flatnonzero(m[some]).astype(np.int32) for m in marks)])
    types = [pa.string(), *[pa.int64()] * 3, *[pa.list_(pa.int64())] * 2, *[pa.list_(pa.int32())] * len(marks)]
    names = ["part", "first_id", "last_id", "n_docs", "ids", "weights", *FILTERS, "good", "toxic"]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names)


def posting_lists(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part and range of ids: the ids that fail a filter or have a label, ascending, the number of equal
    rows behind each (`weights`), and for each filter and label the places in `ids` of its members, ascending.

    `labels` (doc_id, quality, toxic): a label of a repeated id counts if any of its rows has it. Null ids come first.
    """
    has = lambda c: F.max(F.when(F.col(c).cast("int") == 1, 1).otherwise(0))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        has("quality").alias("good"), has("toxic").alias("toxic")).where("good + toxic > 0")
    rows = failed.join(known, "doc_id", "left").na.fill(0, ["good", "toxic"])
    rows = rows.groupBy("doc_id", "part", "failed", "good", "toxic").agg(F.sum("n").alias("n"))
    order = ["doc_id", "part", "failed"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_posting_lists, _POSTING)


def beyond(some: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The members of one ascending list that another one lacks, in order; the shorter list gallops over the longer."""
    if len(some) <= len(others):
        at = np.searchsorted(others, some)
        return some[(at == len(others)) | (others[np.minimum(at, len(others) - 1)] != some)] if len(others) else some
    at = np.searchsorted(some, others)
    inside = at < len(some)
    at, others = at[inside], others[inside]
    return np.delete(some, at[some[at] == others])


def merged(lists: list[np.ndarray]) -> np.ndarray:
    """The union of ascending lists, merged from the shortest on, each into what is longer."""
    lists = sorted(lists, key=len)
    out = lists[0] if lists else np.zeros(0, np.int32)
    for longer in lists[1:]:
        new = beyond(out, longer)
        out = np.insert(longer, np.searchsorted(longer, new), new) if len(new) else longer
    return out


def _list_sums(lists: list[np.ndarray], good: np.ndarray, toxic: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """_SUMS for each (filter, set of filters before it): rows in the order of _CASES."""
    size = lambda places: int(weights[places].sum())
    unions = [merged([lists[k] for k in range(len(lists)) if before >> k & 1]) for before in range(1 << len(lists))]
    sizes = [size(union) for union in unions]
    out = np.zeros((len(_CASES), len(_SUMS)), np.int64)
    everything = (1 << len(lists)) - 1
    alone = [size(beyond(own, unions[everything & ~(1 << k)])) for k, own in enumerate(lists)]
    removed = {}
    for row, (k, before) in enumerate(_CASES):
        left = beyond(lists[k], unions[before])
        removed[k, before] = size(left)
        lost = [size(left) - size(beyond(left, label)) for label in (good, toxic)]
        out[row, :7] = [n, sizes[before | 1 << k], removed[k, before], size(lists[k]), alone[k], *lost]
    shapley = [sum(_ORDERS_OF[before.bit_count()] * removed[j, before] for j, before in _CASES if j == k) for k in range(len(lists))]
    out[:, 7] = [shapley[k] for k, _ in _CASES]
    return out


#: (filter, set of filters before it), and in how many orders a filter comes after a given set of so many.
_CASES = [(k, before) for k in range(len(FILTERS)) for before in range(1 << len(FILTERS)) if not before >> k & 1]
_ORDERS_OF = [factorial(size) * factorial(len(FILTERS) - 1 - size) for size in range(len(FILTERS))]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of posting lists -> sums by (part, filter, set before), one row a part and task but for very many parts."""
    total: dict[str, np.ndarray] = {}

    def rows() -> pa.RecordBatch:
        parts = [part for part in total for _ in _CASES]
        numbers = np.concatenate(list(total.values()))
        cases = np.array(_CASES * len(total), np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.string()), pa.array(cases[:, 0]), pa.array(cases[:, 1]), *map(pa.array, numbers.T)],
            ["part", "filter", "before", *_SUMS])

    for batch in batches:
        for k in range(batch.num_rows):
            numpy_of = lambda c: batch.column(c)[k].values.to_numpy()  # noqa: E731,B023
            part, n = batch.column("part")[k].as_py(), batch.column("n_docs")[k].as_py()
            own = _list_sums([numpy_of(c) for c in FILTERS], numpy_of("good"), numpy_of("toxic"), numpy_of("weights"), n)
            total[part] = total[part] + own if part in total else own
            if len(total) > PARTS:
                yield rows()
                total = {}
    if total:
        yield rows()


def chain_sums(postings: DataFrame) -> DataFrame:
    """(part, filter, step, order) rows of the audit from the rows of `posting_lists`."""
    sums = postings.mapInArrow(_sums, "part string, filter int, before int, " + ", ".join(f"{c} long" for c in _SUMS))
    sums = sums.groupBy("part", "filter", "before").agg(*(F.sum(c).alias(c) for c in _SUMS))
    orders = [("".join(FILTERS[k] for k in order), step + 1, k, sum(1 << j for j in order[:step]))
              for order in permutations(range(len(FILTERS))) for step, k in enumerate(order)]
    orders = postings.sparkSession.createDataFrame(orders, "filter_order string, step int, filter int, before int")
    rows = sums.join(F.broadcast(orders), ["filter", "before"])  # len(orders) is 600, whatever the tables hold
    return rows.select(
        "part", "filter_order", "step", (F.col("n") - F.col("gone")).alias("kept"), "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"), F.col("alone").alias("unique_fails"),
        "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): for each lang
    of `docs` (doc_id, text, lang), each order of the five filters and each step, how many documents its filter meets.

    - A null text is empty, a null lang the part ''. Words are runs of bytes outside \\x20 and \\x09-\\x0D.
    - Repeated rows count one by one. Rows of one id with the same text do not fail E by each other; a null id is neither
      smaller nor greater than another, so it neither fails E nor makes others fail, and it has no labels.
    - A repeated id of `labels` has a label if any of its rows has; null labels are none.
    - A part without any document has no rows; an empty table gives none. Other columns are not read.

    The texts stay where they are read; an id, its part, a digest and the bits of its filters are shuffled. Equal rows
    are counted before each shuffle, and the lists of RANGE ids are in memory at a time.
    """
    # written between, so a task has one Python worker at a time and not one for the lists and one for the sums
    postings = Workspace(docs.sparkSession, "filter-audit").keep(posting_lists(failures(docs), labels), "postings")
    return chain_sums(postings)
