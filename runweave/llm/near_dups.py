"""Near-duplicate documents by MinHash with tensored banding.

Each document has two collections of `halves` half keys, each folded from `rows` minhashes of its shingle set. A table
(i, j) is keyed by half key i of the first and half key j of the second collection, so 2 * halves * rows minhashes serve
halves ** 2 tables. Candidates are confirmed on the full sets.

A pair of similarity s meets in some table with probability (1 - (1 - s ** rows) ** halves) ** 2: 0.99998 at s = 0.85
and 0.9998 at s = 0.8 with the defaults (3 rows, 12 and 16 halves), more above.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runweave.llm import bitsets, words
from runweave.llm.linking import link_buckets
from runweave.llm.store import Workspace

_SIGNATURE = "doc_id long, n long, item long, other long, halves array<long>"


def shingle_sets(batch: pa.RecordBatch, size: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text of a batch; null texts have none."""
    texts = [(t or "").encode().lower() for t in batch.column("text").to_pylist()]
    return [np.unique(words.shingles(hashes, size)) for hashes, _, _ in words.hashed_words(texts)]


def _set_ids(sets: list[np.ndarray], offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit names of each set."""
    flat = np.concatenate(sets)
    names = []
    for salt in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179):
        names.append(words.mix(np.add.reduceat(words.mix(flat + np.uint64(salt)), offsets)))
    return names[0], names[1]


def _half_keys(flat: np.ndarray, offsets: np.ndarray, halves: int, rows: int) -> np.ndarray:
    """(sets, 2 * halves) half keys. `flat` is worked through in stretches, so the scratch memory is bounded."""
    seeds = words.mix(np.arange(1, 4 * halves * rows + 1, dtype=np.uint64))
    keys = np.empty((len(offsets), 2 * halves), np.uint64)
    for half in range(2 * halves):
        key = np.full(len(offsets), half + 1, np.uint64)
        for row in range(rows):
            at = 2 * (half * rows + row)
            value = np.bitwise_xor(flat, seeds[at])
            value *= seeds[at + 1] | np.uint64(1)
            key = words.mix(key * words.FOLD + np.minimum.reduceat(value, offsets))
        keys[:, half] = (key & ~np.uint64(1)) | np.uint64(half >= halves)  # the last bit names the collection
    return keys


def _signatures(size: int, halves: int, rows: int, more: tuple[str, ...] = ()):
    """more: columns that are passed on behind the signature's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.pieces(batches):
            sets = shingle_sets(batch, size)
            n = np.array([len(s) for s in sets], np.int64)
            item, other = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64)
            keys = np.zeros((len(sets), 2 * halves), np.int64)
            full = np.flatnonzero(n)
            step = 1 + 200_000 // (1 + int(n.mean()) if len(n) else 1)
            for low in range(0, len(full), step):
                own = full[low : low + step]
                offsets = np.cumsum(n[own]) - n[own]
                flat = np.concatenate([sets[k] for k in own])
                a, b = _set_ids([sets[k] for k in own], offsets)
                item[own], other[own] = words.signed(a), words.signed(b)
                keys[own] = words.signed(_half_keys(flat, offsets, halves, rows))
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(sets) + 1, dtype=np.int32) * 2 * halves), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(n), pa.array(item), pa.array(other), lists,
                 *map(batch.column, more)], ["doc_id", "n", "item", "other", "halves", *more])
    return run


def _sets(size: int, wanted):
    """(item, members) of the rows whose `name` may be in the bit set `wanted`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(bitsets.has(wanted, batch.column("name").to_numpy())))
            for piece in words.pieces([batch]):
                sets = [s for s in shingle_sets(piece, size) if len(s)]
                if not sets:
                    continue
                n = np.array([len(s) for s in sets])
                item, _ = _set_ids(sets, np.cumsum(n) - n)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)),
                    pa.array(words.signed(np.concatenate(sets))))
                yield pa.RecordBatch.from_arrays([pa.array(words.signed(item)), lists], ["item", "members"])
    return run


def _table_rows(work: Workspace, classes: DataFrame) -> DataFrame:
    """(bucket, item, n, score) for all tables' buckets with at least two items, equal buckets once.

    Half keys that only one item has can't take part in a shared table key, so they go before the tables are formed.
    Only the ids travel; sizes and scores are joined to the items that are left.
    """
    keys = work.keep(classes.select("item", F.explode("halves").alias("key")), "half-keys")
    shared = keys.groupBy("key").agg(F.count("*").alias("score")).where("score > 1")
    kept = keys.join(shared.hint("merge"), "key")
    right = F.col("key").bitwiseAND(1) == 1
    sides = work.keep(kept.groupBy("item").agg(
        F.sum("score").alias("score"), F.collect_list(F.when(~right, F.col("key"))).alias("left"),
        F.collect_list(F.when(right, F.col("key"))).alias("right")), "sides")
    work.drop("half-keys")
    rows = sides.select("item", "right", F.explode("left").alias("l"))
    rows = rows.select("item", "l", F.explode("right").alias("r"))
    rows = work.keep(rows.select(F.xxhash64("l", "r").alias("bucket"), "item"), "tables")
    full = rows.groupBy("bucket").agg(
        F.count("*").alias("k"), F.bit_xor(F.xxhash64("item")).alias("who")).where("k > 1")
    full = full.groupBy("k", "who").agg(F.min("bucket").alias("bucket"))  # of buckets with the same items, one
    rows = rows.join(full.select("bucket").hint("merge"), "bucket", "left_semi")
    about = classes.select("item", "n").join(sides.select("item", "score").hint("merge"), "item")
    buckets = work.keep(rows.join(about.hint("merge"), "item").select("bucket", "item", "n", "score"), "buckets")
    work.drop("tables")
    work.drop("sides")
    return buckets


def near_duplicates(docs: DataFrame, shingle_words: int = 3, percent: int = 85, halves: int = 12,
                    rows: int = 3) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of `docs`.

    Words are runs of bytes outside white space, A-Z lower-cased. Documents are linked when
    100 * intersection >= percent * union of their sets of `shingle_words`-word shingles. component_id is the smallest
    doc_id that links reach.

    - Null, empty or blank texts: n_shingles 0, linked with nothing, kept.
    - Fewer words than a shingle: the whole sequence is the one shingle.
    - Rows with equal sets are one class before hashing, so large groups of exact copies cost one class.
    - Repeated rows and doc_ids: each row is answered; all rows with the component's least doc_id are kept.
    - A null doc_id never names a component unless it has no other; then the row is kept.
    - Other columns are not read; an empty table gives an empty result.
    """
    work = Workspace(docs.sparkSession, "near-dups")
    docs = docs.select("doc_id", "text")
    signed = work.keep(docs.mapInArrow(_signatures(shingle_words, halves, rows), _SIGNATURE), "signatures")
    named = _named_classes(work, docs, signed, shingle_words, percent)
    work.clear("signatures", "named")
    out = signed.join(named.select("item", "component_id").hint("merge"), "item", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _named_classes(work: Workspace, docs: DataFrame, signed: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """(item, component, component_id) of each class of rows with equal sets; component is one of its items.

    The sets of the classes in some bucket are taken from the texts again: a bit set of the ids of their first rows
    lets next to no other text be cut, and the items of the sets decide. So no text is shuffled.
    """
    classes = signed.where("n > 0").groupBy("item", "other", "n").agg(
        F.min("doc_id").alias("first"), F.first("halves").alias("halves"))
    classes = work.keep(classes, "classes")
    buckets = _table_rows(work, classes)
    wanted = work.keep(classes.select("item", "first").join(buckets.select("item").distinct().hint("merge"), "item", "left_semi"),
                       "wanted")
    ids = bitsets.bit_set(wanted.select(F.xxhash64("first").alias("name")), wanted.count())
    named_texts = docs.select(F.xxhash64(F.col("doc_id").cast("long")).alias("name"), "text")
    sets = named_texts.mapInArrow(_sets(shingle_words, ids), "item long, members array<long>")
    sets = sets.join(wanted.select("item").hint("merge"), "item", "left_semi").groupBy("item").agg(
        F.first("members").alias("members"))
    components = link_buckets(work, buckets, work.keep(sets, "sets"), percent, "near")
    named = classes.select("item", "first").join(components.hint("merge"), "item", "left").withColumn(
        "component", F.coalesce("component", "item"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    return work.keep(named.join(least.hint("merge"), "component").select("item", "component", "component_id"), "named")


def keep_one(docs: DataFrame, shingle_words: int = 5, percent: int = 80, halves: int = 16, rows: int = 3) -> DataFrame:
    """The rows of `docs`, all columns, with one row for each group of near-duplicates: that of the least doc_id.

    A null doc_id comes after all others; of several texts with the least doc_id, that of the least SHA-256 stays, and
    of rows equal in both, one. Ids shared by different texts change nothing about the others' groups. Blank and null
    texts all stay.
    """
    work = Workspace(docs.sparkSession, "keep-one")
    # rows are found again by id and digest; all columns of the input go in a struct, whatever their names
    tagged = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"),
                         F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)).alias("digest"))
    texts = tagged.select("doc_id", "text", "digest")
    signed = work.keep(texts.mapInArrow(_signatures(shingle_words, halves, rows, ("digest",)), f"{_SIGNATURE}, digest binary"), "signatures")
    named = _named_classes(work, texts.select("doc_id", "text"), signed.drop("digest"), shingle_words, percent)
    blank = signed.where("n = 0").select("doc_id", "digest").distinct().withColumn("copies", F.lit(1).cast("long"))
    full = signed.where("n > 0").groupBy("item", "doc_id", "digest").agg(F.count("*").alias("copies"))
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "digest")
    best = full.join(named.hint("merge"), "item").groupBy("component").agg(F.min_by(F.struct("doc_id", "digest", "copies"), first).alias("best"))
    kept = work.keep(best.select("best.*").union(blank), "kept").withColumnsRenamed({"doc_id": "kept_id", "digest": "kept_digest"})
    work.clear("kept")

    def found(wanted: DataFrame) -> DataFrame:
        same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("digest") == F.col("kept_digest"))
        return tagged.select("row", "doc_id", "digest").join(wanted, same, "left_semi")

    once, repeated = found(kept.where("copies = 1")), found(kept.where("copies > 1")).dropDuplicates(["doc_id", "digest"])
    return once.union(repeated).select("row.*")
