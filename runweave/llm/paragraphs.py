"""Substring dedup: paragraphs with MinHash bands, exact Jaccard, and removal by components.

A paragraph is a run of sentences between cuts, and a cut is a sentence or line end that the hash of its last two words
picks, so a passage is cut alike wherever it stands. Half of the ends are cuts of one series of paragraphs, the other
half of a second one; both are compared by MinHash bands. A third series does not depend on sentences: windows of WINDOW
words, of any SELECT in a row the one with the least hash (winnowing), so two texts that share WINDOW + SELECT - 1 words
share such a window. What repeats is joined to runs; windows near the ends of a run are extended word by word to all that
both texts have. Only the words around those windows are fetched, from the texts, when it is known which they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runweave.llm import bitsets, words
from runweave.llm.linking import link_buckets
from runweave.llm.store import Workspace

#: Bands of one minhash: a pair of similarity 0.8 meets in one with probability 0.9984.
BANDS, SHINGLE, PERCENT = 4, 5, 80
#: Paragraphs with fewer words are only compared as they are.
LEAST_WORDS = 8
#: Words of a window, and how many windows in a row have at least one selected: 50 words on end hold a selected one.
WINDOW, SELECT = 30, 21
#: Marks are shuffled in 2 ** RANGE_BITS ranges, MARKS_HELD or a little more of them at a time: 10 MB a range at 30 GB of texts.
RANGE_BITS, MARKS_HELD = 12, 1 << 18
STOPS = np.zeros(256, bool)
STOPS[list(b".!?")] = True


def window_hashes(hashes: np.ndarray) -> np.ndarray:
    """A hash of the WINDOW words from each word on, from two overlapping runs of 16."""
    out, size = hashes, 1
    while size < 16:
        out = words.mix(out[:-size] * words.FOLD + out[size:])
        size *= 2
    return words.mix(out[:len(out) - (WINDOW - 16)] * words.FOLD + out[WINDOW - 16:])


def selected_windows(hashes: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words of the windows that are the least of SELECT in a row within a text, and their hashes.

    first, count: each text's first word and its words. Of windows in a row with one hash (a word over and over), the
    first, the last and every twentieth stand for all, so each SELECT in a row still hold one.
    """
    if len(hashes) < WINDOW + SELECT - 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    names = window_hashes(hashes)
    least, size = names, 1
    while size < 16:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[:len(least) - (SELECT - 16)], least[SELECT - 16:])
    # rows of SELECT windows that do not reach into the next text
    inside = np.zeros(len(hashes) + 1, np.int64)
    some = count >= WINDOW + SELECT - 1
    np.add.at(inside, first[some], 1)
    np.add.at(inside, first[some] + count[some] - (WINDOW + SELECT - 2), -1)
    inside = np.cumsum(inside[:len(least)]) > 0
    picked = np.zeros(len(names), bool)
    for k in range(SELECT):
        picked[k:k + len(least)] |= (names[k:k + len(least)] == least) & inside
    at = np.flatnonzero(picked)
    again = (np.diff(at, prepend=-2) == 1) & (names[at] == names[at - 1])
    onward = np.append(again[1:], False)
    run_start = np.maximum.accumulate(np.where(again, 0, np.arange(len(at))))
    at = at[~(again & onward & ((np.arange(len(at)) - run_start) % (SELECT - 1) != 0))]
    return at, names[at]


class Cut:
    """The paragraphs of a batch of texts: row, first and last word, name and series, for the three series in turn.

    Words are numbered through the batch; starts and ends are their byte offsets in their own text.
    """

    def __init__(self, batch: pa.RecordBatch, paragraphs: bool = True, windows: bool = True):
        texts = [(t or "").encode().lower() for t in batch.column("text").to_pylist()]
        found = words.hashed_words(texts)
        none = np.zeros(0, np.int64)
        self.hashes, self.starts, self.ends = (
            np.concatenate([np.zeros(0, np.uint64) if k == 0 else none, *(x[k] for x in found)]) for k in range(3))
        count = np.array([len(x[0]) for x in found], np.int64)
        self.text_first = np.cumsum(count) - count
        n = int(count.sum())
        stop = np.zeros(n, bool)
        for text, low, own in zip(texts, self.text_first.tolist(), found):
            if paragraphs and len(own[0]):
                buf = np.frombuffer(text, np.uint8)
                part = STOPS[buf[own[2] - 1]]
                part[np.maximum(np.searchsorted(own[2], np.flatnonzero(buf == 10), side="right") - 1, 0)] = True
                stop[low:low + len(part)] = part
        at = np.flatnonzero(stop)
        row_of = np.repeat(np.arange(len(count)), count)
        before = np.maximum(at - 1, self.text_first[row_of[at]])
        side = words.mix(self.hashes[at] * words.FOLD + self.hashes[before]) >> np.uint64(63)
        parts = []
        for k in range(2 if n and paragraphs else 0):
            cut = np.zeros(n + 1, bool)
            cut[self.text_first] = cut[n] = True
            cut[at[side == k] + 1] = True
            bounds = np.flatnonzero(cut)
            low, high = bounds[:-1], bounds[1:]
            place = (np.arange(n) - np.repeat(low, high - low)).astype(np.uint64)
            names = words.mix(np.add.reduceat(words.mix(self.hashes + place * words.FOLD), low) + np.uint64(k + 1))
            parts.append((low, high, names, np.full(len(low), k), row_of[low]))
        if n and windows:
            low, names = selected_windows(self.hashes, self.text_first, count)
            parts.append((low, low + WINDOW, words.mix(names + np.uint64(3)), np.full(len(low), 2), row_of[low]))
        self.first, self.last, self.names, self.series, self.row = (
            np.concatenate(c) for c in zip(*parts)) if parts else (none, none, none.astype(np.uint64), none, none)

    def banded(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Paragraphs between cuts that are long enough, their shingle counts and (paragraphs, BANDS) keys.

        Keys of the two series differ: paragraphs of one document that overlap are not compared with each other.
        """
        own = np.flatnonzero((self.series < 2) & (self.last - self.first >= LEAST_WORDS))
        count = self.last[own] - self.first[own] - SHINGLE + 1
        if not len(own):
            return own, count, np.zeros((0, BANDS), np.uint64)
        offsets = np.cumsum(count) - count
        flat = words.shingles(self.hashes, SHINGLE)[
            np.repeat(self.first[own] - offsets, count) + np.arange(int(count.sum()))]
        seeds = words.mix(np.arange(1, 2 * BANDS + 1, dtype=np.uint64))
        series = self.series[own].astype(np.uint64) * np.uint64(BANDS)
        keys = [words.mix(np.minimum.reduceat((flat ^ seeds[2 * b]) * (seeds[2 * b + 1] | np.uint64(1)), offsets)
                          + series + np.uint64(b)) for b in range(BANDS)]
        return own, count, np.stack(keys, 1)

    def shingles_of(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sorted distinct shingles of the paragraphs `own`, of SHINGLE words or more, and where each one's end."""
        count = self.last[own] - self.first[own] - SHINGLE + 1
        row = np.repeat(np.arange(len(own)), count)
        at = np.repeat(self.first[own] - (np.cumsum(count) - count), count) + np.arange(len(row))
        flat = words.shingles(self.hashes, SHINGLE)[at]
        order = np.lexsort((flat, row))
        flat = flat[order]
        fresh = np.append(True, (flat[1:] != flat[:-1]) | (row[1:] != row[:-1]))[:len(flat)]
        return flat[fresh], np.cumsum(np.bincount(row[fresh], minlength=len(own)))


def _runs_of_marks(marks: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct marks in order, the least and the greatest item of each, and whether it stands there more than once."""
    order = np.argsort(marks)
    marks, items = marks[order], items[order]
    first = np.flatnonzero(np.append(True, marks[1:] != marks[:-1])[:len(marks)])
    if not len(first):
        return marks, items, items, np.zeros(0, bool)
    return (marks[first], np.minimum.reduceat(items, first), np.maximum.reduceat(items, first),
            np.diff(np.append(first, len(marks))) > 1)


def _packed(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The bytes of the values from each bound to the next."""
    offsets = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _by_range(marks: np.ndarray, items: np.ndarray) -> pa.RecordBatch:
    """A row for each range of marks. Of a mark that is there more than twice, its least and greatest item stand for all."""
    marks, least, most, again = _runs_of_marks(marks, items)
    times = 1 + again
    items = np.repeat(least, times)
    items[(np.cumsum(times) - 1)[again]] = most[again]
    marks = np.repeat(marks, times)
    shift = np.uint64(64 - RANGE_BITS)
    bounds = np.append(np.searchsorted(marks, np.arange(1 << RANGE_BITS, dtype=np.uint64) << shift), len(marks))
    some = np.flatnonzero(np.diff(bounds))
    bounds = np.append(bounds[some], len(marks))
    return pa.RecordBatch.from_arrays(
        [pa.array(some.astype(np.int32)), _packed(marks, bounds), _packed(items, bounds)], ["part", "marks", "items"])


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, marks, items): for each paragraph its name under itself, and its name under each of its keys.

    Marks travel by range, as bytes. items hold 32 bits of the name, which tell apart the few names under one mark.
    """
    marks, items, held = [], [], 0
    for batch in words.pieces(batches, limit=words.BLOCK):
        cut = Cut(batch)
        own, _, keys = cut.banded()
        marks += [cut.names, keys.ravel()]
        items += [words.signed(x).astype(np.int32) for x in (cut.names, np.repeat(cut.names[own], BANDS))]
        held += len(cut.names) + keys.size
        if held > MARKS_HELD:
            yield _by_range(np.concatenate(marks), np.concatenate(items))
            marks, items, held = [], [], 0
    if held:
        yield _by_range(np.concatenate(marks), np.concatenate(items))


def _repeated_marks(rows: pa.Table) -> pa.Table:
    """(mark, a, b) of the marks of a range that stand there more than once, with their least and greatest item."""
    marks, items = (np.frombuffer(b"".join(rows.column(name).to_pylist()), kind) for name, kind in (("marks", np.uint64), ("items", np.int32)))
    marks, least, most, again = _runs_of_marks(marks, items)
    return pa.table({"mark": words.signed(marks[again]), "a": least[again], "b": most[again]})


def _candidates(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(item, keys, members) of the paragraphs with a shared key; members are their shingles."""
        for batch in words.pieces(batches, limit=words.BLOCK):
            cut = Cut(batch, windows=False)
            own, _, keys = cut.banded()
            some = np.flatnonzero(bitsets.has(shared, keys).any(1)) if len(own) else own
            if not len(some):
                continue
            own, keys = own[some], keys[some]
            members, ends = cut.shingles_of(own)
            lists = [pa.ListArray.from_arrays(pa.array(np.append(0, at).astype(np.int32)), pa.array(words.signed(flat)))
                     for flat, at in ((keys.ravel(), np.arange(1, len(own) + 1) * BANDS), (members, ends))]
            yield pa.RecordBatch.from_arrays([pa.array(words.signed(cut.names[own])), *lists], ["item", "keys", "members"])
    return run


_PLACE = "name long, doc_id long, text_id long, series int, first long, last long, low long, high long"


def _places(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The paragraphs whose names may be in `shared`, with their words and bytes in their text."""
        for batch in words.pieces(batches, limit=words.BLOCK):
            cut = Cut(batch)
            own = np.flatnonzero(bitsets.has(shared, cut.names))
            if not len(own):
                continue
            first, last = cut.first[own], cut.last[own]
            taken = batch.select(["doc_id", "text_id"]).take(pa.array(cut.row[own]))  # without the texts
            ends = last - cut.text_first[cut.row[own]]
            # up to the start of the next word, so that what is cut out takes its white space along
            more = np.append(cut.text_first[1:], len(cut.starts))[cut.row[own]] > last
            high = np.where(more, np.append(cut.starts, 0)[last], cut.ends[last - 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(words.signed(cut.names[own])), taken.column("doc_id"), taken.column("text_id"),
                 pa.array(cut.series[own], pa.int32()), pa.array(first - cut.text_first[cut.row[own]]), pa.array(ends),
                 pa.array(cut.starts[first]), pa.array(high)],
                ["name", "doc_id", "text_id", "series", "first", "last", "low", "high"])
    return run


_CONTEXT = ("name long, doc_id long, text_id long, first long, before array<int>, before_at array<int>, "
            "after array<int>, after_at array<int>")


def _lists(values: np.ndarray, some: np.ndarray) -> pa.Array:
    """The values of each row where `some` holds, as lists of int."""
    offsets = np.concatenate([[0], np.cumsum(some.sum(1))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[some].astype(np.int32)))


def _around(cut: Cut, own: np.ndarray) -> list[pa.Array]:
    """Hashes of the SELECT - 1 words before each window, nearest first, and where these start; and of those after it.

    No run that two texts share goes on for more words beyond the windows that are selected in it.
    """
    step = np.arange(SELECT - 1)
    text_first, text_end = (np.append(cut.text_first, len(cut.starts))[cut.row[own] + k][:, None] for k in (0, 1))
    hashes = (cut.hashes >> np.uint64(32)).astype(np.uint32).view(np.int32)
    before, after = cut.first[own][:, None] - 1 - step, cut.last[own][:, None] + step
    some, more = before >= text_first, after < text_end
    before, after = np.maximum(before, 0), np.minimum(after, len(hashes) - 1)
    up_to = np.where(after + 1 < text_end, cut.starts[np.minimum(after + 1, len(hashes) - 1)], cut.ends[after])
    return [_lists(hashes[before], some), _lists(cut.starts[before], some), _lists(hashes[after], more), _lists(up_to, more)]


def _contexts(texts, names):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words around windows whose names may be in `names`, of texts whose keys may be in `texts`."""
        for batch in batches:
            batch = batch.filter(pa.array(bitsets.has(texts, batch.column("key").to_numpy())))
            for piece in words.pieces([batch], limit=words.BLOCK):
                cut = Cut(piece, paragraphs=False)
                own = np.flatnonzero(bitsets.has(names, cut.names)) if len(cut.names) else cut.row
                if not len(own):
                    continue
                taken = piece.select(["doc_id", "text_id"]).take(pa.array(cut.row[own]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.signed(cut.names[own])), taken.column("doc_id"), taken.column("text_id"),
                     pa.array(cut.first[own] - cut.text_first[cut.row[own]]), *_around(cut, own)],
                    ["name", "doc_id", "text_id", "first", "before", "before_at", "after", "after_at"])
    return run


def _near(work: Workspace, docs: DataFrame, shared: DataFrame) -> DataFrame:
    """(item, component) of paragraphs that are linked with a different one; shared: (mark), keys of several names."""
    # a paragraph asks for BANDS keys, so the set has more room than one that is asked for single names
    bits = bitsets.bit_set(shared.withColumnRenamed("mark", "name"), 2 * BANDS * shared.count())
    rows = docs.mapInArrow(_candidates(bits), "item long, keys array<long>, members array<long>")
    found = work.keep(rows.groupBy("item").agg(F.first("keys").alias("keys"), F.first("members").alias("members")), "found")
    buckets = found.select("item", F.size("members").cast("long").alias("n"), F.explode("keys").alias("bucket"))
    buckets = work.keep(buckets.join(shared.withColumnRenamed("mark", "bucket"), "bucket", "left_semi"), "band-rows")
    full = buckets.groupBy("bucket").agg(F.count("*").alias("k"), F.bit_xor(F.xxhash64("item")).alias("who"))
    same = full.where("k > 1").groupBy("k", "who").agg(F.min("bucket").alias("bucket"))  # equal buckets once
    scores = buckets.join(full, "bucket").groupBy("item").agg(F.sum("k").alias("score"))
    buckets = work.keep(buckets.join(same.select("bucket"), "bucket", "left_semi").join(scores, "item"), "buckets")
    work.drop("band-rows")
    return link_buckets(work, buckets, found.select("item", "members"), PERCENT, "near")


def _in_common(a: str, b: str) -> Column:
    """How many of the elements at the start of two arrays are equal."""
    equal = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    first = F.array_position(equal, False)
    return F.when(first == 0, F.size(equal)).otherwise(first - 1).cast("int")


_RUN = "doc_id long, text_id long, first long, last long, low long, high long, first_doc_id long, component long, best long"
_EDGE = "first:long,last:long,low:long,high:long,first_doc_id:long,component:long,first_text:long,first_place:long,room:int"
_NUMBERS = ("first", "last", "low", "high")


def _runs(edges: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The runs of each text's spans: those that start before or where an earlier one ends are joined.

        A run has the first document and the component of its first span. best: the greatest of its spans, or, if they
        have none, the words of its longest stretch from one first document. edges: the windows (`room` is not null) of
        each run that may be extended over an end of it, as what lies further in is covered whatever they share.
        """
        for batch in batches:
            lists = batch.column("spans")
            spans = lists.flatten()
            field = {name: spans.field(name) for name in spans.type.names}
            first, last, low, high = (field[name].to_numpy() for name in _NUMBERS)
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            if not len(row):
                continue
            # texts have less than 2 ** 40 words; in order of text, the highest end so far is one of the same text, or lower
            shift = row.astype(np.int64) << 40
            top = np.maximum.accumulate(last + shift)
            start = np.append(True, first[1:] + shift[1:] > top[:-1])
            runs = np.flatnonzero(start)
            source, known = field["first_doc_id"].fill_null(0).to_numpy(), field["first_doc_id"].is_valid().to_numpy(zero_copy_only=False)
            anew = start | np.append(True, (source[1:] != source[:-1]) | (known[1:] != known[:-1]))
            stretch = first[np.maximum.accumulate(np.where(anew, np.arange(len(row)), 0))]
            best = np.maximum.reduceat(field["best"].to_numpy() if "best" in field else top - shift - stretch, runs)
            run_first, run_last = first[runs], np.maximum.reduceat(last, runs)
            of_text = batch.select(["doc_id", "text_id"]).take(pa.array(row[runs]))
            of_span = spans.take(pa.array(runs))
            columns = {"doc_id": of_text.column("doc_id"), "text_id": of_text.column("text_id"),
                       "first": pa.array(run_first), "last": pa.array(run_last),
                       "low": pa.array(np.minimum.reduceat(low, runs)), "high": pa.array(np.maximum.reduceat(high, runs)),
                       "first_doc_id": of_span.field("first_doc_id"), "component": of_span.field("component"),
                       "best": pa.array(best)}
            if edges:
                own = np.cumsum(start) - 1
                some = field["room"].is_valid().to_numpy(zero_copy_only=False) & (
                    (first - run_first[own] < SELECT - 1) | (run_last[own] - last < SELECT - 1))
                at = np.concatenate([[0], np.cumsum(np.add.reduceat(some.astype(np.int64), runs))]).astype(np.int32)
                columns["edges"] = pa.ListArray.from_arrays(pa.array(at), spans.take(pa.array(np.flatnonzero(some))))
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
    return run


def _extended(edges: DataFrame) -> DataFrame:
    """Late windows with all words before and after that stand at the first occurrence too, up to that occurrence."""
    edges = edges.withColumns({"b": F.least(_in_common("before", "first_before"), F.col("room")),
                               "a": _in_common("after", "first_after")})
    return edges.select(
        "doc_id", "text_id", (F.col("first") - F.col("b")).alias("first"), (F.col("last") + F.col("a")).alias("last"),
        F.when(F.col("b") > 0, F.get("before_at", F.col("b") - 1).cast("long")).otherwise(F.col("low")).alias("low"),
        F.when(F.col("a") > 0, F.get("after_at", F.col("a") - 1).cast("long")).otherwise(F.col("high")).alias("high"),
        "first_doc_id", "component", (F.col("last") - F.col("first") + F.col("a") + F.col("b")).alias("best"))


def _edges_extended(work: Workspace, docs: DataFrame, runs: DataFrame) -> DataFrame:
    """The extended windows at the ends of `runs`; the words around them and their first occurrences come from the texts."""
    edges = work.keep(runs.select("doc_id", "text_id", F.explode("edges").alias("edge")).select("doc_id", "text_id", "edge.*"), "edges")
    count = edges.count()
    both = edges.select("doc_id", "text_id").union(edges.select("first_doc_id", "first_text"))
    keys = bitsets.bit_set(both.select(F.xxhash64("doc_id", "text_id").alias("name")), 2 * count)
    names = bitsets.bit_set(edges.select(F.col("component").alias("name")), count)  # a window is its own component
    found = docs.withColumn("key", F.xxhash64("doc_id", "text_id")).mapInArrow(_contexts(keys, names), _CONTEXT)
    found = work.keep(found, "contexts")

    def beside(place: list[str], prefix: str) -> tuple[DataFrame, Column]:
        """Contexts of the windows at the places that the edges' columns name, each once, and how to join them."""
        wanted = edges.select(*(F.col(c).alias(f"_{k}") for k, c in enumerate(["component", *place]))).distinct()
        at = [F.col(c).eqNullSafe(F.col(f"_{k}")) for k, c in enumerate(["name", "doc_id", "text_id", "first"])]
        rows = found.join(wanted, at[0] & at[1] & at[2] & at[3]).groupBy("_0", "_1", "_2", "_3").agg(
            *(F.first(c).alias(prefix + c) for c in ("before", "before_at", "after", "after_at")))
        rows = rows.withColumnsRenamed({f"_{k}": f"{prefix}key{k}" for k in range(4)})
        same = [F.col(c).eqNullSafe(F.col(f"{prefix}key{k}")) for k, c in enumerate(["component", *place])]
        return rows, same[0] & same[1] & same[2] & same[3]

    own, same = beside(["doc_id", "text_id", "first"], "")
    other, same_first = beside(["first_doc_id", "first_text", "first_place"], "first_")
    return _extended(edges.join(own, same).join(other, same_first))


def repeated_passages(docs: DataFrame, least_words: int = 30, least_stretch: int = 16) -> DataFrame:
    """(doc_id, text_id, low, high, n_words, first_doc_id, component) of every passage to take out of `docs`.

    Paragraphs are equal or have at least 80 per cent of their five-word shingles in common, directly or through others
    (component). The first occurrence, by doc_id and place, stays; of the others, those that touch or overlap in one
    text form a passage, and passages of `least_words` words or more are returned, if `least_stretch` words on end were
    first in one document (a few short common lines in a row are no passage). low and high are byte offsets in the
    UTF-8 text, high at the next word. Of a run of 50 words or more that two texts share, the later one goes whole, however
    many sentences it has; shorter ones go if they hold whole paragraphs. Short repeated lines stay.

    - Words are runs outside white space, A-Z lower-cased. Null, empty and blank texts have no paragraphs.
    - Rows with a null doc_id come last in order. Rows of one doc_id and one text (text_id, its hash) are one document.
    - Other columns are not read; an empty table gives an empty result.
    """
    work = Workspace(docs.sparkSession, "paragraphs")
    docs = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_id"), "text")
    docs = docs.where("text is not null")
    marks = docs.mapInArrow(_marks, "part int, marks binary, items binary").groupBy("part").applyInArrow(
        _repeated_marks, "mark long, a int, b int")
    marks = work.keep(marks, "marks")
    name = F.col("mark").bitwiseAND(0xFFFFFFFF)
    same = (F.col("a") == F.col("b")) & (F.col("a").cast("long").bitwiseAND(0xFFFFFFFF) == name)
    repeated = marks.where(same).select(F.col("mark").alias("name"))
    near = work.keep(_near(work, docs, marks.where("a <> b").select("mark")), "near")
    work.clear("marks", "near")
    classes = repeated.join(near.withColumnRenamed("item", "name"), "name", "full").select(
        "name", F.coalesce("component", "name").alias("component"))
    classes = work.keep(classes, "classes")
    places = work.keep(docs.mapInArrow(_places(bitsets.bit_set(classes, classes.count())), _PLACE), "places")
    # the first place of each name, then of each component; a name that is everywhere leaves each task as one row
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_id", "first", "last")
    named = places.groupBy("name").agg(F.min(place).alias("o"), F.count("*").alias("k"))
    named = work.keep(named.join(classes.hint("merge"), "name"), "named")
    firsts = named.groupBy("component").agg(F.min("o").alias("o"), F.sum("k").alias("k")).where("k > 1")
    firsts = work.keep(named.select("name", "component").join(firsts.hint("merge"), "component").select(
        "name", "component", F.col("o.doc_id").alias("first_doc_id"), F.col("o.text_id").alias("first_text"),
        F.col("o.first").alias("first_place"), F.col("o.last").alias("first_last")), "firsts")
    late = places.join(firsts.hint("merge"), "name").withColumn(
        "own", F.col("doc_id").eqNullSafe(F.col("first_doc_id")) & (F.col("text_id") == F.col("first_text")))
    # a window that overlaps its own first occurrence (words over and over) is part of it
    late = late.where(~F.col("own") | (F.col("first") >= F.col("first_last")))
    room = F.when(F.col("own"), F.least(F.col("first") - F.col("first_last"), F.lit(SELECT))).otherwise(F.lit(SELECT))
    late = late.select("doc_id", "text_id", F.struct(
        "first", "last", "low", "high", "first_doc_id", "component", "first_text", "first_place",
        F.when(F.col("series") == 2, room.cast("int")).alias("room")).alias("span"))
    # as sets: rows of one doc_id and one text are one document
    spans = late.groupBy("doc_id", "text_id").agg(F.array_sort(F.collect_set("span")).alias("spans"))
    runs = work.keep(spans.mapInArrow(_runs(True), f"{_RUN}, edges array<struct<{_EDGE}>>"), "bare-runs")
    work.clear("bare-runs")
    more = _edges_extended(work, docs, runs).union(runs.select(
        "doc_id", "text_id", "first", "last", "low", "high", "first_doc_id", "component", "best"))
    spans = more.groupBy("doc_id", "text_id").agg(F.array_sort(F.collect_list(F.struct(
        "first", "last", "low", "high", "first_doc_id", "component", "best"))).alias("spans"))
    runs = spans.mapInArrow(_runs(False), _RUN).withColumn("n_words", F.col("last") - F.col("first"))
    runs = runs.where((F.col("n_words") >= least_words) & (F.col("best") >= least_stretch))
    runs = work.keep(runs.select("doc_id", "text_id", "low", "high", "n_words", "first_doc_id", "component"), "runs")
    work.clear("runs")
    return runs


def without_passages(docs: DataFrame, least_words: int = 30) -> DataFrame:
    """`docs`, all columns, with the passages of repeated_passages cut out of text, and n_chars counted anew.

    Rows that have no word left are dropped; rows that had none before stay.
    """
    runs = repeated_passages(docs, least_words)
    cuts = runs.groupBy("doc_id", "text_id").agg(F.array_sort(F.collect_list(F.struct("low", "high"))).alias("cuts"))
    cuts = cuts.withColumnsRenamed({"doc_id": "cut_doc", "text_id": "cut_text"})
    # all columns of the input go in a struct, whatever their names
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"),
                       F.xxhash64("text").alias("text_id"))
    rows = rows.join(cuts, F.col("doc_id").eqNullSafe(F.col("cut_doc")) & (F.col("text_id") == F.col("cut_text")), "left")
    data = F.encode("text", "utf-8")
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("cuts", lambda c: c["high"]))
    begins = F.concat(F.transform("cuts", lambda c: c["low"]), F.array(F.octet_length("text").cast("long")))
    rest = F.array_join(F.zip_with(ends, begins, lambda a, b: F.decode(
        F.substring(data, (a + 1).cast("int"), (b - a).cast("int")), "utf-8")), "")
    rows = rows.withColumn("text", F.when(F.col("cuts").isNull(), F.col("text")).otherwise(rest))
    rows = rows.where(F.col("cuts").isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    row = F.col("row")
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("cuts").isNull(), row.getField("n_chars")).otherwise(
            F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*(new.get(name, row.getField(name)).alias(name) for name in docs.columns))
