"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own features and those of the lines before and after it; forward-backward
marginals, weighted by line length, make the document's quality.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runweave.llm import words
from runweave.llm.labelled import remainder, training_texts


def _byte_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[list(members)] = 1
    return table


#: Kinds of bytes whose share in a line is a feature.
KINDS = [_byte_table(x) for x in (
    b"#*$%&|<>^~=+_\\/{}[]@", b"!?", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b".,;:", bytes(range(128, 256)))]
#: Features of one line: bias, byte kinds, then words, their length, repeats and the look of the line's ends.
WIDTH = len(KINDS) + 8


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lines, WIDTH) features of the lines of all texts, their lengths in bytes, and the text each belongs to."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.flatnonzero(buf == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    text_ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    of_text = np.searchsorted(text_ends, ends)
    length = ends - starts
    size = np.maximum(length, 1)
    columns = [np.ones(len(starts))]
    for table in KINDS:
        sums = np.concatenate([[0], np.cumsum(table[buf])])
        columns.append((sums[ends] - sums[starts]) / size)
    word_start, word_end = words.word_spans(buf)
    hashes = words.span_hashes(buf, word_start, word_end)
    line = np.searchsorted(ends, word_start)
    count = np.bincount(line, minlength=len(starts))
    some = np.maximum(count, 1)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    order = np.lexsort((hashes, line))
    old = np.zeros(len(hashes), bool)
    old[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]) & (line[order[1:]] == line[order[:-1]])
    names = np.zeros(len(starts), np.uint64)
    full = count > 0
    if full.any():
        names[full] = np.add.reduceat(words.mix(hashes), np.searchsorted(line, np.flatnonzero(full)))
    same = np.zeros(len(starts), bool)
    same[1:] = (names[1:] == names[:-1]) & (of_text[1:] == of_text[:-1]) & full[1:]
    first = buf[np.where(full, starts, 0)]
    last = buf[np.where(length > 0, ends - 1, 0)]
    columns += [np.log1p(count), np.bincount(line, word_end - word_start, len(starts)) / some / 10,
                np.bincount(line, again, len(starts)) / some, np.bincount(line, old, len(starts)) / some,
                same, full & (KINDS[3][first] > 0), full & np.isin(last, list(b".!?"))]
    return np.stack(columns, 1).astype(float), length * full, of_text


def with_neighbours(x: np.ndarray, of_text: np.ndarray) -> np.ndarray:
    """Each line's features beside those of the lines before and after it; zeros at a text's ends."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    joined = of_text[1:] == of_text[:-1]
    before[1:][joined] = x[:-1][joined]
    after[:-1][joined] = x[1:][joined]
    return np.concatenate([x, before, after], 1)


class Chains:
    """The lines of many texts, so that step t of all texts is one array operation."""

    def __init__(self, of_text: np.ndarray, texts: int):
        self.start = np.searchsorted(of_text, np.arange(texts))
        self.count = np.bincount(of_text, minlength=texts)
        self.order = np.argsort(-self.count, kind="stable")
        falling = -self.count[self.order]
        self.alive = [int(np.searchsorted(falling, -t)) for t in range(int(self.count.max(initial=0)) + 1)]

    def at(self, t: int) -> np.ndarray:
        """Line t of the texts that have more than t lines, longest text first."""
        return self.start[self.order[:self.alive[t]]] + t

    def messages(self, unary: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward log-odds that reach each line; unary are the lines' own log-odds."""
        forward, backward = np.zeros_like(unary), np.zeros_like(unary)
        steps = len(self.alive) - 1
        for t in range(1, steps):
            here = self.at(t)
            odds = unary[here - 1] + forward[here - 1]
            forward[here] = np.logaddexp(odds + pair[1, 1], pair[0, 1]) - np.logaddexp(odds + pair[1, 0], pair[0, 0])
        for t in range(steps - 1, 0, -1):
            here = self.at(t)
            odds = unary[here] + backward[here]
            backward[here - 1] = np.logaddexp(odds + pair[1, 1], pair[1, 0]) - np.logaddexp(odds + pair[0, 1], pair[0, 0])
        return forward, backward


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


@dataclass
class Field:
    weights: np.ndarray
    pair: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def unary(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x, length, of_text = line_features(texts)
        return with_neighbours((x - self.mean) / self.scale, of_text) @ self.weights, length, of_text

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Length-weighted mean marginal of good lines; 0 for a text without words."""
        unary, length, of_text = self.unary([(t or "").encode() for t in texts])
        forward, backward = Chains(of_text, len(texts)).messages(unary, self.pair)
        good = _sigmoid(unary + forward + backward)
        total = np.bincount(of_text, length, len(texts))
        return np.where(total > 0, np.bincount(of_text, good * length, len(texts)) / np.maximum(total, 1), 0.0)


def fit(sample: list[tuple[str, int]], epochs: int = 120, rate: float = 0.05, ridge: float = 1e-3) -> Field:
    """Maximum likelihood by Adam; each line carries the label of its document."""
    mean, scale, pair = np.zeros(WIDTH), np.ones(WIDTH), np.zeros((2, 2))
    if len({y for _, y in sample}) < 2:
        return Field(np.zeros(3 * WIDTH), pair, mean, scale)
    x, _, of_text = line_features([text.encode() for text, _ in sample])
    mean[1:], scale[1:] = x[:, 1:].mean(0), x[:, 1:].std(0) + 1e-6
    x = with_neighbours((x - mean) / scale, of_text)
    y = np.array([label for _, label in sample], float)[of_text]
    chains = Chains(of_text, len(sample))
    weights = np.zeros(x.shape[1])
    joined = np.flatnonzero(of_text[1:] == of_text[:-1])
    seen = np.array([[np.sum((1 - y[joined]) * (1 - y[joined + 1])), np.sum((1 - y[joined]) * y[joined + 1])],
                     [np.sum(y[joined] * (1 - y[joined + 1])), np.sum(y[joined] * y[joined + 1])]])
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(pair), np.zeros_like(pair)]
    for step in range(1, epochs + 1):
        unary = x @ weights
        forward, backward = chains.messages(unary, pair)
        good = _sigmoid(unary + forward + backward)
        left, right = (unary + forward)[joined], (unary + backward)[joined + 1]
        cells = np.stack([np.zeros_like(left) + pair[0, 0], right + pair[0, 1], left + pair[1, 0], left + right + pair[1, 1]])
        cells = np.exp(cells - cells.max(0))
        expected = (cells / cells.sum(0)).sum(1).reshape(2, 2)
        slopes = [x.T @ (good - y) / len(y) + ridge * weights, (expected - seen) / len(y) + ridge * pair]
        for k, (value, slope) in enumerate(((weights, slopes[0]), (pair, slopes[1]))):
            first, second = moments[2 * k], moments[2 * k + 1]
            first += 0.1 * (slope - first)
            second += 0.01 * (slope * slope - second)
            value -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return Field(weights, pair, mean, scale)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in words.pieces(batches):
            scores = field.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(scores)], ["doc_id", "score"])
    return run


def quality(docs: DataFrame, labels: DataFrame, modulus: int = 5, held_out: int = 0, threshold: float = 0.3,
            per_class: int = 800, max_chars: int = 12_000) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of `docs` (doc_id, text); only the text enters the score.

    The field is fitted on the driver from a bounded sample: at most `per_class` texts of either label of up to
    `max_chars` characters, from ids whose crc32 modulo `modulus` is not `held_out`. Every whole text is then scored.

    - Null, empty and blank texts score 0. With fewer than two classes of labels every line is undecided (0.5).
    - A null doc_id is scored, held_out is null for it; repeated rows are each answered; other columns are not read.
    """
    sample = training_texts(docs, labels, "quality", remainder(F.col("doc_id"), modulus) != held_out, per_class, max_chars)
    shared = docs.sparkSession.sparkContext.broadcast(fit(sample))
    scored = docs.select("doc_id", "text").mapInArrow(_score(shared), "doc_id long, score double")
    return scored.select("doc_id", (remainder(F.col("doc_id"), modulus) == held_out).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
