"""Toxicity: subword-bag embeddings averaged into a linear softmax, both trained together in numpy.

A word is the mean of the embeddings of its character n-grams (3 to 5 bytes, word edges included) and of itself, hashed
into buckets, so a misspelling that was never seen shares most of its parts with the word. Passages of up to PASSAGE
words, one from every half of that on, are the mean of their words; a linear softmax over that mean gives their
probability. A document scores as its most toxic passage, so a few words in a long text are not thinned out.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from runweave.llm import words
from runweave.llm.labelled import remainder, training_rows

BUCKETS = 1 << 18
WIDTH = 8
GRAMS = (3, 4, 5)
PASSAGE = 48
#: Subwords whose share of the texts differs between the labels by fewer standard errors are pulled to zero harder.
EVIDENCE = 5.0


def spread(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text's bytes with one kind of white space and an edge of it on both sides; starts and ends of its words."""
    raw = np.frombuffer(b" " + text + b" " * max(GRAMS), np.uint8)
    buf = np.where(words.WHITE[raw], np.uint8(32), raw)
    return buf, *words.word_spans(buf)


def gram_buckets(buf: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each size of n-gram, the bucket of the n-gram that starts at each byte."""
    wide = buf.astype(np.uint64)
    gram, size = wide, 1
    for n in GRAMS:
        while size < n:
            gram = gram[:-1] | (wide[size:] << np.uint64(8 * size))
            size += 1
        yield n, ((gram + np.uint64(n)) * words.FOLD >> np.uint64(64 - 18)).astype(np.int32)


def gram_range(starts: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the n-grams of each word start, edges included: from, and up to."""
    return starts - 1, np.maximum(ends + 2 - n, starts - 1)


def word_buckets(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words themselves, and their buckets."""
    names = words.span_hashes(buf, starts, ends)
    return names, (names >> np.uint64(64 - 18)).astype(np.int32)


def passages(n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and ends of the passages of a text: PASSAGE words from every half of that on, the last may be shorter."""
    first = np.arange(0, max(1, n_words - PASSAGE // 2), PASSAGE // 2)
    return first, np.minimum(first + PASSAGE, n_words)


@dataclass
class Model:
    """The part of each bucket in the log-odds, and their base."""

    parts: np.ndarray
    base: float

    def word_parts(self, text: bytes) -> np.ndarray:
        """The log-odds that each word of a text adds to a passage of its own."""
        buf, starts, ends = spread(text)
        total, count = self.parts[word_buckets(buf, starts, ends)[1]], np.ones(len(starts))
        for n, bucket in gram_buckets(buf):
            sums = np.concatenate([[0.0], np.cumsum(self.parts[bucket])])
            low, high = gram_range(starts, ends, n)
            total += sums[high] - sums[low]
            count += high - low
        return total / count

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.full(len(texts), 1 / (1 + np.exp(-self.base)))
        for k, text in enumerate(texts):
            best, data = -np.inf, (text or "").lower().encode()
            for low, high in words.stretches(data):
                word = self.word_parts(data[low:high])
                if len(word):
                    first, end = passages(len(word))
                    sums = np.concatenate([[0.0], np.cumsum(word)])
                    best = max(best, float(((sums[end] - sums[first]) / (end - first)).max()))
            if best > -np.inf:
                out[k] = 1 / (1 + np.exp(-np.clip(self.base + best, -50, 50)))
        return out


def fit(sample: list[tuple[str, int]], epochs: int = 40, rate: float = 0.001, prior: float = 10.0, seed: int = 7) -> Model:
    """Full-batch descent with momentum on embeddings and softmax together.

    First all passages carry their text's label, then the most toxic passage of each text does. Each embedding's step is
    divided by its curvature, and `prior` texts' worth of curvature pulls it to zero, so a subword counts for as much as
    the number of texts that speak for it. All subwords of the sample are trained; of one whose share differs between the
    labels by z < EVIDENCE standard errors, the prior is (EVIDENCE / z) ** 2 times as strong, which is never a bar.
    """
    if len({y for _, y in sample}) < 2:
        return Model(np.zeros(BUCKETS), -4.0)
    kinds: dict[int, int] = {}
    features, sizes, token_kind, token_passage, passage_text = [], [], [], [], []
    texts_with = np.zeros((2, BUCKETS))
    for k, (text, label) in enumerate(sample):
        buf, starts, ends = spread(text.lower().encode())
        if not len(starts):
            continue
        names, whole = word_buckets(buf, starts, ends)
        names = names.tolist()
        new = [at for at, name in enumerate(names) if name not in kinds and kinds.setdefault(name, len(kinds)) >= 0]
        own, held = [], [whole]
        for n, bucket in gram_buckets(buf):
            low, high = gram_range(starts, ends, n)
            inside = np.zeros(len(bucket) + 1, np.int32)
            np.add.at(inside, low, 1)
            np.add.at(inside, high, -1)
            held.append(bucket[np.cumsum(inside[:-1]) > 0])
            low, high = gram_range(starts[new], ends[new], n)
            own.append([bucket[i:j] for i, j in zip(low, high)])
        texts_with[label, np.unique(np.concatenate(held))] += 1
        parts = [np.concatenate([whole[at:at + 1], *(column[i] for column in own)]) for i, at in enumerate(new)]
        sizes += map(len, parts)
        features += [np.concatenate(parts)] if parts else []  # one array a text
        first, end = passages(len(starts))
        spot = np.repeat(first - np.cumsum(end - first) + (end - first), end - first) + np.arange((end - first).sum())
        token_kind.append(np.array([kinds[name] for name in names], np.int32)[spot])
        token_passage.append(np.repeat(np.arange(len(first), dtype=np.int32) + len(passage_text), end - first))
        passage_text += [k] * len(first)
    n = np.bincount([label for _, label in sample], minlength=2)
    if not features:
        return Model(np.zeros(BUCKETS), float(np.log(n[1] / n[0])))
    used, bucket = np.unique(np.concatenate(features), return_inverse=True)
    shares = texts_with[:, used] / n[:, None]
    both = texts_with[:, used].sum(0) / n.sum()
    error = np.sqrt(both * (1 - both) * (1 / n).sum()) + 1e-12
    seen = np.maximum(np.abs(shares[1] - shares[0]) / error, 1e-3)
    pull = prior * np.maximum(1.0, EVIDENCE / seen) ** 2
    bucket, sizes = bucket.astype(np.int32), np.array(sizes)
    kind = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    del features
    token_kind, token_passage = np.concatenate(token_kind), np.concatenate(token_passage)
    passage_text = np.array(passage_text)
    y = np.array([label for _, label in sample], float)[passage_text]
    text_start = np.flatnonzero(np.diff(passage_text, prepend=-1))
    length = np.bincount(token_passage, minlength=len(y))
    weight = 1.0 / np.bincount(passage_text)[passage_text]

    of_kind = sizes[kind].astype(float) ** 2
    tokens_of_kind = np.bincount(token_kind, (weight / length ** 2)[token_passage], len(sizes))
    curve = np.bincount(bucket, tokens_of_kind[kind] / of_kind, len(used)) / (4 * weight.sum())
    one = (1 / (PASSAGE * sizes.mean())) ** 2 / (4 * weight.sum())
    rng = np.random.default_rng(seed)
    e, w, b = np.zeros((len(used), WIDTH)), rng.normal(0, 0.5, (WIDTH, 2)), np.zeros(2)
    speed = [np.zeros_like(e), np.zeros_like(w), np.zeros_like(b)]
    for epoch in range(epochs):
        vectors = np.stack([np.bincount(kind, e[bucket, d], len(sizes)) for d in range(WIDTH)], 1) / sizes[:, None]
        mean = np.stack([np.bincount(token_passage, vectors[token_kind, d], len(y)) for d in range(WIDTH)], 1)
        mean /= length[:, None]
        logits = mean @ w + b
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        if epoch < epochs // 2:
            share = weight
        else:  # the most toxic passage of each text alone
            top = np.maximum.reduceat(p[:, 1], text_start)
            share = (p[:, 1] >= np.repeat(top, np.diff(np.append(text_start, len(y))))).astype(float)
        share = share / share.sum()
        error = (p - np.stack([1 - y, y], 1)) * share[:, None]
        into = (error @ w.T) / length[:, None]
        to_kind = np.stack([np.bincount(token_kind, into[token_passage, d], len(sizes)) for d in range(WIDTH)], 1)
        to_kind /= sizes[:, None]
        slope = np.stack([np.bincount(bucket, to_kind[kind, d], len(used)) for d in range(WIDTH)], 1)
        norm = float(((w[:, 1] - w[:, 0]) ** 2).sum()) / 2
        slope = (slope / norm + pull[:, None] * one * e) / (curve + pull * one)[:, None]
        for k, (value, step) in enumerate(((e, rate * slope), (w, 0.01 * mean.T @ error), (b, 0.2 * error.sum(0)))):
            speed[k] = 0.9 * speed[k] - step
            value += speed[k]
    turn = w[:, 1] - w[:, 0]
    parts = np.zeros(BUCKETS)
    parts[used] = e @ turn
    return Model(parts, float(b[1] - b[0]))


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a sample, in order -> the model fitted on them, pickled."""
    sample = [pair for batch in batches for pair in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist())]
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(sample))], pa.binary())], ["model"])


def _score(shared, names: list[str], out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in words.pieces(batches):
            scores = model.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in names), pa.array(scores)], [*names, out])
    return run


def _scored(docs: DataFrame, labels: DataFrame, names: list[str], modulus: int, held_out: int, per_class: int,
            max_chars: int) -> tuple[DataFrame, str]:
    """The columns `names` of `docs` and the score, and the name of that column, which no column of `docs` has.

    The model is fitted by one task, whose rows the sample's bounds limit; the driver only passes its weights on.
    """
    usable = remainder(F.col("doc_id"), modulus) != held_out
    sample = training_rows(docs, labels, "toxic", usable, per_class, max_chars)
    fitted = sample.repartition(1).sortWithinPartitions("draw").mapInArrow(_fit, "model binary").collect()
    shared = docs.sparkSession.sparkContext.broadcast(pickle.loads(fitted[0].model) if fitted else fit([]))
    out = "score"
    while out.lower() in {c.lower() for c in docs.columns}:
        out += "_"
    schema = StructType([docs.schema[name] for name in names] + [StructField(out, DoubleType())])
    return docs.select(*dict.fromkeys([*names, "text"])).mapInArrow(_score(shared, names, out), schema), out


def toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1, threshold: float = 0.7,
             per_class: int = 800, max_chars: int = 12_000) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of `docs` (doc_id, text); only the text enters the score.

    The model is fitted by one task from a bounded sample: at most `per_class` texts of either label of up to
    `max_chars` characters, from ids whose crc32 modulo `modulus` is not `held_out`. Every whole text is then scored.

    - Null, empty and blank texts get the score of a text without evidence. With fewer than two classes of labels all
      scores are the low base.
    - A null doc_id is scored, held_out is null for it; repeated rows are each answered; other columns are not read.
    """
    scored, score = _scored(docs, labels, ["doc_id"], modulus, held_out, per_class, max_chars)
    return scored.select("doc_id", (remainder(F.col("doc_id"), modulus) == held_out).alias("held_out"),
                         F.col(score).alias("score"), (F.col(score) >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, modulus: int = 3, held_out: int = 1,
                  per_class: int = 800, max_chars: int = 12_000) -> DataFrame:
    """The rows of `docs`, all columns, that score below `threshold`; as in `toxicity` otherwise. Nothing is shuffled."""
    scored, score = _scored(docs, labels, docs.columns, modulus, held_out, per_class, max_chars)
    return scored.where(F.col(score) < threshold).drop(score)
