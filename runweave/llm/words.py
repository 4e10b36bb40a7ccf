"""Words, shingles and their hashes for whole batches of texts, as numpy arrays.

A word is a run of bytes outside \\x20 and \\x09-\\x0D. All functions are pure and give the same values on every
machine. Texts are worked through in blocks of about BLOCK bytes, so memory does not depend on how long a text is,
apart from 24 bytes for each of its words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
#: Odd multipliers of the rolling hash, of its inverse and of the mixer; fixed values.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
FOLD = np.uint64(0xD6E8FEB86659FD93)

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True


def pieces(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = 2 * BLOCK) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `limit` bytes of text, so a task's memory does not follow its batches."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        low = 0
        while low < batch.num_rows:
            before = int(ends[low - 1]) if low else 0
            high = max(low + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(low, high - low)
            low = high


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x *= MIX_1
    x ^= x >> np.uint64(27)
    x *= MIX_2
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK // 4, 2 * len(self.up))
            for name, base in (("up", BASE), ("down", BASE_INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_powers = _Powers()


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words in a buffer of bytes."""
    edge = np.diff(WHITE[buf].astype(np.int8), prepend=1, append=1)
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of the buffer."""
    up, down = _powers(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * FOLD)


def _blocks(texts: list[bytes]):
    """Runs of texts of about BLOCK bytes together; a longer text comes alone."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > BLOCK:
            yield first, i
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def stretches(text: bytes):
    """Offsets that cut one long text near each BLOCK bytes, always at white space."""
    low = 0
    while low < len(text):
        high = low + BLOCK
        while high < len(text) and not WHITE[text[high]]:
            high += 1
        yield low, min(high, len(text))
        low = high


def hashed_words(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each text: the hashes, starts and ends (byte offsets) of its words."""
    out = []
    for first, last in _blocks(texts):
        if last == first + 1 and len(texts[first]) > BLOCK:
            parts = []
            for low, high in stretches(texts[first]):
                buf = np.frombuffer(texts[first], np.uint8, high - low, low)
                starts, ends = word_spans(buf)
                parts.append((span_hashes(buf, starts, ends), starts + low, ends + low))
            out.append(tuple(np.concatenate(column) for column in zip(*parts)))
            continue
        buf = np.frombuffer(b"\n".join(texts[first:last]), np.uint8)
        starts, ends = word_spans(buf)
        hashes = span_hashes(buf, starts, ends)
        offsets = np.cumsum([0, *(len(t) + 1 for t in texts[first:last])])
        cuts = np.searchsorted(starts, offsets)
        for k in range(last - first):
            own = slice(cuts[k], cuts[k + 1])
            out.append((hashes[own], starts[own] - offsets[k], ends[own] - offsets[k]))
    return out


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words, repeats included; fewer words are one shingle; no words, none."""
    if not len(words):
        return words
    width = min(size, len(words))
    count = len(words) - width + 1
    out = words[:count] + np.uint64(width)
    for k in range(1, width):
        out = mix(out * FOLD + words[k : k + count])
    return out


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return np.ascontiguousarray(x).view(np.int64)
