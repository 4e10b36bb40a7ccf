"""Token ids of whole texts by a vocabulary file of the tokenizers library, encoding each distinct piece of text once."""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

#: Characters on which libraries may disagree about white space; texts with one are encoded in one go. Fixed values.
ODD = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\xa0 ᠎ -‏ -  -⁤　﻿]")
#: Pieces at whose ends the vocabularies always cut: letters before a mark, and other runs without white space. The
#: byte-level one keeps a blank with the word behind it and has tokens for other white space; the other has none, and
#: lower-cases, which Python's own lower() does alike but for the letter in LOWER_ODD.
SPACED = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+(?=[.,!?;:%*&#$|])| ?[^ \t\n\r]+|[ \t\n\r]+(?![^ \t\n\r])|[ \t\n\r]+")
PLAIN = re.compile(r"[a-zà-öø-ÿ]+(?=[.,!?;:%*&#$|])|[^ \t\n\r]+")
LOWER_ODD = "Σ"
#: Pieces that stay known, and further ones that are forgotten together.
KEPT, PASSING = 900_000, 200_000
LONGEST = 64
#: New pieces without white space are encoded so many in one text, with a word between them that is one token.
MARK, TOGETHER = "~", 64


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids.

    keeps_space: the vocabulary has tokens for white space; else it drops white space and lower-cases.
    """

    def __init__(self, path: str, keeps_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.keeps_space = keeps_space
        self.known: dict[str, bytes] = {}
        self.passing: list[str] = []
        marks = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = marks[0] if len(marks) == 1 and not keeps_space else None

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in (x.ids for x in found)]

    def _encode_pieces(self, some: list[str]) -> Iterator[tuple[str, bytes]]:
        """Each piece with its ids; pieces with the mark in them are encoded alone."""
        alone = some if self.mark is None else [piece for piece in some if MARK in piece]
        yield from zip(alone, self._encode(alone))
        rest = [] if self.mark is None else [piece for piece in some if MARK not in piece]
        blocks = [rest[low:low + TOGETHER] for low in range(0, len(rest), TOGETHER)]
        texts = [f" {MARK} ".join(block) for block in blocks]
        for block, found in zip(blocks, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            ends, raw = 4 * np.flatnonzero(ids == self.mark), ids.tobytes()
            yield from zip(block, (raw[low:high] for low, high in zip([0, *(ends + 4).tolist()], [*ends.tolist(), len(raw)])), strict=True)

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, in order."""
        plain = [not ODD.search(text) and (self.keeps_space or LOWER_ODD not in text) for text in texts]
        found = iter((self._of_cuts if self.keeps_space else self._of_words)([t for t, ok in zip(texts, plain) if ok]))
        return [next(found) if ok else self._encode([text])[0] for text, ok in zip(texts, plain)]

    def _of_words(self, texts: list[str]) -> list[bytes]:
        """Texts whose pieces end at white space: each distinct run of other characters is looked up once, and cut if new."""
        runs = pc.ascii_split_whitespace(pa.array([text.lower() for text in texts], pa.large_string()))
        distinct = runs.flatten().dictionary_encode()
        names = distinct.dictionary.to_pylist()
        known = list(map(self.known.get, names))
        rest = iter(self._joined([PLAIN.findall(run) for run, raw in zip(names, known) if raw is None]))
        ids = pa.array([next(rest) if raw is None else raw for raw in known], pa.large_binary()).take(distinct.indices)
        if not len(ids):
            return []
        ends = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset + runs.offsets.to_numpy()].tolist()
        raw = ids.buffers()[2]
        return [raw[low:high].to_pybytes() for low, high in zip(ends, ends[1:])]

    def _of_cuts(self, texts: list[str]) -> list[bytes]:
        return self._joined([SPACED.findall(text) for text in texts])

    def _joined(self, cuts: list[list[str]]) -> list[bytes]:
        """The ids of the pieces of each cut one after the other; pieces that are not known are encoded."""
        known = self.known
        if len(self.passing) > PASSING:
            for piece in self.passing:
                known.pop(piece, None)
            self.passing = []
        out, late = [], []
        for k, cut in enumerate(cuts):
            try:
                out.append(b"".join(map(known.__getitem__, cut)))
            except KeyError:
                out.append(b"")
                late.append(k)
        new = list({piece for k in late for piece in cuts[k] if piece not in known})
        for low in range(0, len(new), 4096):
            known.update(self._encode_pieces(new[low:low + 4096]))
        for k in late:
            out[k] = b"".join(map(known.__getitem__, cuts[k]))
        for piece in new:
            if len(known) > KEPT or len(piece) > LONGEST:
                self.passing.append(piece)
        return out


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, keeps_space: bool) -> Encoder:
    """The encoder of this worker process, which keeps what it has learned for later tasks."""
    if (path, keeps_space) not in _encoders:
        _encoders[path, keeps_space] = Encoder(path, keeps_space)
    return _encoders[path, keeps_space]


def vocabulary(name: str) -> str:
    return public_tokenizers.path(name)
