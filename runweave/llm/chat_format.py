"""Chat formatting that reads back as it was.

A conversation becomes one marked text. The marks may also stand in what people wrote, so each text is parsed again as
soon as it is rendered; turns that do not come back as they were are escaped, until the parsed turns equal the source.
Only content that conflicts is changed, and the change is undone by the parser.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runweave.llm.words import pieces

#: The marks around a turn; fixed values of the template.
START, END = "<|im_start|>", "<|im_end|>"
MARK = re.compile(r"<\|im_(?:start|end)\|>")
#: What escaping lengthens by a backslash, and what the parser shortens by one.
OPENS, ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
IN_ROLE = {"\\": "\\\\", "\n": "\\n", "|": "\\p"}
OF_ROLE = {escaped[1]: char for char, escaped in IN_ROLE.items()}
#: Characters after which a long conversation goes on in its next piece, and those that a task hands on together.
PIECE, TOGETHER = 1 << 20, 1 << 22

Turn = tuple[str, str]


def escape(turn: Turn) -> Turn:
    """The turn without any mark: a backslash more in each <| of the text, whatever backslashes it has."""
    role, text = turn
    return re.sub(r"[\\\n|]", lambda m: IN_ROLE[m[0]], role), OPENS.sub(r"<\1\\|", text)


def unescape_text(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text)


def _unescape_role(role: str) -> str:
    return re.sub(r"\\([\\np])", lambda m: OF_ROLE[m[1]], role)


def render(turns: list[Turn]) -> str:
    return "".join(f"{START}{role}\n{text}{END}\n" for role, text in turns)


def parse(formatted: str) -> list[tuple[str, str, int, int]] | None:
    """(role, text, start and end of the text as formatted) of each turn; None if the text is not of the grammar

        conversation = { START role NEWLINE text END NEWLINE }

    where a role has no newline and neither a role nor a text has a mark. Each step is decided by the next mark.
    """
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            return None
        first = at + len(START)
        mark = MARK.search(formatted, first)
        line = formatted.find("\n", first)
        if mark is None or mark[0] != END or not first <= line < mark.start() or not formatted.startswith("\n", mark.end()):
            return None
        turns.append((_unescape_role(formatted[first:line]), unescape_text(formatted[line + 1:mark.start()]),
                      line + 1, mark.start()))
        at = mark.end() + 1
    return turns


def _read_back(turns: list[Turn]) -> list[Turn] | None:
    found = parse(render(turns))
    return found and [turn[:2] for turn in found]


def settle(turns: list[Turn]) -> list[Turn]:
    """The turns as they are to be rendered: those that do not read back as they are, escaped."""
    if not turns or _read_back(turns) == turns:
        return turns
    out = [turn if _read_back([turn]) == [turn] else escape(turn) for turn in turns]
    if _read_back(out) != turns:
        out = [escape(turn) for turn in turns]
        if _read_back(out) != turns:
            raise AssertionError("an escaped conversation does not read back")
    return out


def _formatted(learned: str):
    """Rows sorted by conversation and turn -> its pieces, each rendered, read back and with the spans to learn from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        out, size, count = [], 0, 0
        turns: list[Turn] = []
        length, conv, begun, cut = 0, None, 0, False

        def piece(whole: bool) -> tuple:
            nonlocal count, turns, length
            text = render(settle(turns))
            found = parse(text)
            if [turn[:2] for turn in found] != turns:
                raise AssertionError("a conversation does not read back")
            loss = [{"start": start, "end": end} for role, _, start, end in found if role == learned]
            count, turns, length = count + 1, [], 0
            return conv, base + count, whole, text, loss

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out))
            types = [pa.int64(), pa.int64(), pa.bool_(), pa.string(),
                     pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                              ["conv_id", "piece", "whole", "formatted", "loss"])

        for rows in pieces(batches):
            for own, role, text in zip(*(rows.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if begun and own != conv:
                    # the first conversation of a task may have begun in the task before
                    out.append(piece(whole=begun > 1 and not cut))
                    size += len(out[-1][3])
                    begun, cut = begun + 1, False
                elif length > PIECE:
                    out.append(piece(whole=False))
                    size += len(out[-1][3])
                    cut = True
                conv, begun = own, begun or 1
                turns.append((role, text))
                length += len(role) + len(text)
                if size > TOGETHER:
                    yield batch()
                    out, size = [], 0
        if begun:
            out.append(piece(whole=False))
        if out:
            yield batch()

    return run


def formatted(conversations: DataFrame, learned: str = "assistant") -> DataFrame:
    """(conv_id, piece, whole, formatted, loss): the conversations of (conv_id, turn, role, text) as marked texts.

    A conversation is the concatenation of its pieces in the order of `piece`; most have one. Pieces end between turns,
    after PIECE characters or where a task's rows end, and each is of the grammar on its own. whole: this piece is known
    to be all of its conversation. loss: spans of `formatted`, in characters, that hold the texts of the role `learned`.

    - Turns are in the order of `turn` (null first), then role, then text; repeated rows are all kept.
    - A null text or role is empty, and rows with a null conv_id are one conversation. Empty texts are turns.
    - Roles may hold anything; newlines, backslashes and bars in a role that conflicts are escaped.
    - An empty table gives no rows. Other columns are not read.

    One shuffle, by ranges of conversation and turn: a conversation that holds a third of all rows is formatted by many
    tasks, each in memory of a piece.
    """
    key = [F.col(c) for c in ("conv_id", "turn", "role")]
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # equal turns are told apart by their texts' first characters, which sort as the texts do
    rows = rows.repartitionByRange(*key, F.substring("text", 1, 32)).sortWithinPartitions(*key, "text")
    return rows.mapInArrow(_formatted(learned), "conv_id long, piece long, whole boolean, formatted string, "
                                                "loss array<struct<start: int, end: int>>")


class _Digest:
    """What is read off the pieces of one conversation, one after the other."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, text: str, loss: list[dict]) -> None:
        found = parse(text)
        if found is None:
            raise ValueError("not a formatted conversation")
        for role, said, _, _ in found:
            self.turns.update(f"{role}\n{said}\n".encode())
        for span in loss:
            said = unescape_text(text[span["start"]:span["end"]])
            self.loss.update(said.encode())
            self.loss_chars += len(said)
        self.n_turns += len(found)
        self.chars += len(text)

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


_RESULT = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_PASSED = "piece long, formatted string, loss array<struct<start: int, end: int>>"


def _results(rows: list[tuple]) -> list[pa.Array]:
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]


_NAMES = [part.split()[0] for part in _RESULT.split(", ")]


def _whole_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces that are whole conversations become results; the others are passed on."""
    for rows in pieces(batches, "formatted"):
        columns = [rows.column(c).to_pylist() for c in ("conv_id", "whole", "piece", "formatted", "loss")]
        results, passed = [], []
        for conv, whole, *rest in zip(*columns):
            digest = _Digest()
            if whole:
                digest.add(*rest[1:])
            results.append((conv, *digest.row()) if whole else (conv, *[None] * 5))
            passed.append([None] * 3 if whole else rest)
        types = [rows.schema.field(c).type for c in ("piece", "formatted", "loss")]
        yield pa.RecordBatch.from_arrays(
            [*_results(results), *(pa.array([r[k] for r in passed], t) for k, t in enumerate(types))],
            [*_NAMES, "piece", "formatted", "loss"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and piece -> one result a conversation."""
    digest, own = None, None
    for rows in pieces(batches, "formatted"):
        out = []
        for *result, text, loss in zip(*(rows.column(c).to_pylist() for c in (*_NAMES, "formatted", "loss"))):
            if digest and (text is None or result[0] != own):
                out.append((own, *digest.row()))
                digest = None
            if text is None:
                out.append(result)
                continue
            digest, own = digest or _Digest(), result[0]
            digest.add(text, loss)
        yield pa.RecordBatch.from_arrays(_results(out), _NAMES)
    if digest:
        yield pa.RecordBatch.from_arrays(_results([(own, *digest.row())]), _NAMES)


def digests(chats: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) read off the output of `formatted`.

    turns_sha256 is over role, newline, text, newline of each parsed turn, loss_sha256 over what the loss spans hold,
    unescaped; lengths are in characters. Whole pieces are read where they are; only pieces of conversations that two
    tasks or pieces share are shuffled. The digest of one conversation is one stream in the order of its pieces.
    """
    passed = chats.mapInArrow(_whole_ones, f"{_RESULT}, {_PASSED}")
    return passed.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(_joined, _RESULT)
