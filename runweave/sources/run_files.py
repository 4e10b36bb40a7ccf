"""The files of run folders as a Spark data source, listed and opened by the executors.

`spark.read.format("run_files")` has a row for each entry that the patterns of the run format match, or, with the
option `content`, a row for each text. Filters on `run` and `source` reach the source: other runs get no task, and of
other sources no folder is listed and no file is opened. Unlike Spark's file sources this one sees folders, empty files
and names that start with an underscore, and the driver lists nothing.

Spark keeps one set of pushed filters for each loaded frame: a query that uses the same frame twice has to filter it
alike, or load it twice. Frames that are handed to users are loaded with `push` empty, and are filtered by Spark.
"""

from __future__ import annotations

import fnmatch
import io
import json
import os
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull

from runweave.config import CONTENT_SOURCES, SOURCE_GLOBS

LISTING = "run string, source string, path string, folder string, name string, is_dir boolean, length bigint"
TEXTS = ("run string, source string, path string, folder string, name string, pos bigint, "
         "content string, problem string")
#: Run folders that one scan takes: their names, not their files, are gathered on the driver.
MOST_RUNS = 1_000_000
#: Rows and bytes of text that a task holds before it hands them on; runs of a task at most.
_BATCH_ROWS, _BATCH_BYTES, _CHUNK = 5000, 16 << 20, 64


@lru_cache(maxsize=64)
def _client(store: str):
    """(file system, what its paths start with) of a scheme and authority; kept by the worker process."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(f"{store}/") if store else (fs.LocalFileSystem(), "")


def file_system(path: str):
    """(file system, path on it) for a plain path or a URI such as s3:// or hdfs://."""
    store, rest = re.fullmatch(r"([^:/]+://[^/]*)?(.*)", path, re.DOTALL).groups()
    system, top = _client(store or "")
    return system, top.rstrip("/") + rest


def _local_entries(folder: str) -> Iterator[tuple[str, bool, int]]:
    """(name, is_dir, size) of a folder on a mounted disk; a dangling link counts by its name."""
    try:
        with os.scandir(folder) as entries:
            for entry in entries:
                is_file = entry.is_file()
                yield entry.name, entry.is_dir(), entry.stat().st_size if is_file else -1
    except (FileNotFoundError, NotADirectoryError):
        return


def _remote_entries(folder: str) -> Iterator[tuple[str, bool, int]]:
    from pyarrow import fs

    system, local = file_system(folder)
    for info in system.get_file_info(fs.FileSelector(local, allow_not_found=True)):
        yield info.base_name, info.type == fs.FileType.Directory, info.size if info.is_file else -1


def _children(folder: str, pattern: str) -> Iterator[tuple[str, bool, int]]:
    """Entries of one folder that match one pattern; dot files only match a pattern with a dot."""
    if "*" not in pattern:
        system, local = file_system(f"{folder}/{pattern}")
        info = system.get_file_info(local)
        if info.type.name != "NotFound":
            yield f"{folder}/{pattern}", info.type.name == "Directory", info.size if info.is_file else -1
        return
    for name, is_dir, size in (_remote_entries if "://" in folder else _local_entries)(folder):
        hidden = name.startswith(".") and not pattern.startswith(".")
        if not hidden and fnmatch.fnmatchcase(name, pattern):
            yield f"{folder}/{name}", is_dir, size


def _matches(folder: str, parts: Sequence[str], mine) -> Iterator[tuple[str, bool, int]]:
    """(path, is_dir, size) of the entries below a folder that match the parts of a pattern.

    mine(path) says of each entry at the first wildcard (or of the only path) whether this task goes on with it.
    """
    while len(parts) > 1 and "*" not in parts[0]:
        folder, parts = f"{folder}/{parts[0]}", parts[1:]
    for path, is_dir, size in _children(folder, parts[0]):
        if mine is not None and not mine(path):
            continue
        if len(parts) == 1:
            yield path, is_dir, size
        elif is_dir:
            yield from _matches(path, parts[1:], None)


def log_lines(stream, start: int = 0, end: int | None = None) -> Iterator[tuple[int, str]]:
    """(byte position, text) of the finished-task lines of a log that begin in start..end - 1.

    A line belongs to the range in which its first byte lies, so ranges that follow each other give each line once.
    """
    at = start
    if start:
        stream.seek(start - 1)
        at = start - 1 + len(stream.readline())  # the rest of a line that began before
    while end is None or at < end:
        line = stream.readline()
        if not line:
            return
        if b"Task completed" in line:
            yield at, line.decode("utf-8")
        at += len(line)


def read_text(path: str, source: str, start: int = 0, end: int | None = None) -> Iterator[tuple[int, str | None, str | None]]:
    """(pos, text, problem) of a file: one row, or for a task log one for each line of a finished task, by position.

    A task log may be long: only these lines are kept, and `start` and `end` give a part of it.
    """
    system, local = file_system(path)
    try:
        if source == "task_log":
            with system.open_input_file(local) as stream:
                yield from ((at, line, None) for at, line in log_lines(io.BufferedReader(stream, 1 << 20), start, end))
            return
        with system.open_input_stream(local) as stream:
            data = stream.read()
        text = data.decode("utf-8").removeprefix("\ufeff")
        yield 0, text.replace("\r\n", "\n").replace("\r", "\n"), None
    except FileNotFoundError:
        yield 0, None, "missing"
    except (OSError, UnicodeDecodeError) as error:
        yield 0, None, type(error).__name__


@dataclass
class _Share(InputPartition):
    """Some runs, and of each of them every `of`-th entry by a hash of its path."""

    runs: tuple[str, ...]
    share: int
    of: int


class RunFilesReader(DataSourceReader):
    def __init__(self, options):
        self.runs: list[str] = json.loads(options["runs"])
        globs = json.loads(options.get("globs", "null"))
        self.globs: dict[str, tuple[str, str]] = globs or SOURCE_GLOBS
        self.content = options.get("content", "false") == "true"
        self.tasks, self.shares = int(options.get("tasks", "32")), int(options.get("shares", "8"))
        self.push = [(c,) for c in options.get("push", "run,source").split(",") if c]
        self.sources = [s for s in self.globs if not self.content or s in CONTENT_SOURCES]

    def __getstate__(self):
        return {**self.__dict__, "runs": []}  # each partition brings its own

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute if isinstance(f, (EqualTo, In, IsNotNull)) else None
            if column not in self.push:
                yield f
            elif not isinstance(f, IsNotNull):  # neither column is ever null
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                name = f"{column[0]}s"
                setattr(self, name, [x for x in getattr(self, name) if x in wanted])

    def partitions(self) -> list[_Share]:
        if not self.sources:
            return []
        size = min(_CHUNK, max(1, -(-len(self.runs) * self.shares // self.tasks)))
        chunks = [tuple(self.runs[low:low + size]) for low in range(0, len(self.runs), size)]
        return [_Share(chunk, k, self.shares) for chunk in chunks for k in range(self.shares)]

    def _entries(self, part: _Share) -> Iterator[tuple[str, str, str, str, str, bool, int]]:
        mine = lambda path: zlib.crc32(path.encode()) % part.of == part.share
        for run in part.runs:
            for source in self.sources:
                base, glob = self.globs[source]
                top = run.rpartition("/")[0] if base == "parent" else run
                for path, is_dir, length in _matches(top, glob.split("/"), mine):
                    yield run, source, path, path.split("/")[-2], path.split("/")[-1], is_dir, length

    def _rows(self, part: _Share) -> Iterator[tuple]:
        for *entry, is_dir, length in self._entries(part):
            if not self.content:
                yield *entry, is_dir, length
            elif not is_dir:
                for row in read_text(entry[2], entry[1]):
                    yield *entry, *row

    def read(self, part: _Share | None) -> Iterator[pa.RecordBatch]:
        if part is None:
            return
        kinds = [pa.string()] * 5 + ([pa.int64(), pa.string(), pa.string()] if self.content else [pa.bool_(), pa.int64()])
        names = [c.split()[0] for c in (TEXTS if self.content else LISTING).split(", ")]
        out, size = [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

        for row in self._rows(part):
            out.append(row)
            size += len(row[6] or "") if self.content else 0
            if len(out) >= _BATCH_ROWS or size > _BATCH_BYTES:
                yield batch()
                out, size = [], 0
        if out:
            yield batch()


class RunFiles(DataSource):
    """Options: runs (JSON list of folders); content (true: the texts); globs (JSON: source -> base, pattern); tasks (how
    many there should be at least, if there are files enough); shares (how many tasks list and read the same run); push (columns, out
    of run and source, whose filters the source takes over)."""

    @classmethod
    def name(cls) -> str:
        return "run_files"

    def schema(self) -> str:
        return TEXTS if self.options.get("content", "false") == "true" else LISTING

    def reader(self, schema) -> RunFilesReader:
        return RunFilesReader(self.options)


def folders(runs: DataFrame) -> list[str]:
    """The run folders of a table, at most MOST_RUNS."""
    found = [row.run for row in runs.select("run").limit(MOST_RUNS + 1).collect()]
    if len(found) > MOST_RUNS:
        raise ValueError(f"over {MOST_RUNS} run folders at once: land them in several calls")
    return sorted(found)


def run_files(spark: SparkSession, runs: Sequence[str], content: bool = False,
              globs: dict[str, tuple[str, str]] = SOURCE_GLOBS, shares: int = 8, push: str = "run,source") -> DataFrame:
    """The entries (or texts) of run folders. A run of very many files is shared by `shares` tasks. See above on `push`."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RunFiles)
    return spark.read.format("run_files").options(
        runs=json.dumps(list(runs)), globs=json.dumps(globs), content=str(content).lower(),
        tasks=str(4 * spark.sparkContext.defaultParallelism), shares=str(shares), push=push).load()
