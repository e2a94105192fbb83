"""A data source over byte ranges of files: a sample of a large file reads no more than the sample.

``spark.read.format("byte_ranges").option("path", uri)`` gives (path, start, size, content). Options: ``range``
bytes a row (8 MiB), ``head`` to read no more than so many bytes of each file, ``lines`` true for whole lines,
each in the row in whose range it begins. As a stream it gives the ranges of files that arrive; as a sink it
writes binary rows to files that a manifest names once all tasks have ended.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage

SCHEMA = "path string, start long, size long, content binary"
#: Bytes that a task reads at least, so that small files share tasks, and that are read at once to find a line's end.
TASK_BYTES, STEP = 32 << 20, 64 << 10


def _system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def listed(uri: str) -> list[tuple[int, str, int]]:
    """(modified, path, size) of the files of a folder, or of one file, the oldest first."""
    from pyarrow import fs

    system, root = _system(uri)
    info = system.get_file_info(root)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(root, recursive=True)) if info.type == fs.FileType.Directory else []
    return sorted((i.mtime_ns or 0, i.path, i.size) for i in found if i.type == fs.FileType.File and not i.base_name.startswith(("_", ".")))


@dataclass
class Ranges(InputPartition):
    """(path, start, size) of the ranges that one task reads."""

    ranges: list[tuple[str, int, int]]


def dealt(files: list[tuple[int, str, int]], size: int, head: int | None) -> list[Ranges]:
    out, own, total = [], [], 0
    for _, path, whole in files:
        end = whole if head is None else min(whole, head)
        for start in range(0, end, size):
            own.append((path, start, min(size, end - start)))
            total += own[-1][2]
            if total >= TASK_BYTES:
                out.append(Ranges(own))
                own, total = [], 0
    return [*out, Ranges(own)] if own else out


def aligned(file, start: int, size: int, whole: int) -> tuple[int, bytes]:
    """(start, content) of the lines that begin in the range."""

    def after(at: int) -> int:
        """Where the first line begins that begins at ``at`` or later."""
        if at <= 0 or at >= whole:
            return max(0, min(at, whole))
        at -= 1
        while at < whole:
            found = file.read_at(min(STEP, whole - at), at).find(b"\n")
            if found >= 0:
                return at + found + 1
            at += min(STEP, whole - at)
        return whole

    first, last = after(start), after(start + size)
    return first, file.read_at(last - first, first) if last > first else b""


class _Reading:
    def __init__(self, options: dict):
        self.uri, self.size = options["path"], int(options.get("range", 8 << 20))
        self.head = int(options["head"]) if "head" in options else None
        self.lines = str(options.get("lines", "false")).lower() == "true"
        if self.size < 1:
            raise ValueError("a range has a byte at least")

    def rows(self, part: Ranges):
        system, _ = _system(self.uri)
        for path, start, size in part.ranges:
            with system.open_input_file(path) as file:
                if not self.lines:
                    content = file.read_at(size, start)
                    yield path, start, len(content), content
                    continue
                whole = file.size() if self.head is None else min(file.size(), self.head)
                first, content = aligned(file, start, size, whole)
                if content:
                    yield path, first, len(content), content


class Reader(_Reading, DataSourceReader):
    def partitions(self):
        return dealt(listed(self.uri), self.size, self.head)

    def read(self, partition):
        yield from self.rows(partition)


class StreamReader(_Reading, DataSourceStreamReader):
    """Offsets count the files by age, so files must arrive whole and keep their times."""

    def initialOffset(self):
        return {"files": 0}

    def latestOffset(self):
        return {"files": len(listed(self.uri))}

    def partitions(self, start, end):
        return dealt(listed(self.uri)[start["files"] : end["files"]], self.size, self.head)

    def read(self, partition):
        yield from self.rows(partition)


@dataclass
class Written(WriterCommitMessage):
    path: str
    rows: int
    size: int


class Writer(DataSourceWriter):
    """Each task writes one file of its rows' content; ``_manifest.json`` names those of the tasks that counted."""

    def __init__(self, options: dict):
        self.uri, self.run = options["path"], uuid.uuid4().hex

    def write(self, iterator):
        from pyspark import TaskContext

        system, root = _system(self.uri)
        system.create_dir(root, recursive=True)
        path, rows, size = f"{root}/{self.run}-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.bin", 0, 0
        with system.open_output_stream(path) as out:
            for row in iterator:
                out.write(row["content"])
                rows, size = rows + 1, size + len(row["content"])
        return Written(path, rows, size)

    def commit(self, messages):
        system, root = _system(self.uri)
        draft = f"{root}/_manifest.{self.run}"
        with system.open_output_stream(draft) as out:
            out.write(json.dumps([{"path": m.path, "rows": m.rows, "size": m.size} for m in messages if m is not None and m.rows]).encode())
        system.move(draft, f"{root}/_manifest.json")

    def abort(self, messages):
        system, _ = _system(self.uri)
        for m in messages:
            if m is not None:
                system.delete_file(m.path)


class ByteRanges(DataSource):
    @classmethod
    def name(cls):
        return "byte_ranges"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return Reader(dict(self.options))

    def streamReader(self, schema):
        return StreamReader(dict(self.options))

    def writer(self, schema, overwrite):
        return Writer(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ByteRanges)
