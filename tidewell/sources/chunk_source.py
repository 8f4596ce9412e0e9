"""Chunk files of JSON lines as a data source: ``spark.read``, ``readStream`` and ``write`` with ``format("chunks")``.

A row is ``(chunk, number, line)``: the file's name, the line's number from 1, and the line. Files named ``.xz`` are
decompressed as they are read; such a file cannot be split, so a file is read by one task. What is written lies in a
folder of its own until the job commits, so a repeated or failed task leaves no file that counts.
"""

from __future__ import annotations

import lzma
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

LINE = "chunk string, number long, line string"
_ARROW = pa.schema([("chunk", pa.string()), ("number", pa.int64()), ("line", pa.string())])
BATCH_LINES = 4096
#: Tasks that files are dealt to, at most.
MOST_TASKS = 10_000
PENDING = "_pending"
#: Level of xz: the default, 6, takes ten times as long for files a fifth smaller.
LEVEL = 1


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and place of a path or URI."""
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path.removeprefix("file:")


def file_lines(fs: pafs.FileSystem, file: str) -> Iterator[bytes]:
    """Lines of a file, decompressed while it is read if it is named ``.xz``."""
    with fs.open_input_stream(file, compression=None) as raw:
        source = lzma.open(raw, "rb") if file.endswith(".xz") else raw
        tail = b""
        while block := source.read(1 << 20):
            *whole, tail = (tail + block).split(b"\n")
            yield from whole
        if tail:
            yield tail


@dataclass
class Files(InputPartition):
    """Files that one task reads."""

    names: list[str]

    def __init__(self, names: list[str]) -> None:
        self.names = names


@dataclass
class Written(WriterCommitMessage):
    """Files that one task has written under the pending folder: name, chunk, lines."""

    files: list[tuple[str, str, int]]


class _Folder:
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]

    def listed(self) -> list[tuple[int, str]]:
        """``(time, name)`` of the files, in order of arrival."""
        fs, root = open_folder(self.path)
        found = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
        hidden = lambda f: any(part.startswith(("_", ".")) for part in os.path.relpath(f.path, root).split("/"))
        return sorted((f.mtime_ns or 0, f.path) for f in found if f.type == pafs.FileType.File and not hidden(f))

    def dealt(self, names: list[str]) -> list[Files]:
        tasks = min(len(names), MOST_TASKS)
        return [Files(names[i::tasks]) for i in range(tasks)] or [Files([])]

    def rows(self, names: list[str]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_folder(self.path)
        for file in names:
            lines: list[str] = []
            first, name = 1, os.path.basename(file)

            def batch() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([
                    pa.array([name] * len(lines), pa.string()), pa.array(range(first, first + len(lines)), pa.int64()), pa.array(lines, pa.string())],  # noqa: B023
                    schema=_ARROW)

            try:
                for line in file_lines(fs, file):
                    lines.append(line.decode("utf-8"))
                    if len(lines) == BATCH_LINES:
                        yield batch()
                        first, lines = first + len(lines), []
            except (EOFError, lzma.LZMAError, UnicodeDecodeError) as error:
                raise ValueError(f"chunk {name} cannot be read to its end; see broken_chunks") from error
            if lines:
                yield batch()


class ChunkReader(_Folder, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        return self.dealt([name for _, name in self.listed()])

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return self.rows(partition.names)


class ChunkStreamReader(_Folder, DataSourceStreamReader):
    """Files in order of their time and name; a file is to be moved in whole, with a time no earlier than those there."""

    def initialOffset(self) -> dict:
        return {"time": -1, "name": ""}

    def latestOffset(self) -> dict:
        time, name = max(self.listed(), default=(-1, ""))
        return {"time": time, "name": name}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        since, until = (start["time"], start["name"]), (end["time"], end["name"])
        return self.dealt([name for time, name in self.listed() if since < (time, name) <= until])

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return self.rows(partition.names)


class ChunkWriter(DataSourceArrowWriter):
    """One file per chunk and task, moved into place when the whole job has succeeded."""

    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        self.path, self.overwrite = options["path"], overwrite
        self.ending = ".json" if options.get("compress", "true") == "false" else ".json.xz"
        self.job = uuid.uuid4().hex

    def _pending(self, root: str) -> str:
        return f"{root}/{PENDING}/{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        fs, root = open_folder(self.path)
        fs.create_dir(self._pending(root), recursive=True)
        task = TaskContext.get()
        mark = f"{task.partitionId():05d}-{uuid.uuid4().hex[:8]}" if task else uuid.uuid4().hex
        open_files: dict[str, list] = {}
        done, current = [], None

        def close(chunk: str) -> None:
            name, raw, out, lines = open_files.pop(chunk)
            out.close()
            if out is not raw:
                raw.close()
            done.append((name, chunk, lines))

        for batch in iterator:
            for chunk, line in zip(batch.column("chunk").to_pylist(), batch.column("line").to_pylist(), strict=True):
                if chunk != current:
                    # Rows come in order of their chunk, so one file is open at a time.
                    if current is not None:
                        close(current)
                    current = chunk
                    name = f"{chunk}-{mark}{self.ending}"
                    raw = fs.open_output_stream(f"{self._pending(root)}/{name}", compression=None)
                    open_files[chunk] = [name, raw, lzma.open(raw, "wb", preset=LEVEL) if self.ending.endswith("xz") else raw, 0]
                held = open_files[chunk]
                held[2].write(line.encode("utf-8") + b"\n")
                held[3] += 1
        if current is not None:
            close(current)
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = open_folder(self.path)
        if self.overwrite:
            for info in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
                if info.type == pafs.FileType.File:
                    fs.delete_file(info.path)
        for message in messages:
            for name, _, _ in message.files if message else ():
                fs.move(f"{self._pending(root)}/{name}", f"{root}/{name}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = open_folder(self.path)
        if fs.get_file_info(self._pending(root)).type == pafs.FileType.Directory:
            fs.delete_dir(self._pending(root))


class ChunkSource(DataSource):
    """Options: ``path``; for writing ``compress`` (``true`` or ``false``)."""

    @classmethod
    def name(cls) -> str:
        return "chunks"

    def schema(self) -> str:
        return LINE

    def reader(self, schema: StructType) -> ChunkReader:
        return ChunkReader(self.options)

    def streamReader(self, schema: StructType) -> ChunkStreamReader:
        return ChunkStreamReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> ChunkWriter:
        return ChunkWriter(self.options, overwrite)


def register(spark: SparkSession) -> SparkSession:
    """Make ``format("chunks")`` known to the session."""
    spark.dataSource.register(ChunkSource)
    return spark
