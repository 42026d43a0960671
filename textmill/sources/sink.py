"""Named files of lines, in order, plain or xz, written in two phases.

A task writes each of its files under a name that no other attempt has, below a folder of this write; when Spark has accepted one
attempt of every task, the driver renames those files and deletes the folder, with what lost attempts left in it. A write that
fails deletes the folder. So a file is there as a whole or not at all, and killed tasks leave nothing.

A file is one task's, so its lines are in order; there are as many tasks as partitions, and files are dealt to them by name. An .xz
file is a row of streams, each of BLOCK bytes of lines, which threads compress beside each other; a longer line is a block of its own.

existing says what becomes of files that are there: `error` (before anything is renamed), `replace`, or `append` (the new file
begins with the bytes of the old one, so that it too appears as a whole).

Defined results: lines have a newline between them, none after the last; a null line is an empty line; a null file name is an error; rows without lines make no file; equal lines stay.
"""

from __future__ import annotations

import lzma
import uuid
from collections import deque
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

BLOCK = 4 << 20


def open_folder(address: str) -> tuple[fs.FileSystem, str]:
    """A file system and a path in it; addresses without a scheme are local."""
    return fs.FileSystem.from_uri(address) if "://" in address else (fs.LocalFileSystem(), address.rstrip("/"))


def there(system: fs.FileSystem, path: str) -> bool:
    return system.get_file_info(path).type != fs.FileType.NotFound


class Lines:
    """One file that is being written."""

    def __init__(self, system: fs.FileSystem, path: str, before: str | None, threads: int | None, level: int):
        self.out = system.open_output_stream(path, compression=None)
        self.pool, self.threads, self.level = ThreadPoolExecutor(threads) if threads else None, threads, level
        self.waiting: deque = deque()
        self.block, self.size, self.started = [], 0, before is not None
        if before:
            with system.open_input_stream(before, compression=None) as old:
                while part := old.read(BLOCK):
                    self.out.write(part)

    def write(self, line: str | None) -> None:
        data = b"\n" * self.started + (line or "").encode()
        self.started = True
        self.block.append(data)
        self.size += len(data)
        if self.size >= BLOCK:
            self.flush()

    def flush(self) -> None:
        data, self.block, self.size = b"".join(self.block), [], 0
        if not data:
            return
        if self.pool is None:
            self.out.write(data)
            return
        self.waiting.append(self.pool.submit(lzma.compress, data, preset=self.level))
        while len(self.waiting) > self.threads:
            self.out.write(self.waiting.popleft().result())

    def close(self) -> None:
        self.flush()
        while self.waiting:
            self.out.write(self.waiting.popleft().result())
        if self.pool:
            self.pool.shutdown()
        self.out.close()


@dataclass
class Written(WriterCommitMessage):
    """(file name, name of its attempt)"""

    files: list[tuple[str, str]]


class FilesWriter(DataSourceArrowWriter):
    """Takes batches of file, value, …: a file's rows follow each other."""

    def __init__(self, options: dict):
        self.folder, self.existing = options["path"], options.get("existing", "error")
        self.threads, self.level = int(options.get("threads", 1)), int(options.get("level", 6))
        self.pending = f"_pending-{uuid.uuid4().hex}"
        if self.existing not in ("error", "replace", "append"):
            raise ValueError(f"existing: {self.existing}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, top = open_folder(self.folder)
        system.create_dir(f"{top}/{self.pending}", recursive=True)
        now, out, done = None, None, []
        for batch in iterator:
            for name, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name is None:
                    raise ValueError("a line without a file name")
                if name != now:
                    if out:
                        out.close()
                    now = name
                    done.append((name, attempt := uuid.uuid4().hex))
                    old = f"{top}/{name}" if self.existing == "append" and there(system, f"{top}/{name}") else None
                    out = Lines(system, f"{top}/{self.pending}/{attempt}", old, self.threads if name.endswith(".xz") else None, self.level)
                out.write(line)
        if out:
            out.close()
        return Written(done)

    def commit(self, messages) -> None:
        system, top = open_folder(self.folder)
        files = [f for m in messages if m is not None for f in m.files]
        names = [n for n, _ in files]
        try:
            if len(set(names)) < len(names):
                raise ValueError("a file's lines were in several tasks")
            if self.existing == "error" and (old := [n for n in names if there(system, f"{top}/{n}")]):
                raise FileExistsError(f"{old[:5]} in {self.folder}")
            for name, attempt in files:
                if not isinstance(system, fs.LocalFileSystem) and there(system, f"{top}/{name}"):
                    system.delete_file(f"{top}/{name}")  # where a rename does not replace
                system.create_dir(f"{top}/{name}".rpartition("/")[0], recursive=True)
                system.move(f"{top}/{self.pending}/{attempt}", f"{top}/{name}")
        finally:
            self._clear()

    def abort(self, messages) -> None:
        self._clear()

    def _clear(self) -> None:
        system, top = open_folder(self.folder)
        if there(system, f"{top}/{self.pending}"):
            system.delete_dir(f"{top}/{self.pending}")


class FilesSink(DataSource):
    """format("lines"): options path, existing, threads, level."""

    @classmethod
    def name(cls):
        return "lines"

    def writer(self, schema, overwrite):
        return FilesWriter(dict(self.options) | ({"existing": "replace"} if overwrite else {}))


def write_files(df: DataFrame, folder: str, file: Column | str, value: Column | str, order: list[str], existing: str = "error", threads: int = 1, level: int = 6) -> None:
    """The value of each row as a line of its file, in the order of the columns. Names that end in .xz are compressed."""
    df.sparkSession.dataSource.register(FilesSink)
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    rows = df.select(as_column(file).cast("string").alias("_file"), as_column(value).cast("string").alias("_value"), *(F.col(f"`{c}`").alias(f"_o{k}") for k, c in enumerate(order)))
    rows = rows.repartition("_file").sortWithinPartitions("_file", *(f"_o{k}" for k in range(len(order))))
    rows.write.format("lines").mode("append").option("path", folder).option("existing", existing).option("threads", threads).option("level", level).save()
