"""A deadline for each row: a function runs in a child process of the Arrow worker, which is killed when its time is up.

A row that takes too long, raises, or ends the process gives an error beside a null result; the rows after it go on in a new
child. The child starts once for each task, and again only after it was killed. A task that is lost is run again by Spark;
children end with their worker, since their input closes.

Defined results: a null value gives a null result and no error, and is not passed on; an empty table gives no rows; all columns are
kept, so result and error must have other names; rows do not depend on each other unless the function keeps state, which
a killed child loses.
"""

from __future__ import annotations

import contextlib
import os
import pickle
import select
import struct
import subprocess
import sys
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StringType, StructField, StructType

#: Seconds that a child may take to start and to load its function.
STARTUP = 60.0
_SIZE = struct.Struct("<Q")


class TimeUp(Exception):
    """The child has not answered in time."""


class Ended(Exception):
    """The child has ended without an answer."""


def _exactly(stream, n: int) -> bytes:
    """n bytes of a blocking stream, or none at its end."""
    data = stream.read(n)
    return data if len(data) == n else b""


def serve() -> None:
    """What the child does: read a function, then answer each value until the input closes. Prints go to the error output."""
    source, target = sys.stdin.buffer, os.fdopen(os.dup(1), "wb")
    os.dup2(2, 1)

    def read():
        size = _exactly(source, _SIZE.size)
        return pickle.loads(_exactly(source, _SIZE.unpack(size)[0])) if size else None

    def answer(ok: bool, value) -> None:
        try:
            data = pickle.dumps((ok, value))
        except Exception as e:  # a result that cannot be sent is an error of its row
            data = pickle.dumps((False, f"{type(e).__name__}: {e}"))
        target.write(_SIZE.pack(len(data)) + data)
        target.flush()

    make = read()
    if make is None:
        return
    try:
        work = make[0]()
    except Exception as e:
        answer(False, f"{type(e).__name__}: {e}")
        return
    answer(True, None)
    while (asked := read()) is not None:
        try:
            got = True, work(asked[0])
        except Exception as e:
            got = False, f"{type(e).__name__}: {e}"
        answer(*got)


class Child:
    """A process that runs make()'s function."""

    def __init__(self, make: Callable[[], Callable]):
        path = os.pathsep.join(dict.fromkeys([*filter(None, sys.path), *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]))
        self.make = cloudpickle.dumps((make,))
        self.env = os.environ | {"PYTHONPATH": path}
        self.process: subprocess.Popen | None = None

    def start(self) -> None:
        self.process = subprocess.Popen([sys.executable, "-c", "from textmill.functions.deadline import serve; serve()"], stdin=subprocess.PIPE, stdout=subprocess.PIPE, env=self.env)
        self._send(self.make)
        ok, why = self._answer(STARTUP)
        if not ok:
            self.kill()
            raise RuntimeError(why)

    def _send(self, data: bytes) -> None:
        try:
            self.process.stdin.write(_SIZE.pack(len(data)) + data)
            self.process.stdin.flush()
        except BrokenPipeError:
            raise Ended from None

    def _bytes(self, n: int, until: float) -> bytes:
        out, fd = bytearray(), self.process.stdout.fileno()
        while len(out) < n:
            left = until - time.monotonic()
            if left <= 0 or not select.select([fd], [], [], left)[0]:
                raise TimeUp
            part = os.read(fd, min(n - len(out), 1 << 20))
            if not part:
                raise Ended
            out += part
        return bytes(out)

    def _answer(self, seconds: float):
        until = time.monotonic() + seconds
        return pickle.loads(self._bytes(_SIZE.unpack(self._bytes(_SIZE.size, until))[0], until))

    def ask(self, value, seconds: float) -> tuple[object, str | None]:
        """The function's result, or null and what went wrong."""
        if self.process is None:
            self.start()
        try:
            self._send(pickle.dumps((value,)))
            ok, got = self._answer(seconds)
        except TimeUp:
            self.kill()
            return None, f"timeout after {seconds:g} s"
        except Ended:
            code = self.process.wait()
            self.kill()
            return None, f"the process ended with code {code}"
        return (got, None) if ok else (None, got)

    def kill(self) -> None:
        if self.process is not None:
            self.process.kill()
            self.process.wait()
            for stream in (self.process.stdin, self.process.stdout):
                with contextlib.suppress(OSError):
                    stream.close()
            self.process = None


def map_with_deadline(df: DataFrame, column: str, make: Callable[[], Callable], seconds: float, kind: DataType | None = None, result: str = "result", error: str = "error") -> DataFrame:
    """df with the result of make()'s function for each value of a column, and an error text where there is none.

    make runs once in each child, so models are loaded there; it and what it returns must be picklable by cloudpickle.
    """
    kind = kind or StringType()
    arrow, place = to_arrow_type(kind), df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        child = Child(make)
        try:
            for batch in batches:
                got = [(None, None) if v is None else child.ask(v, seconds) for v in batch.column(place).to_pylist()]
                columns = [*batch.columns, pa.array([r for r, _ in got], arrow), pa.array([e for _, e in got], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, result, error])
        finally:
            child.kill()

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(result, kind), StructField(error, StringType())]))
