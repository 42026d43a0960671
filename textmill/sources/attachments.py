"""Attachments: fetching under a rate, and extraction of their texts under a deadline.

Which attachments are fetched is a plan made before (`download_plan`): those without a file of the right length. Fetching and
extraction are functions, so tests and offline use have recorded answers; the library has no reader of PDF files.

Defined results: a row that cannot be fetched or extracted is a row with a status or an error, never a failed task; a null address
has the status `no address`; an empty plan gives no rows. A lost task fetches its rows again.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions.deadline import map_with_deadline
from textmill.operators.corpus import to_extract

#: What an address gives: a status code and bytes.
Fetch = Callable[[str], tuple[int, bytes]]


def http_file(timeout: float = 57.0) -> Fetch:
    """Fetch by HTTP; an error status is an answer."""

    def fetch(url: str) -> tuple[int, bytes]:
        try:
            with urllib.request.urlopen(url, timeout=timeout) as r:  # noqa: S310
                return r.status, r.read()
        except urllib.error.HTTPError as e:
            return e.code, b""

    return fetch


class Bucket:
    """A token bucket: `rate` calls a second, `burst` at once."""

    def __init__(self, rate: float, burst: int = 1, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rate, self.burst, self.clock, self.sleep = rate, burst, clock, sleep
        self.tokens, self.at = float(burst), clock()

    def take(self) -> None:
        """Wait until a call may be made."""
        now = self.clock()
        self.tokens, self.at = min(self.burst, self.tokens + (now - self.at) * self.rate), now
        if self.tokens < 1:
            self.sleep((1 - self.tokens) / self.rate)
            now = self.clock()
            self.tokens, self.at = max(1.0, self.tokens + (now - self.at) * self.rate), now
        self.tokens -= 1


FETCHED = "file_id {key}, status string, length long, content binary"


def fetch_files(plan: DataFrame, make: Callable[[], Fetch] = http_file, rate: float = 0.2, tasks: int = 1) -> DataFrame:
    """file_id, status (`ok`, `404`, another code, or an error), length and content for each row of plan(file_id, url).

    `tasks` tasks share the rate evenly, so all of them together keep to it.
    """
    schema = FETCHED.format(key=plan.schema["file_id"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fetch, bucket = make(), Bucket(rate / tasks)
        for batch in batches:
            for k, url in enumerate(batch.column(1).to_pylist()):  # a file at a time: files are large
                status, data = "no address", None
                if url is not None:
                    bucket.take()
                    try:
                        code, data = fetch(url)
                        status, data = ("ok", data) if code == 200 else (str(code), None)
                    except Exception as e:  # a row of its own, not a failed task
                        status = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1), pa.array([status]), pa.array([None if data is None else len(data)], pa.int64()), pa.array([data], pa.binary())], names=["file_id", "status", "length", "content"])

    return plan.select("file_id", "url").repartition(tasks).mapInArrow(run, schema)


def extract_texts(files: DataFrame, make: Callable[[], Callable[[bytes], list[str]]], texts: DataFrame | None = None, overwrite: bool = False, seconds: float = 30.0) -> DataFrame:
    """stem, text (null where there is an error or nothing in it) and error of files(stem, content) that have no text yet.

    make's function gives the blocks of a file, which newlines join. Each file has `seconds`; its process is killed after them.
    """

    def joined() -> Callable[[bytes], str]:
        blocks = make()
        return lambda content: "\n".join(blocks(content))

    todo = files if texts is None else to_extract(files, texts, overwrite)
    done = map_with_deadline(todo.select("stem", "content"), "content", joined, seconds, result="text")
    return done.select("stem", F.when(F.trim("text") != "", F.col("text")).alias("text"), "error")
