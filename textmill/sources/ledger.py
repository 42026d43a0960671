"""A ledger of calls: what was asked, when, and how much came back; and the pages that no one has confirmed yet.

log/<day>/<name>.json has one entry for each call that was made, so the calls of a day are the files of a folder; pages/ has the
page that was read behind an offset, until the offset after it is settled. Files get their name when they are whole. One
driver writes a ledger at a time.
"""

from __future__ import annotations

import datetime
import hashlib
import json
import uuid
from collections.abc import Callable

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

LOG = "params_hash string, params string, called timestamp, count long, total_count long"


def params_hash(params: dict) -> str:
    """BLAKE2b (16 bytes, hex) of parameters with sorted keys."""
    return hashlib.blake2b(json.dumps(params, sort_keys=True).encode(), digest_size=16).hexdigest()


class Ledger:
    """Entries below a folder. quota: calls of a day (UTC); now: the clock."""

    def __init__(self, folder: str, quota: int = 1 << 62, now: Callable[[], datetime.datetime] | None = None):
        self.folder, self.quota, self.now = folder, quota, now or (lambda: datetime.datetime.now(datetime.UTC))

    def _open(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.folder) if "://" in self.folder else (fs.LocalFileSystem(), self.folder)

    def _files(self, *parts: str) -> list[fs.FileInfo]:
        system, top = self._open()
        found = system.get_file_info(fs.FileSelector("/".join([top, *parts]), allow_not_found=True))
        return [f for f in found if f.is_file and f.extension == "json"]

    def _write(self, value: dict, *parts: str) -> None:
        system, top = self._open()
        path = "/".join([top, *parts])
        system.create_dir(path.rpartition("/")[0], recursive=True)
        part = f"{path}.{uuid.uuid4().hex}.part"
        with system.open_output_stream(part, compression=None) as out:
            out.write(json.dumps(value, ensure_ascii=False).encode())
        system.move(part, path)

    def _read(self, path: str) -> dict:
        with self._open()[0].open_input_stream(path) as f:
            return json.loads(f.read())

    def _name(self, start: dict) -> str:
        return f"{params_hash(start)}.json"

    def calls_today(self) -> int:
        return len(self._files("log", self.now().date().isoformat()))

    def may_call(self) -> bool:
        return self.calls_today() < self.quota

    def held(self, start: dict) -> dict | None:
        """The page that was read behind start and is not settled: data and end."""
        system, top = self._open()
        path = f"{top}/pages/{self._name(start)}"
        return self._read(path) if system.get_file_info(path).is_file else None

    def enter(self, params: dict, response: dict, start: dict, data: list[dict], end: dict) -> None:
        """A call that was made. Its page is held first: if only that succeeds, the call is read again, not made again."""
        moment = self.now()
        if data:
            self._write({"start": start, "data": data, "end": end}, "pages", self._name(start))
        entry = {"params_hash": params_hash(params), "params": json.dumps(params, sort_keys=True), "called": moment.isoformat(), "count": response["count"], "total_count": response["totalCount"]}
        self._write(entry, "log", moment.date().isoformat(), f"{uuid.uuid4().hex}.json")

    def settle(self, end: dict) -> None:
        """Drop the pages that lead to this offset, one behind the other: they were used."""
        pages = [(f.path, self._read(f.path)) for f in self._files("pages")]
        held = {self._name(page["end"]): (path, page["start"]) for path, page in pages}
        system = self._open()[0]
        while found := held.pop(self._name(end), None):
            system.delete_file(found[0])
            end = found[1]


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    """The calls of all days: params_hash, params, called, count and total_count."""
    return spark.read.schema(LOG).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(f"{folder}/log")
