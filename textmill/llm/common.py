"""What the training-data operators share: scratch tables, Arrow batches and chunk splitting."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
from collections.abc import Callable, Iterator
from itertools import compress, islice, repeat
from operator import is_

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructField, StructType

from textmill.plans.scratch import Scratch


#: Entries of a cache of word chunks or pre-tokens, so a worker's memory stays bounded.
CACHE_ENTRIES = 700_000
#: Longer chunks are not cached.
LONGEST_CACHED = 64
#: Python code handles at most about this many bytes of text at once (one longer text is handled alone).
SLICE_BYTES = 4_000_000


def free_name(columns: list[str], name: str) -> str:
    """name, with as many marks after it as keep it apart from the columns."""
    while name.lower() in map(str.lower, columns):
        name += "_"
    return name


def keyed(df: DataFrame, key: str, rest: str) -> StructType:
    """The schema of a key column of any name and type, and what else a row has."""
    return StructType([StructField(key, df.schema[key].dataType), *StructType.fromDDL(rest).fields])


def whole_number_key(df: DataFrame, key: str) -> None:
    """Refuse keys that are no whole numbers, where they are ordered and kept as numbers."""
    if not isinstance(df.schema[key].dataType, IntegralType):
        raise TypeError(f"{key} is {df.schema[key].dataType.simpleString()}: keys must be whole numbers")


def columns_of(df: DataFrame, *names: str) -> DataFrame:
    """df's columns of these names, whatever characters they have; the first one gets a name without points, which Arrow functions
    do not take."""
    first, *rest = names
    return df.select(F.col(f"`{first}`").alias(free_name(rest, first.replace(".", "_"))), *(F.col(f"`{n}`") for n in rest))


def numbered(df: DataFrame, scratch: Scratch, name: str, table: str = "rows", codec: str = "zstd") -> DataFrame:
    """df with a number for each row in column `name`; written once, so that every later pass sees the same numbers."""
    return scratch.table(df.withColumn(name, F.monotonically_increasing_id()), table, codec)


def merge_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A sort-merge join: the plan of large tables at every size, whose skewed keys adaptive execution splits."""
    return left.join(right.hint("merge"), on, how)


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut into runs of rows of about `most` bytes of text. column: the text, or a number that says its size."""
    for batch in batches:
        values = batch.column(column)
        lengths = pc.fill_null(values if pa.types.is_integer(values.type) else pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, n in enumerate(lengths.tolist()):
            if total and total + n > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < batch.num_rows:
            yield batch.slice(start)


_HELD: dict[tuple, object] = {}


def shared(key: tuple, make: Callable[[], object]):
    """One object for all tasks of this worker that ask for it; it goes when another one is asked for."""
    if key not in _HELD:
        release()
        _HELD[key] = make()
    return _HELD[key]


def release() -> None:
    """Drop what an earlier stage has left in this worker."""
    if _HELD:
        _HELD.clear()
        give_back()


def give_back() -> None:
    """Return the memory that this worker has freed, so that the next stage's share of the executor is not smaller."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only some C libraries have it
        ctypes.CDLL(None).malloc_trim(0)


@contextlib.contextmanager
def uncollected() -> Iterator[None]:
    """No search for reference cycles: the work makes none, and each search would visit all cached entries."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def map_arrow(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str, column: str = "text", most: int = SLICE_BYTES, keeps: bool = False) -> DataFrame:
    """Run make()'s function over slices of every partition. make runs once for each task, on the executor. keeps: it uses `shared`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            release()
        with uncollected():
            work = make()
            for piece in text_slices(batches, column, most):
                yield work(piece)
        give_back()

    return df.mapInArrow(run, schema)


_SPACE_THEN_SPACE = re.compile(r" \s")
_BEFORE_WORD = re.compile(r" (?=\S)")


def word_chunks(text: str) -> list[str]:
    """Split a text at each space before a non-space; all pieces but the first have lost that space.

    The byte-level split pattern never joins characters across such a place, so pieces can be encoded one by one.
    """
    return _BEFORE_WORD.split(text) if _SPACE_THEN_SPACE.search(text) else text.split(" ")


class Cache:
    """A bounded cache in two generations: what has been used since the last turn survives the next."""

    def __init__(self, entries: int = CACHE_ENTRIES):
        self.half = entries // 2
        self.young: dict = {}
        self.old: dict = {}

    def missing(self, keys: set[str], turn: bool = True) -> list[str]:
        """The keys that are in neither generation; the others are in the young one from now on, up to the next turn."""
        if turn and len(self.young) > self.half:
            self.old, self.young = self.young, {}
        young, old, out = self.young, self.old, []
        for key in keys.difference(young):
            if (value := old.get(key)) is None:
                out.append(key)
            else:
                young[key] = value
        return out

    def resolve(self, lists: list[list[str]], make: Callable[[list[str]], dict]) -> list[list]:
        """The values of all keys but the first of each list, whose place is left to the caller.

        make gives the values of keys that are not held. Long keys are not kept.
        """
        if len(self.young) > self.half:
            self.old, self.young = self.young, {}
        young = self.young
        found = [list(map(young.get, keys)) for keys in lists]
        gaps = [list(compress(range(1, len(values)), map(is_, islice(values, 1, None), repeat(None)))) for values in found]
        new = make(self.missing(set().union(*(map(keys.__getitem__, at) for keys, at in zip(lists, gaps, strict=True))), turn=False))
        if max(map(len, new), default=0) > LONGEST_CACHED:
            young.update((k, v) for k, v in new.items() if len(k) <= LONGEST_CACHED)
        else:
            young.update(new)
        for keys, values, at in zip(lists, found, gaps, strict=True):
            for i in at:
                values[i] = new[key] if (key := keys[i]) in new else young[key]
        return found

    def lookup(self, new: dict):
        """A getter for all keys last asked for, after new has the missing ones; long keys are not kept."""
        if any(len(k) > LONGEST_CACHED for k in new):
            self.young.update((k, v) for k, v in new.items() if len(k) <= LONGEST_CACHED)
            return (self.young | new).__getitem__
        self.young.update(new)
        return self.young.__getitem__
