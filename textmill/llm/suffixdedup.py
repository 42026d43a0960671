"""Removal of repeated passages: column-wise construction over many short documents.

Equal strings of `length` bytes have equal k-grams at equal places, so they agree on their anchor: the place of their
least k-gram hash (the leftmost of equals). Every window of a text belongs to an anchor, and consecutive windows with one
anchor form an occurrence; its context is the bytes that its windows cover. Anchors that occur once in the collection
are dropped. Occurrences with equal contexts (compared by digests of 128 bits) are one document from then on: all windows
of a context that occurs again are repeated. Anchors with several different contexts go through the construction, with
contexts as the documents:

All contexts of a task are aligned at their anchors. From the last column to the first, one symbol of each document is
inserted: the order of the suffixes that begin in a column is the stable sort of the order of the column after it by the
symbols before those suffixes (a column of the collection's Burrows-Wheeler transform), and the common prefix of
neighbours is one more than the least among those between them. Only the newest column's suffixes are kept, for equal
windows begin in equal columns. A window is repeated if a neighbour shares `length` symbols. The contexts come from a
written table, group after group; a batch holds at most BATCH documents (or one larger group of at most HOT), so its columns,
order and prefixes stay in memory where the published method has files.

An anchor with over HOT different contexts is too large for a task: its contexts are counted window by window
(map-side combined, dealt by the windows' digests), again exactly.

Rows are numbered in a written table that also has their compressed texts; every later pass reads that table. So rows are
told apart whatever their ids are. Runs of one short pattern give one occurrence for each run, not one for each place, and
spans are united before those of a row are collected: at most one for each two bytes that stay.

Defined results: null and empty texts, and all under `length` bytes, have nothing removed; equal rows, rows with equal
ids and rows without an id are rows of their own, so the texts of equal rows repeat each other; other columns are
ignored by `removal_digests` and kept by `remove_repeats`, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.common import Scratch, give_back, merge_join, numbered, release, text_slices
from textmill.llm.words import mix

LENGTH = 200
GRAM = 32
#: Windows whose anchors are found at once.
SEGMENT = 250_000
BATCH = 16_384
HOT = 2_000
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: A random 64-bit number for each byte.
_BYTE = np.random.default_rng(77).integers(1, 1 << 63, 256, dtype=np.uint64)


@lru_cache(maxsize=2)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Hashes:
    """Polynomial hashes of all substrings of some bytes."""

    def __init__(self, data: np.ndarray):
        size = 1 << max(19, int(len(data)).bit_length())
        self.inverse = _powers(_INVERSE, size)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _powers(_BASE, size)[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])


def occurrences(blob: bytes, first: np.ndarray, last: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of bytes that hold texts at [first, last): text, start, anchor's place, windows after the first, anchor, both halves of the
    context's digest, times, reach.

    Places are counted from the start of data. Neighbouring occurrences with equal contexts are one that occurs `times`,
    the last one `reach` bytes after the first.
    """
    import xxhash

    none = tuple(np.zeros(0, np.int64) for _ in range(9))
    data = np.frombuffer(blob, np.uint8)
    wide = length - gram + 1
    n = len(data) - gram + 1
    count = np.maximum(last - first - length + 1, 0)  # windows of each text
    if not count.sum():
        return none
    hashes = _Hashes(data)
    grams = mix((hashes.sums[gram:] - hashes.sums[:-gram]) * hashes.inverse[:n])
    keyed = grams >> np.uint64(24) << np.uint64(24) | np.arange(n, dtype=np.uint64)
    blocks = -(-n // wide)
    padded = np.full(blocks * wide, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keyed
    table = padded.reshape(blocks, wide)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    text = np.repeat(np.arange(len(first)), count)
    start = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count) + first[text]
    anchor = (np.minimum(behind[start], ahead[start + wide - 1]) & np.uint64((1 << 24) - 1)).astype(np.int64)
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]
    head = np.flatnonzero(new)
    more = np.diff(np.r_[head, len(text)]) - 1
    text, start, anchor = text[head], start[head], anchor[head]
    key = grams[anchor].view(np.int64)
    digest = xxhash.xxh3_128_digest
    context = np.frombuffer(b"".join([digest(blob[a:b]) for a, b in zip(start.tolist(), (start + more + length).tolist(), strict=True)]), np.int64).reshape(-1, 2)
    again = (text[1:] == text[:-1]) & (key[1:] == key[:-1]) & (more[1:] == more[:-1]) & (context[1:] == context[:-1]).all(axis=1)
    head = np.flatnonzero(np.r_[True, ~again])
    times = np.diff(np.r_[head, len(text)])
    reach = start[head + times - 1] - start[head]
    return text[head], start[head], anchor[head], more[head], key[head], context[head, 0], context[head, 1], times, reach


def _segments(texts: list[bytes], length: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, and of each piece in them: text, place in the text, first and last byte. Long texts come in overlapping pieces."""
    held, size = [], 0
    pieces = ((i, a, min(len(t), a + SEGMENT + length - 1)) for i, t in enumerate(texts) for a in range(0, max(len(t) - length + 1, 0), SEGMENT))
    for i, a, b in (*pieces, (-1, 0, 0)):
        if held and (i < 0 or size + b - a > 2 * SEGMENT):
            sizes = np.array([q - p for _, p, q in held])
            last = np.cumsum(sizes)
            yield b"".join(texts[k][p:q] for k, p, q in held), np.array([k for k, _, _ in held]), np.array([p for _, p, _ in held]), last - sizes, last
            held, size = [], 0
        held.append((i, a, b))
        size += b - a


#: A window's places after its anchor, and its bytes beyond a gram, have this many bits.
PLACE_BITS = 10


def _pack(place: np.ndarray, offset: np.ndarray, more: np.ndarray) -> np.ndarray:
    return place << 20 | offset << 10 | more


FOUND = "row long, place long, anchor long, x long, y long, times int, reach int"


def find_occurrences(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """Row, packed place, anchor, context, times and reach of each occurrence in rows(row, n_bytes, packed)."""
    names = [x.split()[0] for x in FOUND.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = _unpacker()
        for batch in text_slices(batches, "n_bytes", SEGMENT):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            texts = [unpack(x) for x in batch.column(2).to_pylist()]
            for blob, owner, at, first, last in _segments(texts, length):
                text, start, anchor, more, key, x, y, times, reach = occurrences(blob, first, last, length, gram)
                if len(text):
                    place = _pack(at[text] + start - first[text], anchor - start, more)
                    cols = (ids[owner[text]], place, key, x, y, times.astype(np.int32), reach.astype(np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names)
        give_back()

    return rows.select("row", "n_bytes", "packed").mapInArrow(run, FOUND)


def columns_repeat(group: np.ndarray, table: np.ndarray, length: int, columns: int) -> np.ndarray:
    """Which windows that begin in the first `columns` columns recur in their group (groups ascend).

    table: a row of symbols for each document, 0 where it has none. Inserts a column of symbols each round.
    """
    n, width = table.shape
    order, lcp = np.arange(n), np.zeros(n + 1, np.int32)  # lcp[i]: of the i-th in order with the one before it
    repeated = np.zeros((n, columns), bool)
    by_column = np.ascontiguousarray(table.T)
    wide = group.astype(np.int64) << 9
    for c in range(width - 1, -1, -1):
        before = by_column[c][order]  # the transform's symbols for the order of the next column
        key = wide[order] + before
        turn = np.argsort(key, kind="stable")
        keys = key[turn]
        left, right = turn[:-1], turn[1:]
        same = (keys[1:] == keys[:-1]) & (before[right] > 0)
        fresh = np.zeros(n + 1, np.int32)
        if len(pairs := np.flatnonzero(same)):
            spans = np.empty(2 * len(pairs), np.int64)
            spans[::2], spans[1::2] = left[pairs] + 1, right[pairs] + 1
            fresh[pairs + 1] = np.minimum(np.minimum.reduceat(lcp, spans)[::2] + 1, length)
        order, lcp = order[turn], fresh
        if c < columns:
            full = lcp == length
            repeated[order, c] = full[:-1] | full[1:]
    return repeated


def _construct(rows: list[tuple], length: int, gram: int) -> Iterator[tuple[int, int, int]]:
    """Repeated spans (row, start, end) of the single contexts among rows (anchor, row, place, single, bytes)."""
    lead = length - gram
    n = len(rows)
    table = np.zeros((n, lead + length), np.uint16)
    packed = np.array([r[2] for r in rows], np.int64)
    start, offset, more = packed >> 20, packed >> 10 & 1023, packed & 1023
    for i, r in enumerate(rows):
        at = lead - int(offset[i])
        table[i, at : at + len(r[4])] = np.frombuffer(r[4], np.uint8)
        table[i, at : at + len(r[4])] += 1
    group = np.cumsum([0, *(a[0] != b[0] for a, b in zip(rows[1:], rows, strict=False))])
    hit = columns_repeat(group, table, length, lead + 1)
    hit[~np.array([r[3] for r in rows], bool)] = False
    edge = np.diff(np.pad(hit.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    which, begin = np.nonzero(edge > 0)
    _, end = np.nonzero(edge < 0)
    base = start - (lead - offset)
    for i, a, b in zip(which.tolist(), begin.tolist(), end.tolist(), strict=True):
        yield rows[i][1], int(base[i]) + a, int(base[i]) + b - 1 + length


SPANS = "row long, start long, end long"


def _spans_batch(spans: list[tuple[int, int, int]]) -> pa.RecordBatch:
    cols = list(zip(*spans, strict=True)) or [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["row", "start", "end"])


def packed_rows(df: DataFrame, scratch: Scratch, text: str = "text") -> DataFrame:
    """df's rows, written once: row (a number), n_bytes, the compressed text as `packed`, and the other columns as c0, c1, ..."""
    import zstandard

    others = [c for c in df.columns if c != text]
    picked = df.select(F.col(f"`{text}`").alias("text"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)))
    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("packed", T.BinaryType()), *picked.schema.fields[1:]]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        packer = zstandard.ZstdCompressor(level=3)
        for batch in text_slices(batches):
            raw = [(x or "").encode() for x in batch.column(0).to_pylist()]
            cols = [pa.array(map(len, raw), pa.int64()), pa.array(map(packer.compress, raw), pa.binary()), *batch.columns[1:]]
            yield pa.RecordBatch.from_arrays(cols, [f.name for f in fields])

    return numbered(picked.mapInArrow(pack, T.StructType(fields)), scratch, "row", codec="snappy")


def _unpacker():
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    return unpack.decompress


def repeated_spans(rows: DataFrame, scratch: Scratch, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """row, start and end of spans of rows(row, n_bytes, packed) whose every window of `length` bytes occurs elsewhere; spans overlap.

    Packed places have PLACE_BITS for a window's distance from its anchor, so windows may be that much longer than a gram: longer ones
    are refused.
    """
    if not 0 <= length - gram < 1 << PLACE_BITS:
        raise ValueError(f"windows must be {gram} to {gram + (1 << PLACE_BITS) - 1} bytes long, not {length}")
    found = scratch.table(find_occurrences(rows, length, gram), "found")
    often = scratch.table(found.groupBy("anchor").agg(F.sum("times").alias("n")).filter("n > 1").select("anchor"), "often")
    hits = scratch.table(merge_join(found, often, "anchor"), "hits")
    scratch.drop("found")
    contexts = hits.groupBy("anchor", "x", "y").agg(F.sum("times").alias("n"), F.min(F.struct("row", "place")).alias("one")).select("anchor", "x", "y", "n", "one.*")
    contexts = scratch.table(contexts, "contexts")
    kinds = scratch.table(contexts.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "kinds")
    whole = contexts.filter("n > 1").select("anchor", "x", "y")
    start = F.shiftright("place", 20)
    spans = merge_join(hits, whole, ["anchor", "x", "y"]).select("row", start.alias("start"), (start + F.col("place").bitwiseAND(1023) + F.col("reach") + length).alias("end"))
    spans = scratch.table(spans, "whole")
    scratch.drop("hits")

    # a row's contexts are no more than its text: one for each `length - gram` bytes or so, runs of a short pattern aside
    asked = merge_join(contexts, kinds, "anchor").groupBy("row").agg(F.collect_list(F.struct("anchor", "place", (F.col("n") == 1).alias("single"), "kinds")).alias("asked"))
    asked = scratch.table(asked, "asked")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, rows = _unpacker(), []
        for batch in batches:
            for key, packed, asked in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = unpack(packed)
                for a in asked:
                    at = a["place"] >> 20
                    rows.append((a["anchor"], key, a["place"], a["single"], data[at : at + (a["place"] & 1023) + length], a["kinds"]))
                if len(rows) >= 8192:
                    yield _cut_batch(rows)
                    rows = []
        if rows:
            yield _cut_batch(rows)

    texts = merge_join(rows, asked, "row").select("row", "packed", "asked")
    pieces = scratch.table(texts.mapInArrow(cut, "anchor long, row long, place long, single boolean, bytes binary, kinds long"), "pieces")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if len(rows) >= BATCH and row[0] != rows[-1][0]:
                    yield _spans_batch(list(_construct(rows, length, gram)))
                    rows = []
                rows.append(row)
        if rows:
            yield _spans_batch(list(_construct(rows, length, gram)))

    few = pieces.filter(F.col("kinds") <= hot).select("anchor", "row", "place", "single", "bytes").repartition("anchor").sortWithinPartitions("anchor")
    spans = spans.union(few.mapInArrow(build, SPANS))
    if pieces.filter(F.col("kinds") > hot).limit(1).count():
        spans = spans.union(_window_counts(pieces.filter(F.col("kinds") > hot), scratch, length))
    return spans


def _cut_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["anchor", "row", "place", "single", "bytes", "kinds"])


def _window_counts(pieces: DataFrame, scratch: Scratch, length: int) -> DataFrame:
    """The spans of anchors with very many contexts: each window of each different context by its bytes' digest."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for anchor, key, place, single, data in zip(*(batch.column(c).to_pylist() for c in ("anchor", "row", "place", "single", "bytes")), strict=True):
                lead = place >> 10 & 1023
                for k in range((place & 1023) + 1):
                    digest = hashlib.blake2b(data[k : k + length], digest_size=16, salt=(lead - k).to_bytes(4, "little")).digest()
                    out.append((anchor, digest, key, (place >> 20) + k, single))
            cols = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["anchor", "digest", "row", "start", "single"])

    every = scratch.table(pieces.mapInArrow(windows, "anchor long, digest binary, row long, start long, single boolean"), "windows")
    again = scratch.table(every.groupBy("anchor", "digest").agg(F.count("*").alias("rows")).filter("rows > 1").select("anchor", "digest"), "again")
    return merge_join(every.filter("single"), again, ["anchor", "digest"], "left_semi").select("row", "start", (F.col("start") + length).alias("end"))


def united(spans: DataFrame) -> DataFrame:
    """row and its maximal runs: the union of the spans (row, start, end), in order."""
    w = W.partitionBy("row").orderBy("start", "end")
    before = F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1))
    runs = spans.withColumn("new", F.coalesce(F.col("start") > before, F.lit(True)).cast("int")).withColumn("run", F.sum("new").over(w))
    runs = runs.groupBy("row", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("runs"))


def _keep(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for r in runs for x in r), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def _finished(df: DataFrame, length: int, text: str, hot: int, work, made: list[T.StructField]) -> DataFrame:
    """The columns of df but the text, and work(bytes, runs) for every row, once the runs are known."""
    scratch = Scratch(df.sparkSession)
    others = [f for f in df.schema.fields if f.name != text]
    rows = packed_rows(df, scratch, text)
    runs = scratch.table(united(repeated_spans(rows.select("row", "n_bytes", "packed"), scratch, length, hot=hot)), "runs")
    scratch.keep("rows", "runs")
    joined = merge_join(rows, runs, "row", "left").select("n_bytes", "packed", "runs", *(f"c{i}" for i in range(len(others))))
    schema = T.StructType([*(T.StructField(f"c{i}", f.dataType) for i, f in enumerate(others)), *made])
    kinds = [pa.int64() if isinstance(f.dataType, T.LongType) else pa.string() for f in made]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = _unpacker()
        for part in text_slices(batches, "n_bytes"):
            done = [work(unpack(p), [(r["start"], r["end"]) for r in s or ()]) for p, s in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)]
            cols = [pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns[3:], *cols], schema.names)

    return joined.mapInArrow(finish, schema).toDF(*(f.name for f in others), *(f.name for f in made))


def _digest(data: bytes, runs: list[tuple[int, int]]) -> tuple[int, int, int, str]:
    return len(data), sum(b - a for a, b in runs), len(runs), hashlib.sha256(_keep(data, runs)).hexdigest()


DIGESTS = [T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType())]


def removal_digests(df: DataFrame, length: int = LENGTH, text: str = "text", key: str = "doc_id", hot: int = HOT) -> DataFrame:
    """key, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    return _finished(df.select(df[key], df[text]), length, text, hot, _digest, DIGESTS)


def remove_repeats(df: DataFrame, length: int = LENGTH, text: str = "text", key: str = "doc_id", hot: int = HOT) -> DataFrame:
    """The rows of df with the repeated passages cut out of their text; half a character at a cut is dropped too, a null text
    is empty afterwards."""
    out = _finished(df, length, text, hot, lambda data, runs: (_keep(data, runs).decode("utf-8", "ignore"),), [T.StructField(text, T.StringType())])
    return out.select(*(F.col(f"`{c}`") for c in df.columns))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
