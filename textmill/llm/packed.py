"""Token ids in files of Simple-8b words.

A 64-bit word holds a 4-bit selector and 60 bits of ids: a selector says how many ids of which width. An id that needs
over 60 bits is an escape: its word holds a place in the file's list of escapes. Ids are packed in blocks of BLOCK; a
block starts a new word, and the footer has each block's first word, so blocks decode alone and a selector's words decode
together in a few array operations.

File: MAGIC, words (little-endian uint64); then the footer: document keys (int64), whether each key is null (uint8),
ids of each document (uint64), first word of each block (uint64), escapes (uint64), the five counts (documents, ids,
blocks, words, escapes) and MAGIC.

Defined results of the table operator: null and empty texts have only the end id; documents are in ascending key order
(null first), rows with equal keys by text; an empty table writes no file and returns no row; other columns are ignored.
"""

from __future__ import annotations

import itertools
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from textmill.llm.common import Cache, Scratch, columns_of, shared, text_slices, uncollected, whole_number_key, word_chunks
from textmill.llm.files import open_input, open_output

_MARKS = ".,;:!?#*$%&"
#: Letters that every version of Unicode has, and a few marks: one pre-token each.
_WORD_AND_MARKS = re.compile(f"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)[{_MARKS}]{{1,4}}")
#: A space byte as the vocabulary writes it.
_SPACE = "\u0120"
MAGIC = b"TMS8B001"
BLOCK = 4096
#: Word chunks whose ids a worker keeps.
CACHED_CHUNKS = 1_200_000
#: Chunks that are encoded as one text, since a longer one takes longer for each, and texts that are encoded at once.
JOINED, TEXTS = 256, 16
#: Blocks that are packed or decoded at once.
GROUP = 256
#: Selector: (ids in a word, bits of each). Selector 0 is a run of zeros, 15 an escape.
SELECTORS = ((240, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60), (1, 0))
ESCAPE = 15
_COUNT = np.array([n for n, _ in SELECTORS], np.int64)


def pack(ids: np.ndarray, escapes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Words of the ids, and each block's first word. Ids of over 60 bits are added to escapes."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    blocks = -(-n // BLOCK)
    table = np.zeros((blocks, BLOCK), np.uint64)
    table.ravel()[:n] = ids
    wide = np.frexp(table.astype(np.float64))[1].astype(np.uint8)  # bits of each id, or one more from 2**53 on
    wide.ravel()[n:] = 255  # no word reaches over the end
    choice = np.full((blocks, BLOCK), ESCAPE, np.int8)
    for s in range(ESCAPE - 1, -1, -1):  # the last that fits, with most ids, stands
        count, bits = SELECTORS[s]
        fits, run = wide <= bits, 1  # places from which `run` ids have at most so many bits
        while run < count:
            if not fits.any():
                break
            step = min(run, count - run)
            fits = fits[:, : fits.shape[1] - step] & fits[:, step:]
            run += step
        if run >= count:
            np.copyto(choice[:, : fits.shape[1]], np.int8(s), where=fits)
    flat, picks = table.ravel(), choice.ravel()
    begins = np.zeros(len(picks), bool)  # places where a word begins
    at = np.arange(blocks, dtype=np.int64) * BLOCK
    ends = np.minimum(at + BLOCK, n)
    while len(at):
        begins[at] = True
        at = at + _COUNT[picks[at]]
        live = at < ends
        if not live.all():
            at, ends = at[live], ends[live]
    place = np.flatnonzero(begins)
    chosen = picks[place].astype(np.int64)
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in range(1, ESCAPE):
        mine = np.flatnonzero(chosen == s)
        count, bits = SELECTORS[s]
        for k in range(count if len(mine) else 0):
            words[mine] |= flat[place[mine] + k] << np.uint64(k * bits)
    for i in np.flatnonzero(chosen == ESCAPE).tolist():
        words[i] |= np.uint64(len(escapes))
        escapes.append(int(flat[place[i]]))
    return words, np.searchsorted(place, np.arange(blocks) * BLOCK)


def unpack(words: np.ndarray, first: np.ndarray, n: int, escapes: np.ndarray) -> np.ndarray:
    """The n ids of whole blocks that begin at the words in first."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = _COUNT[chosen]
    block = np.repeat(np.arange(len(first)), np.diff(first, append=len(words)))
    before = np.cumsum(counts) - counts
    place = block * BLOCK + before - before[first[block]] if len(words) else before
    out = np.zeros(len(first) * BLOCK, np.uint64)
    for s in range(1, ESCAPE):  # zeros are there already
        mine = np.flatnonzero(chosen == s)
        count, bits = SELECTORS[s]
        mask = np.uint64((1 << bits) - 1)
        for k in range(count if len(mine) else 0):
            out[place[mine] + k] = words[mine] >> np.uint64(k * bits) & mask
    mine = np.flatnonzero(chosen == ESCAPE)
    out[place[mine]] = escapes[(words[mine] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return out[:n]


class Writer:
    """Writes one file; holds at most GROUP blocks of ids, and a few numbers for each document and block."""

    def __init__(self, folder: str, stem: str):
        self.address, self.out = open_output(folder, stem, ".s8b")
        self.out.write(MAGIC)
        self.keys: list[int | None] = []
        self.sizes: list[int] = []
        self.first: list[np.ndarray] = []
        self.escapes: list[int] = []
        self.held: list[np.ndarray] = []
        self.n_held = self.n_words = 0

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.sizes.append(len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= GROUP * BLOCK:
            self._flush(self.n_held // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        every = np.concatenate(self.held) if self.held else np.zeros(0, np.uint64)
        for a in range(0, n, GROUP * BLOCK):
            words, first = pack(every[a : min(n, a + GROUP * BLOCK)], self.escapes)
            self.out.write(words.astype("<u8").tobytes())
            self.first.append(first + self.n_words)
            self.n_words += len(words)
        self.held, self.n_held = [every[n:]], len(every) - n

    def close(self) -> tuple[str, int, int]:
        """Address, documents and ids."""
        self._flush(self.n_held)
        first = np.concatenate(self.first) if self.first else np.zeros(0)
        self.out.write(np.array([k or 0 for k in self.keys], "<i8").tobytes() + np.array([k is None for k in self.keys], np.uint8).tobytes())
        self.out.write(np.array(self.sizes, "<u8").tobytes() + first.astype("<u8").tobytes() + np.array(self.escapes, "<u8").tobytes())
        self.out.write(struct.pack("<5Q", len(self.keys), sum(self.sizes), len(first), self.n_words, len(self.escapes)) + MAGIC)
        self.out.close()
        return self.address, len(self.keys), sum(self.sizes)


def read_file(address: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """Key and ids of each document of a file, in its order; decodes GROUP blocks at a time."""
    with open_input(address) as source:
        size = source.size()
        docs, n, blocks, words, escaped = struct.unpack("<5Q", source.read_at(40, size - 48))
        if source.read_at(8, 0) != MAGIC or source.read_at(8, size - 8) != MAGIC:
            raise ValueError(f"{address} is no file of packed ids")
        at = 8 + 8 * words
        keys = np.frombuffer(source.read_at(8 * docs, at), "<i8").tolist()
        null = np.frombuffer(source.read_at(docs, at + 8 * docs), np.uint8).tolist()
        sizes = np.frombuffer(source.read_at(8 * docs, at + 9 * docs), "<u8").astype(np.int64).tolist()
        first = np.frombuffer(source.read_at(8 * blocks, at + 17 * docs), "<u8").astype(np.int64)
        escapes = np.frombuffer(source.read_at(8 * escaped, at + 17 * docs + 8 * blocks), "<u8")
        bounds = [*first.tolist(), words]
        held, have, group = [], 0, 0
        for key, is_null, many in zip(keys, null, sizes, strict=True):
            while have < many:
                a, b = group, min(blocks, group + GROUP)
                data = np.frombuffer(source.read_at(8 * (bounds[b] - bounds[a]), 8 + 8 * bounds[a]), "<u8")
                got = unpack(data, first[a:b] - bounds[a], min(n, b * BLOCK) - a * BLOCK, escapes)
                held.append(got)
                have, group = have + len(got), b
            every = np.concatenate(held) if len(held) != 1 else held[0]
            yield (None if is_null else key), every[:many]
            held, have = [every[many:]], have - many


class CachedTokenizer:
    """The tokenizers library over word chunks: each distinct chunk is encoded once while it is in the cache."""

    def __init__(self, path: str, ordinary: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = ordinary
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that begin with a space
        self.opens[[i for token, i in vocabulary.items() if token.startswith(_SPACE)]] = True
        self.chunks = Cache(CACHED_CHUNKS)
        self.marks: dict[str, bytes] = {}

    def _bytes(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk with a space before it. Many without a space inside are encoded as one text, since no token
        reaches over the start of a chunk; a token that begins with a space then begins a chunk."""
        out: list[bytes] = []
        for first in range(0, len(chunks), JOINED * TEXTS):
            parts = [chunks[at : at + JOINED] for at in range(first, min(first + JOINED * TEXTS, len(chunks)), JOINED)]
            texts = [" " + " ".join(part) for part in parts]
            for part, joined, data in zip(parts, texts, self._bytes(texts), strict=True):
                edges = [*np.flatnonzero(self.opens[np.frombuffer(data, "<u4")]).tolist(), len(data) // 4]
                if joined.count(" ") == len(part) == len(edges) - 1:
                    out += [data[4 * a : 4 * b] for a, b in itertools.pairwise(edges)]
                else:
                    out += self._bytes([f" {c}" for c in part])
        return out

    def _new(self, chunks: list[str]) -> dict[str, bytes]:
        """The ids of chunks that are not in the cache."""
        ending = {c: m[1] for c in chunks if c[-1:] in _MARKS and (m := _WORD_AND_MARKS.fullmatch(c))}  # two pre-tokens: the word's ids are shared
        marks = list({c[len(w) :] for c, w in ending.items()}.difference(self.marks))
        self.marks.update(zip(marks, self._bytes(marks), strict=True))
        plain = [c for c in chunks if c not in ending]
        plain += self.chunks.missing(set(ending.values()).difference(plain), turn=False)
        plain.sort(key=lambda c: " " in c)  # those with spaces are last, so that few are encoded alone
        got = dict(zip(plain, self._chunks(plain), strict=True))
        words = self.chunks.young
        return got | {c: (got[w] if w in got else words[w]) + self.marks[c[len(w) :]] for c, w in ending.items()}

    def encode(self, texts: list[str | None], end: tuple[int, ...] = ()) -> list[np.ndarray]:
        """The ids of each text, then those of end."""
        parts = [word_chunks(x) if x else [""] for x in texts]
        found, last = self.chunks.resolve(parts, self._new), np.array(end, "<u4").tobytes()
        for ids, first in zip(found, self._bytes([p[0] for p in parts]), strict=True):
            ids[0] = first
            ids.append(last)
        return [np.frombuffer(b"".join(ids), "<u4") for ids in found]


def shared_tokenizer(path: str, ordinary: bool) -> CachedTokenizer:
    return shared(("tokenizer", path, ordinary), lambda: CachedTokenizer(path, ordinary))


def write_ids(df: DataFrame, tokenizer: str, end_id: int, scratch: Scratch, ordinary: bool = True, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encode every text, append end_id and write files in ascending key order.

    Returns the committed manifest: part, file, n_docs, n_ids. ordinary: strings of special tokens are plain text. Keys are whole
    numbers, since the files keep them so; others are refused.
    """
    whole_number_key(df, key)
    folder = scratch.path("ids")
    rows = columns_of(df, key, text).toDF("key", "text").withColumn("key", F.col("key").cast("long"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, part = shared_tokenizer(tokenizer, ordinary), None, TaskContext.get().partitionId()
        with uncollected():
            for batch in text_slices(batches):
                writer = writer or Writer(folder, f"part-{part:06d}")
                for k, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist(), (end_id,)), strict=True):
                    writer.add(k, ids)
        if writer:
            address, docs, ids = writer.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "file": [address], "n_docs": [docs], "n_ids": [ids]})

    spread = rows.repartitionByRange("key").sortWithinPartitions("key", "text")
    return scratch.table(spread.mapInArrow(write, "part long, file string, n_docs long, n_ids long"), "manifest")


def read_ids(spark: SparkSession, manifest: DataFrame, key: str = "doc_id") -> DataFrame:
    """From the files: key, start (ids of all documents before it), n_tokens, ids_crc32."""
    start, plan = 0, []
    for r in manifest.orderBy("part").collect():  # one row for each file
        plan.append((r.file, start))
        start += r.n_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for address, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = []
                for k, ids in read_file(address):
                    rows.append((k, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    at += len(ids)
                    if len(rows) == 8192:
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], [key, "start", "n_tokens", "ids_crc32"])
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], [key, "start", "n_tokens", "ids_crc32"])

    return spark.createDataFrame(plan, "file string, at long").mapInArrow(read, StructType([StructField(n, LongType()) for n in (key, "start", "n_tokens", "ids_crc32")]))


def op5_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    manifest = write_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"), P.path("byte_bpe_50k.json"), 2, Scratch(spark))
    return read_ids(spark, manifest)
