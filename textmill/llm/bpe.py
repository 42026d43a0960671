"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token's parts form a linked list of positions. The queue has one bucket for each merge rank, holding list
positions; two levels of bitmaps say which buckets are filled, so the next rank is found by two find-first-set
steps whatever the length. An entry whose pair has changed since is stale and is skipped. A pre-token of n bytes costs
O(n) queue steps, so runs of a million letters are no special case. Many short pre-tokens share one queue: they are one after
another in the list, and no pair reaches over their ends.

Defined results: null text is empty; an empty text has no ids; repeated rows and clashing column names pass through
(only doc_id and text are read); an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import itertools
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from textmill.llm.common import Cache, columns_of, keyed, map_arrow, shared, word_chunks

#: White space as the public splitters mean it; Python's \s has four more characters.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


#: Bytes of pre-tokens that share a queue, unless one alone is longer.
BATCH = 1 << 15
#: Word chunks whose ids a worker keeps, and bytes of text that it splits at once.
CACHED, SLICE = 600_000, 1_000_000
#: Marks that the public splitters part from letters before them, whatever follows.
_MARKS = frozenset(".,;:!?")
ARROW = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file of base64 tokens and numbers."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """findall of a split pattern."""
    import regex

    return regex.compile(pattern.replace(r"[^\s", f"[^{_WHITE}").replace(r"\s", f"[{_WHITE}]").replace(r"\S", f"[^{_WHITE}]")).findall


def merge_all(pieces: list[bytes], ranks: dict[bytes, int], byte_ranks: tuple[list[int | None], list[int | None]] | None = None) -> list[list[int]]:
    """The ids of each pre-token; pre-tokens share a queue up to about BATCH bytes. byte_ranks: byte_tables of the ranks."""
    get, byte_ranks = ranks.get, byte_ranks or byte_tables(ranks)
    out: list[list[int]] = [[]] * len(pieces)
    held: list[int] = []
    size = 0
    for k, piece in enumerate(pieces):
        if (whole := get(piece)) is not None:
            out[k] = [whole]
            continue
        held.append(k)
        size += len(piece)
        if size >= BATCH:
            for i, ids in zip(held, _merge([pieces[i] for i in held], ranks, byte_ranks), strict=True):
                out[i] = ids
            held, size = [], 0
    for i, ids in zip(held, _merge([pieces[i] for i in held], ranks, byte_ranks), strict=True):
        out[i] = ids
    return out


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token."""
    return merge_all([piece], ranks)[0]


def byte_tables(ranks: dict[bytes, int]) -> tuple[list[int | None], list[int | None]]:
    """The rank of each byte, and of each two bytes by their number as 16 bits."""
    return [ranks.get(bytes([b])) for b in range(256)], [ranks.get(n.to_bytes(2)) for n in range(1 << 16)]


def _merge(pieces: list[bytes], ranks: dict[bytes, int], byte_ranks: tuple[list[int | None], list[int | None]]) -> list[list[int]]:
    """The ids of each pre-token, all merged by one queue.

    A part is named by the place of its first byte in the joined pre-tokens; after and before are the linked list, before is -1
    at the start of a pre-token. The queue: buckets[rank] lists places, words[rank >> 8] is the bitmap of filled buckets
    among 256 ranks, top is the bitmap of filled words.
    """
    get, data = ranks.get, b"".join(pieces)
    n = len(data)
    starts = [0, *itertools.accumulate(map(len, pieces))]
    after, before = list(range(1, n + 1)), list(range(-1, n))
    for i in starts:
        before[i] = -1
    single, double = byte_ranks
    token = list(map(single.__getitem__, data))  # the id of the part at a place
    values = np.frombuffer(data, np.uint8).astype(np.int64)
    pair = list(map(double.__getitem__, (values[:-1] << 8 | values[1:]).tolist()))  # the rank of the part there and the next one
    pair.append(None)
    for i in starts[1:]:
        pair[i - 1] = None
    buckets: dict[int, list[int]] = {}
    words: dict[int, int] = {}
    top = 0
    for i, rank in enumerate(pair):
        if rank is not None:
            if rank in buckets:
                buckets[rank].append(i)
            else:
                buckets[rank] = [i]
    for rank in buckets:
        words[rank >> 8] = words.get(rank >> 8, 0) | 1 << (rank & 255)
    for word in words:
        top |= 1 << word
    while top:
        word = (top & -top).bit_length() - 1
        bits = words[word]
        rank = word << 8 | (bits & -bits).bit_length() - 1
        words[word] = bits = bits & bits - 1
        if not bits:
            top ^= 1 << word
        positions = buckets.pop(rank)
        if len(positions) > 1:
            positions.sort()
        pushes, wait = [], 0  # places before `wait` belong to a pre-token in which a lower rank has come up: it goes first
        for i in positions:
            if pair[i] != rank:  # stale
                continue
            if i < wait:
                pushes.append((rank, i))
                continue
            j = after[i]
            after[i] = end = after[j]
            token[i], pair[j], lowest = pair[i], None, rank  # the table's own number, so that caches hold each once
            if before[end] >= 0:
                before[end] = i
                pair[i] = new = get(data[i : after[end]])
                if new is not None:
                    pushes.append((new, i))
                    lowest = new if new < lowest else lowest
            else:
                pair[i] = None
            if (left := before[i]) >= 0:
                pair[left] = new = get(data[left:end])
                if new is not None:
                    pushes.append((new, left))
                    lowest = new if new < lowest else lowest
            if lowest < rank:
                wait = starts[bisect.bisect_right(starts, i)]
        for new, i in pushes:
            if new in buckets:
                buckets[new].append(i)
            else:
                buckets[new] = [i]
                word = new >> 8
                words[word] = words.get(word, 0) | 1 << (new & 255)
                top |= 1 << word
    out = []
    for i, stop in itertools.pairwise(starts):
        ids = []
        while i < stop:
            ids.append(token[i])
            i = after[i]
        out.append(ids)
    return out


class ByteBPE:
    """Encoder and decoder for one file of ranks and one split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.byte_ranks = ranks, byte_tables(ranks)
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, i in ranks.items():
            self.tokens[i] = token
        self.decimals = [str(i) for i in range(len(self.tokens))]
        self.split = splitter(pattern)
        self._pieces, self._chunks = Cache(CACHED // 4), Cache(CACHED)

    def _ids(self, chunks: list[str]) -> dict[str, tuple[int, ...]]:
        """The ids of chunks with a space before them that are not in the cache.

        A chunk of letters is one pre-token, and one mark after letters is another; pre-tokens of a space and letters are
        kept among the chunks, all others apart.
        """
        words = {c for c in chunks if c.isalpha()}
        ending = {c: c[:-1] for c in chunks if c[-1:] in _MARKS and c[:-1].isalpha()}
        rest = [c for c in chunks if c not in words and c not in ending]
        parts = [self.split(f" {c}") for c in rest]
        pieces = {x for p in parts for x in p}
        inner = {x[1:] for x in pieces if x[0] == " " and x[1:].isalpha()}
        new = [*words, *self._chunks.missing((inner | set(ending.values())) - words, turn=False)]
        ids = merge_all([f" {c}".encode() for c in new], self.ranks, self.byte_ranks)
        got = dict(zip(new, map(tuple, ids), strict=True))
        young = self._chunks.young
        known = {f" {x}": (got[x] if x in got else young[x]) for x in inner}
        known |= self._known(pieces.difference(known))
        marks = self._known({c[-1] for c in ending})
        got |= {c: (got[w] if w in got else young[w]) + marks[c[-1]] for c, w in ending.items()}
        got |= {c: tuple(chain.from_iterable(map(known.__getitem__, p))) for c, p in zip(rest, parts, strict=True)}
        return got

    def _known(self, pieces: set[str]) -> dict[str, tuple[int, ...]]:
        """The ids of pre-tokens, which are kept apart from the chunks."""
        new = self._pieces.missing(pieces)
        ids = merge_all([x.encode() for x in new], self.ranks, self.byte_ranks)
        get = self._pieces.lookup(dict(zip(new, map(tuple, ids), strict=True)))
        return {x: get(x) for x in pieces}

    def encode_all(self, texts: list[str | None]) -> list[list[int]]:
        """The ids of each text."""
        parts = [word_chunks(x) if x else [""] for x in texts]
        found = self._chunks.resolve(parts, self._ids)
        firsts = {p[0]: self.split(p[0]) for p in parts}
        known = self._known({x for p in firsts.values() for x in p})
        for ids, p in zip(found, parts, strict=True):
            ids[0] = tuple(chain.from_iterable(map(known.__getitem__, firsts[p[0]])))
        return [list(chain.from_iterable(ids)) for ids in found]

    def encode(self, text: str | None) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def shared_bpe(path: str, pattern: str) -> ByteBPE:
    """One encoder for each Python worker, so that its caches serve all tasks that the worker runs."""
    return shared(("bpe", path, pattern), lambda: ByteBPE(read_ranks(path), pattern))


def encode_table(df: DataFrame, path: str, pattern: str, finish: Callable[[ByteBPE, list[int]], tuple], schema: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key and finish(encoder, ids) for every row; no shuffle, one pass over key and text."""
    names, kinds = zip(*((x.split()[0], ARROW[x.split()[1]]) for x in schema.split(",")), strict=True)

    def make():
        bpe = shared_bpe(path, pattern)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [finish(bpe, ids) for ids in bpe.encode_all(batch.column(1).to_pylist())]
            cols = list(zip(*rows, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], [key, *names])

        return work

    return map_arrow(columns_of(df, key, text), make, keyed(df, key, schema), text, SLICE, keeps=True)


def encode_ids(df: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The ids of every text as an array."""
    return encode_table(df, path, pattern, lambda bpe, ids: (ids,), "ids array<int>", text, key)


def _digest(bpe: ByteBPE, ids: list[int]) -> tuple[int, str, str]:
    return len(ids), hashlib.sha256(" ".join(map(bpe.decimals.__getitem__, ids)).encode()).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest()


def round_trip_digests(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode, decode and digest: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encode_table(df, path, pattern, _digest, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_digests(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and the ids."""
    return encode_table(df, path, pattern, lambda bpe, ids: (*_digest(bpe, ids), ids), "n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return round_trip_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
