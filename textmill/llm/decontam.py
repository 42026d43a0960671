"""Benchmark decontamination as a prefix-filtered set join.

Each item gives its windows of `window` consecutive words (an item of fewer words is one window). The corpus counts of
the items' words order each window by rarity; its rarest word is the prefix that any text containing the window must
have too. Texts look up only their prefix words; length and place bounds drop windows that would start before the
text or end after it; what is left is verified word by word.

What is broadcast is the index of one block of items, of at most BLOCK_BYTES of distinct texts and ids (one longer item is
a block by itself). An index takes some 24 bytes for each word and 120 for each different word: about 6 times the text,
30 times at the worst. A larger benchmark gives more blocks: the rows are numbered in a written table, each block's
pass emits the rows that it hits, and the passes are merged by row number. So a row's result depends neither on the number of blocks
nor on other rows with its id. The words are counted in one pass for all blocks.

Defined results: null and empty texts have no words and no hits; an item without words has no window; an item without an
id hits words but is not listed; items with equal ids count once; equal rows, rows with equal ids and rows without an id
each get their own result; an empty benchmark hits nothing; an empty table gives an empty result; other columns are ignored
by `report` and kept by `keep_clean`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm.common import Scratch, free_name, map_arrow, numbered
from textmill.llm.words import word_hashes

WINDOW = 13
BLOCK_BYTES = 8_000_000
#: Candidate places that are verified at once.
CANDIDATES = 500_000
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def item_words(text: str | None) -> list[bytes]:
    """Words: runs of ASCII letters (A-Z folded), digits and all non-ASCII characters."""
    return text.encode().translate(_FOLD).split() if text else []


class Index:
    """The windows of one block of items, keyed by their rarest word.

    Windows are places in the items' words, one after another; equal windows are one.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], counts: dict[bytes, int], window: int = WINDOW):
        self.window = window
        self.ids = {w: i + 1 for i, w in enumerate(dict.fromkeys(w for _, words in items for w in words))}
        rarity = np.array([0, *(counts.get(w, 0) for w in self.ids)], np.int64)
        self.names = sorted({str(i) for i, _ in items if i is not None})
        place = {name: k for k, name in enumerate(self.names)}
        sizes = np.fromiter((len(words) for _, words in items), np.int64, len(items))
        self.flat = np.fromiter((self.ids[w] for _, words in items for w in words), np.int32, int(sizes.sum()))
        self.flat = np.r_[self.flat, np.zeros(window, np.int32)]  # so that every window can be read at full width
        many = np.where(sizes > 0, np.maximum(sizes - window + 1, 1), 0)
        item = np.repeat(np.arange(len(items)), many)
        start = np.arange(len(item)) - np.repeat(np.cumsum(many) - many, many) + (np.cumsum(sizes) - sizes)[item]
        length = np.minimum(sizes[item], window)
        digest = length.astype(np.uint64)
        for k in range(window):
            digest = digest * np.uint64(0x9E3779B97F4A7C15) + np.where(k < length, self.flat[start + k], 0).astype(np.uint64)
        order = np.argsort(digest, kind="stable")
        same = length[order[1:]] == length[order[:-1]]
        for k in range(window):
            same &= (k >= length[order[1:]]) | (self.flat[start[order[1:]] + k] == self.flat[start[order[:-1]] + k])
        group = np.cumsum(np.r_[False, ~same][: len(order)])
        first = order[np.flatnonzero(np.r_[True, ~same][: len(order)])]
        self.start, self.lengths = start[first].astype(np.int32), length[first].astype(np.int32)
        owner = np.array([-1 if name is None else place[str(name)] for name, _ in items], np.int64)[item[order]] if len(items) else group
        pairs = np.unique(np.stack([group, owner])[:, owner >= 0], axis=1)
        self.owner = pairs[1].astype(np.int32)
        self.owned = np.searchsorted(pairs[0], np.arange(len(first) + 1)).astype(np.int32)
        self.offset, least = np.zeros(len(first), np.int32), np.full(len(first), np.iinfo(np.int64).max)
        for k in range(window):
            here = np.where(k < self.lengths, rarity[self.flat[self.start + k]], np.iinfo(np.int64).max)
            self.offset[here < least] = k
            least = np.minimum(least, here)
        prefix = self.flat[self.start + self.offset]
        self.by_prefix = np.argsort(prefix, kind="stable").astype(np.int32)  # windows, grouped by prefix word
        self.first = np.searchsorted(prefix[self.by_prefix], np.arange(len(self.ids) + 2)).astype(np.int32)

    def owners(self, window: int) -> list[int]:
        """Which names' items hold a window."""
        return self.owner[self.owned[window] : self.owned[window + 1]].tolist()

    def hits(self, words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of every occurrence, for word numbers (0: in no item) and their documents."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        places = np.flatnonzero(words)
        lists = self.first[words[places] + 1] - self.first[words[places]]
        places, lists = places[lists > 0], lists[lists > 0]
        cuts = np.searchsorted(np.cumsum(lists), np.arange(0, int(lists.sum()) + CANDIDATES, CANDIDATES), side="right")
        for a, b in zip(cuts, [*cuts[1:], len(lists)], strict=True):
            if a == b:
                continue
            at, many = places[a:b], lists[a:b]
            run = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
            window = self.by_prefix[np.repeat(self.first[words[at]], many) + run]
            start = np.repeat(at, many) - self.offset[window]
            length = self.lengths[window]
            keep = (start >= 0) & (start + length <= len(words))
            window, start, length = window[keep], start[keep], length[keep]
            keep = doc[start] == doc[start + length - 1]
            window, start, length = window[keep], start[keep], length[keep]
            for k in range(self.window):
                keep = (length <= k) | (words[np.minimum(start + k, len(words) - 1)] == self.flat[self.start[window] + k])
                window, start, length = window[keep], start[keep], length[keep]
            found.append((window, start))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])


def _slice_hits(index: Index, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[set[int]]]:
    """For each text: words; then hit words; the mask of all words; the items."""
    lists = [item_words(x) for x in texts]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    get = index.ids.get
    words = np.fromiter((get(w, 0) for one in lists for w in one), np.int64, int(sizes.sum()))
    doc = np.repeat(np.arange(len(lists)), sizes)
    window, start = index.hits(words, doc)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + index.lengths[window], -1)
    mask = np.cumsum(edge[:-1]) > 0
    items: list[set[int]] = [set() for _ in lists]
    pairs = np.unique(np.stack([doc[start], window]), axis=1) if len(start) else np.zeros((2, 0), np.int64)
    for d, w in pairs.T.tolist():
        items[d].update(index.owners(w))
    return sizes, np.bincount(doc[mask], minlength=len(lists)), mask, items


def _row(names: list[str]) -> tuple[int, str]:
    return len(names), hashlib.sha256(",".join(names).encode()).hexdigest()


RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _report(batch: pa.RecordBatch, index: Index, texts: list[str | None]) -> list[pa.Array]:
    n_words, n_hit, _, items = _slice_hits(index, texts)
    rows = [_row(sorted(index.names[i] for i in x)) for x in items]
    return [pa.array(n_words), pa.array(n_hit), pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.string()), pa.array((n_hit > 0) & (20 * n_hit >= n_words))]


def word_counts(docs: DataFrame, text: str, known: np.ndarray | None) -> DataFrame:
    """w (a word's hash) and n, how often it occurs in all texts; of the known hashes (ascending) only, if given."""
    shared = None if known is None else docs.sparkSession.sparkContext.broadcast(known)

    def make():
        wanted = None if shared is None else shared.value

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            values, _ = word_hashes(batch.column(0).to_pylist(), _FOLD)
            if wanted is not None:
                values = values[wanted[np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)] == values] if len(wanted) else values[:0]
            values, n = np.unique(values, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n, pa.int64())], ["w", "n"])

        return work

    return map_arrow(docs.select(text), make, "w long, n long", text).groupBy("w").agg(F.sum("n").alias("n"))


def blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> list[DataFrame]:
    """The distinct texts (text, items: the ids that have it), dealt by a hash into blocks of at most block_bytes, or of one text."""
    texts = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).filter("text is not null").groupBy("text").agg(F.collect_set("item").alias("items"))
    spot, size = F.xxhash64("text"), F.octet_length("text") + F.octet_length(F.array_join("items", ","))
    total, n = texts.agg(F.sum(size).alias("n")).first().n or 0, 1
    while n == 1 and total > block_bytes or n > 1 and texts.groupBy(F.pmod(spot, F.lit(n))).agg(F.sum(size).alias("n"), F.count("*").alias("rows")).filter((F.col("n") > block_bytes) & (F.col("rows") > 1)).limit(1).count():
        n = n * 2 if n > 1 else -(-3 * total // (2 * block_bytes))
    return [texts.filter(F.pmod(spot, F.lit(n)) == b) for b in range(n)]


def _items(block: DataFrame) -> list[tuple[str | None, list[bytes]]]:
    """Name and words of each item of a block (at most BLOCK_BYTES of text, or one item)."""
    return [(name, words) for r in block.collect() for words in [item_words(r.text)] for name in r["items"] or [None]]


def _indexes(docs: DataFrame, parts: list[DataFrame], scratch: Scratch, window: int, text: str):
    """The index of each block, broadcast when its turn comes; the texts' words are counted in one pass before."""
    spark, counted = docs.sparkSession, None
    if len(parts) > 1:
        counted = scratch.table(word_counts(docs, text, None), "counts")
    for part in parts:
        items = _items(part)
        vocabulary = list(dict.fromkeys(w for _, words in items for w in words))
        hashes = word_hashes([w.decode() for w in vocabulary], _FOLD)[0] if vocabulary else np.zeros(0, np.uint64)
        if counted is None:
            found = word_counts(docs, text, np.unique(hashes))
        else:
            wanted = spark.createDataFrame(pa.table({"w": np.unique(hashes).view(np.int64)}))
            found = counted.join(F.broadcast(wanted), "w", "left_semi")  # the words of one block
        counts = {r.w: r.n for r in found.collect()}  # at most one row for each word of the block
        yield spark.sparkContext.broadcast(Index(items, {w: counts.get(h, 0) for w, h in zip(vocabulary, hashes.view(np.int64).tolist(), strict=True)}, window))


def _pass(docs: DataFrame, index, schema, finish: Callable, text: str) -> DataFrame:
    place = docs.columns.index(text)

    def make():
        known = index.value
        return lambda batch: finish(batch, known, batch.column(place).to_pylist())

    return map_arrow(docs, make, schema, text)


def _merged(rows: DataFrame, parts: list[DataFrame], scratch: Scratch, window: int, text: str, row: str) -> DataFrame:
    """row, n_words, n_hit, items and contaminated of the numbered rows, a pass for each block; rows without a hit come once."""

    def hits(first: bool):
        def finish(batch: pa.RecordBatch, index: Index, texts: list[str | None]) -> pa.RecordBatch:
            sizes, _, mask, items = _slice_hits(index, texts)
            ends = np.cumsum(sizes)
            hit = [np.flatnonzero(mask[e - n : e]).astype(np.int32) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
            named = [[index.names[i] for i in x] for x in items]
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(hit, pa.list_(pa.int32())), pa.array(named, pa.list_(pa.string()))], ["row", "n_words", "hit", "items"])
            return out if first else out.filter(pa.array([len(x) > 0 for x in hit], pa.bool_()))

        return finish

    texts = rows.select(F.col(row).alias("row"), F.col(text).alias("text"))
    every = None
    for i, index in enumerate(_indexes(texts, parts, scratch, window, "text")):
        one = scratch.table(_pass(texts, index, "row long, n_words long, hit array<int>, items array<string>", hits(not i), "text"), f"block{i}")
        index.unpersist()
        every = one if every is None else every.unionByName(one)
    merged = every.groupBy("row").agg(
        F.max("n_words").alias("n_words"),
        F.size(F.array_distinct(F.flatten(F.collect_list("hit")))).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return merged.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", key: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """key, n_words, n_hit, n_items, items_sha256 and contaminated for every row of docs."""
    docs = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    scratch = Scratch(docs.sparkSession)
    parts = blocks(benchmark, block_bytes=block_bytes)
    if len(parts) == 1:
        names = ["key", *(x.split()[0] for x in RESULT.split(", "))]
        index = next(_indexes(docs, parts, scratch, window, "text"))
        schema = f"key {docs.schema['key'].dataType.simpleString()}, {RESULT}"
        return _pass(docs, index, schema, lambda batch, known, texts: pa.RecordBatch.from_arrays([batch.column(0), *_report(batch, known, texts)], names), "text").withColumnRenamed("key", key)
    rows = numbered(docs, scratch, "row")
    merged = _merged(rows, parts, scratch, window, "text", "row")
    out = rows.select("row", F.col("key").alias(key)).join(merged, "row")
    return out.select(key, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", key: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs that are not contaminated, with all their columns; each row is judged by its own text, whatever its id."""
    scratch = Scratch(docs.sparkSession)
    parts = blocks(benchmark, block_bytes=block_bytes)
    if len(parts) == 1:
        index = next(_indexes(docs.select(text), parts, scratch, window, text))
        return _pass(docs, index, docs.schema, lambda batch, known, texts: batch.filter(pc.invert(_report(batch, known, texts)[4])), text)
    row = free_name(docs.columns, "row")
    rows = numbered(docs, scratch, row)
    bad = _merged(rows, parts, scratch, window, text, row).filter("contaminated").select(F.col("row").alias(row))
    return rows.join(bad, row, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
