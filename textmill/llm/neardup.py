"""MinHash near-duplicates with tensored banding.

Two small collections of `groups` keys, each key made of `width` minhashes, are combined pairwise: a text has groups**2
table keys for 2 * groups * width minhashes. `layout` derives both from the similarity asked for, so that a pair at the threshold
shares no table with probability 1e-4 at most (at 85: 8 + 8 keys of 2 minhashes, 64 tables, 7e-5). Texts with equal sets are one node
from the start, so copies cost nothing further.

Of the nodes only those matter that share a key of the first collection with another. Candidates come in rounds, and a
bucket never emits all its pairs:
1. every member of a bucket with the bucket's smallest member (its pivot); links are united to classes;
2. the members of buckets that still hold several classes are open. They are bucketed once more, by exact keys: the prefix of a set
   in order of rarity among the open sets (sets that are similar enough share a token of their prefixes). Each token has a
   pivot of its own, drawn by a hash; members of other classes are candidates with it if sizes and places allow the
   similarity, each with up to BEST pivots; classes are united again. This is repeated with new pivots for as long as it
   halves the number of classes, so a large family of near copies becomes one class by a few links for each member;
3. what is still open: all pairs of different classes that share a prefix token and whose sizes and places in both orders allow
   the similarity. Members that have a template in common but not enough else have their own words first, so the places rule
   their pairs out. Tokens with over BLOCK members are dealt in pairs of blocks, whose rows are five numbers.
A candidate with a pivot of which fewer minhashes agree than the threshold lets expect (probability 1e-6) is dropped; all others
are verified on the full sets of 64-bit shingle hashes, made from the compressed texts where they are compared: a pivot's text is
sent once to each HUB of its members; the pairs of round 3 are dealt into cells, a block of texts against another, and a text is
sent once to each cell that has a pair of it. Components are found by a distributed min-label iteration.

Defined results: a text without words, or null, has no shingles and is linked with nothing; equal rows share a component;
rows with one id and different texts are compared apart; a row without an id is compared like all others, and its
component_id is the smallest id in its component, or null if that has none; kept is true if doc_id and component_id are equal
or both null; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.llm.common import Scratch, free_name, map_arrow, merge_join, numbered, text_slices, whole_number_key
from textmill.llm.components import components
from textmill.llm.words import shingles

SHINGLE = 5
PERCENT = 85
#: Members of a token's block in round 3.
BLOCK = 512
#: Members of a pivot that are compared in one place.
HUB = 512
#: Up to this many nodes are broadcast to pick their texts (some 40 bytes each); more are joined by shuffle.
BROADCAST_IDS = 500_000
#: Pivots of each member in one turn of round 2.
BEST = 16
#: Slots of the token counts that order the prefixes. Any order is exact; rarer tokens first give fewer candidates.
SLOTS = 1 << 20
#: Bytes of text whose sets are made at once.
COMPARED = 1_000_000
SIGNATURE = "n long, digest binary, a array<bigint>, b array<bigint>, sketch binary"


@dataclass(frozen=True)
class Layout:
    """groups keys of width minhashes in each collection; of all minhashes at least `agree` agree in a candidate."""

    width: int
    groups: int
    agree: int

    @property
    def minhashes(self) -> int:
        return 2 * self.groups * self.width

    def multipliers(self) -> tuple[np.ndarray, np.ndarray]:
        """Fixed odd multipliers, and offsets, of the minhashes."""
        rng = np.random.default_rng(20)
        return rng.integers(0, 1 << 63, self.minhashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, self.minhashes, dtype=np.uint64)


@lru_cache
def layout(percent: int) -> Layout:
    """The tables for a similarity of percent / 100: misses with probability 1e-4 at most, too few agreeing minhashes with 1e-6."""
    if not 0 < percent <= 100:
        raise ValueError("percent must be in 1 .. 100")
    s, width, groups = percent / 100, 2 if percent >= 70 else 1, 1
    while 1 - (1 - (1 - s**width) ** groups) ** 2 > 1e-4:
        groups += 1
    n, agree, below = 2 * groups * width, 0, 0.0
    while (below := below + math.comb(n, agree) * s**agree * (1 - s) ** (n - agree)) <= 1e-6:
        agree += 1
    return Layout(width, groups, agree)


def minhashes(values: np.ndarray, counts: np.ndarray, plan: Layout) -> np.ndarray:
    """A row of minhashes for each text with shingles."""
    full = np.flatnonzero(counts)
    starts = (np.cumsum(counts) - counts)[full]
    out = np.empty((plan.minhashes, len(full)), np.uint64)
    for k, (m, a) in enumerate(zip(*plan.multipliers(), strict=True)):
        x = values * m + a
        out[k] = np.minimum.reduceat(x ^ x >> np.uint64(29), starts) if len(full) else 0
    return out


def group_keys(low: np.ndarray, plan: Layout) -> np.ndarray:
    """The keys of both collections, a row for each group of minhashes."""
    keys = np.zeros((2 * plan.groups, low.shape[1]), np.uint64)
    for g in range(2 * plan.groups):
        keys[g] = g
        for w in range(plan.width):
            keys[g] = (keys[g] ^ low[g * plan.width + w]) * np.uint64(0xFF51AFD7ED558CCD)
            keys[g] ^= keys[g] >> np.uint64(32)
    return keys


def _cells(values: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Each text's own values."""
    return np.split(values, np.cumsum(counts)[:-1]) if len(counts) else []


def set_digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _rows_of(df: DataFrame, text: str, key: str) -> DataFrame:
    """id, place (an id that can be joined) and text."""
    whole_number_key(df, key)
    id_, value = F.col(f"`{key}`").cast("long"), F.col(f"`{text}`")
    return df.select(id_.alias("id"), F.coalesce(id_, F.xxhash64(value)).alias("place"), value.alias("text"))


def signatures(rows: DataFrame, size: int, plan: Layout) -> DataFrame:
    """id, place, number of shingles, digest of the set (null without shingles), the two collections of keys, and a byte of each minhash."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            values, counts = shingles(batch.column(2).to_pylist(), size)
            digest = [set_digest(x) if len(x) else None for x in _cells(values, counts)]
            low = minhashes(values, counts, plan)
            keys = iter(group_keys(low, plan).view(np.int64).T.tolist())
            bytes_ = iter([x.tobytes() for x in np.ascontiguousarray(low.T).astype(np.uint8)])
            signed = [(next(keys), next(bytes_)) if n else (None, None) for n in counts.tolist()]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(counts, pa.int64()),
                    pa.array(digest, pa.binary()),
                    pa.array([x and x[: plan.groups] for x, _ in signed], pa.list_(pa.int64())),
                    pa.array([x and x[plan.groups :] for x, _ in signed], pa.list_(pa.int64())),
                    pa.array([s for _, s in signed], pa.binary()),
                ],
                ["id", "place", "n", "digest", "a", "b", "sketch"],
            )

        return work

    return map_arrow(rows, make, f"id long, place long, {SIGNATURE}")


def _packed(rows: DataFrame) -> DataFrame:
    """place, n_bytes and the compressed text."""
    import zstandard

    def make():
        packer = zstandard.ZstdCompressor(level=3)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            raw = [(x or "").encode() for x in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, raw), pa.int64()), pa.array(map(packer.compress, raw), pa.binary()), *batch.columns[2:]], ["place", "n_bytes", "packed", *batch.schema.names[2:]])

        return work

    extra = "".join(f", {f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[2:])
    return map_arrow(rows, make, f"place long, n_bytes long, packed binary{extra}")


def _unpacker():
    import zstandard

    return zstandard.ZstdDecompressor().decompress


def picked_texts(rows: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """node, n_bytes, packed: the text of each of wanted(place, node, digest). Of texts at one place the digest picks the right one."""
    if wanted.count() <= BROADCAST_IDS:
        found = _packed(rows.select("place", "text").join(F.broadcast(wanted), "place"))
    else:
        found = merge_join(_packed(rows.select("place", "text")), wanted, "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = _unpacker()
        for part in text_slices(batches, "n_bytes", COMPARED):
            values, counts = shingles([unpack(x) for x in part.column(1).to_pylist()], size)
            same = [len(x) > 0 and set_digest(x) == d for x, d in zip(_cells(values, counts), part.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(2), part.column(0), part.column(1)], ["node", "n_bytes", "packed"]).filter(pa.array(same, pa.bool_()))

    found = found.select("n_bytes", "packed", "node", "digest").mapInArrow(run, "node long, n_bytes long, packed binary")
    return found.groupBy("node").agg(F.first("n_bytes").alias("n_bytes"), F.first("packed").alias("packed"))


def _close(pairs: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v, parts) whose sizes and minhashes allow the similarity."""
    plan = layout(percent)
    pairs = merge_join(merge_join(pairs, facts.toDF("u", "nu", "su"), "u"), facts.toDF("v", "nv", "sv"), "v")
    alike = F.lit(0)
    for k in range(plan.minhashes):
        alike = alike + (F.substring("su", k + 1, 1) == F.substring("sv", k + 1, 1)).cast("int")
    return pairs.filter((100 * F.least("nu", "nv") >= percent * F.greatest("nu", "nv")) & (alike >= plan.agree)).select("u", "v", "parts")


def _verify(pairs: DataFrame, texts: DataFrame, scratch: Scratch, name: str, percent: int, size: int) -> DataFrame:
    """The pairs (u, v, parts) whose full sets are similar enough. The text of v is sent once to each of the parts of its partners."""
    dealt = pairs.select("v", F.pmod(F.xxhash64("u"), F.col("parts")).cast("int").alias("part"), "u")
    members = merge_join(dealt, texts.withColumnRenamed("node", "u"), "u").select("v", "part", "u", "n_bytes", "packed")
    pivots = merge_join(dealt.select("v", "part").distinct(), texts.withColumnRenamed("node", "v"), "v").select("v", "part", F.lit(None).cast("long").alias("u"), "n_bytes", "packed")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, pivot = _unpacker(), np.zeros(0, np.uint64)
        for part in text_slices(batches, "n_bytes", COMPARED):
            found = []
            values, counts = shingles([unpack(x) for x in part.column(4).to_pylist()], size)
            for v, u, own in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), _cells(values, counts), strict=True):
                if u is None:  # its members follow
                    pivot = own
                    continue
                both = np.count_nonzero(pivot[np.minimum(np.searchsorted(pivot, own), len(pivot) - 1)] == own)
                if 100 * both >= percent * (len(pivot) + len(own) - both):
                    found.append((u, v))
            if found:
                yield pa.RecordBatch.from_pydict({"u": [u for u, _ in found], "v": [v for _, v in found]})

    spread = members.union(pivots).repartition("v", "part").sortWithinPartitions("v", "part", F.col("u").asc_nulls_first())
    return scratch.table(spread.mapInArrow(compare, "u long, v long"), f"{name}-links")


def _verify_cells(pairs: DataFrame, texts: DataFrame, scratch: Scratch, name: str, percent: int, size: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough. Blocks hold about COMPARED bytes of the texts that have pairs."""
    used = merge_join(pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct(), texts.select("node", "n_bytes"), "node")
    blocks = max(1, -(-(used.agg(F.sum("n_bytes").alias("n")).first().n or 0) // COMPARED))
    cell = [F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int").alias(b) for c, b in (("u", "i"), ("v", "j"))]
    dealt = scratch.table(pairs.select(*cell, "u", "v"), f"{name}-dealt")
    needed = dealt.select("i", "j", F.col("u").alias("node")).union(dealt.select("i", "j", "v")).distinct()
    sets = merge_join(needed, texts, "node").select("i", "j", F.col("node").alias("u"), F.lit(None).cast("long").alias("v"), "n_bytes", "packed")
    asked = dealt.select("i", "j", "u", "v", F.lit(16).cast("long").alias("n_bytes"), F.lit(None).cast("binary").alias("packed"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, now, known = _unpacker(), None, {}
        for part in text_slices(batches, "n_bytes", COMPARED):
            found, rows = [], list(zip(*(part.column(c).to_pylist() for c in range(4)), strict=True))
            given = [k for k, r in enumerate(rows) if r[3] is None]
            made = dict(zip(given, _cells(*shingles([unpack(part.column(5)[k].as_py()) for k in given], size)), strict=True))
            for k, (i, j, u, v) in enumerate(rows):
                if (i, j) != now:
                    now, known = (i, j), {}
                if v is None:  # a cell's texts come before its pairs
                    known[u] = made[k]
                    continue
                a, b = known[u], known[v]
                both = np.count_nonzero(a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    found.append((u, v))
            if found:
                yield pa.RecordBatch.from_pydict({"u": [u for u, _ in found], "v": [v for _, v in found]})

    spread = sets.union(asked).repartition("i", "j").sortWithinPartitions("i", "j", F.col("v").asc_nulls_first())
    return scratch.table(spread.mapInArrow(compare, "u long, v long"), f"{name}-links")


def _open(keys: DataFrame, labels: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """node and class of the members of buckets with several classes; a bucket of two has been decided by its pivot."""
    classes = merge_join(keys, labels.toDF("node", "class"), "node", "left").select("key", "node", F.coalesce("class", "node").alias("class"))
    classes = scratch.table(classes, f"{name}-classes")
    several = classes.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count("*").alias("rows")).filter("low <> high and rows > 2").select("key")
    return scratch.table(merge_join(classes, several, "key").select("node", "class").distinct(), f"{name}-open")


def slot(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def prefix(values: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The tokens of a set that a similar enough set shares at least one of: the rarest, in order (ties by token)."""
    order = np.lexsort((values, counts[slot(values)]))
    return values[order[: len(values) - -(-percent * len(values) // 100) + 1]]


def _prefixes(opened: DataFrame, texts: DataFrame, scratch: Scratch, name: str, percent: int, size: int) -> DataFrame:
    """token, node, class, n and place of each token in the prefix of each open set."""
    found = scratch.table(merge_join(texts, opened, "node"), f"{name}-texts")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = _unpacker()
        for part in text_slices(batches, "n_bytes", COMPARED):
            values, _ = shingles([unpack(x) for x in part.column(1).to_pylist()], size)
            at, n = np.unique(slot(values), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n.astype(np.int64))], ["slot", "n"])

    got = found.select("n_bytes", "packed").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # at most SLOTS rows
    table = np.zeros(SLOTS, np.int64)
    table[got["slot"].to_numpy()] = got["n"].to_numpy()
    shared = opened.sparkSession.sparkContext.broadcast(np.minimum(table, (1 << 32) - 1).astype(np.uint32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, counts = _unpacker(), shared.value
        for part in text_slices(batches, "n_bytes", COMPARED):
            sets = _cells(*shingles([unpack(x) for x in part.column(1).to_pylist()], size))
            first = [prefix(x, counts, percent) for x in sets]
            many = np.array([len(x) for x in first])
            own = [np.repeat(part.column(c).to_numpy(), many) for c in (2, 3)]
            n = np.repeat(np.array([len(x) for x in sets], np.int32), many)
            place = np.concatenate([np.arange(m, dtype=np.int32) for m in many])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.concatenate(first).view(np.int64), *own, n, place)], ["token", "node", "class", "n", "at"])

    return scratch.table(found.select("n_bytes", "packed", "node", "class").mapInArrow(run, "token long, node long, class long, n int, at int"), f"{name}-prefixes")


def _fits(nu, nv, iu, iv, percent: int, least=F.least, greatest=F.greatest) -> Column:
    """Whether sets of these sizes can be similar enough if the first token that they share is at these places (from 0)."""
    return (100 * least(nu, nv) >= percent * greatest(nu, nv)) & ((100 + percent) * (1 + least(nu - iu - 1, nv - iv - 1)) >= percent * (nu + nv))


def _parts(rows: Column) -> Column:
    return F.ceil(rows / HUB).cast("int").alias("parts")


def _best(prefixes: DataFrame, scratch: Scratch, name: str, percent: int, turn: int) -> DataFrame:
    """Round 2: each node with up to BEST pivots of other classes among those of its tokens."""
    draw = F.struct(F.xxhash64(F.lit(turn), "token", "node"), "node", "class", "n", "at")
    pivots = prefixes.groupBy("token").agg(F.min(draw).alias("p"), F.min("class").alias("low"), F.max("class").alias("high"), _parts(F.count("*"))).filter("low <> high")
    met = merge_join(prefixes, pivots.select("token", "p", "parts"), "token").filter((F.col("class") != F.col("p.class")) & _fits(F.col("n"), F.col("p.n"), F.col("at"), F.col("p.at"), percent))
    met = met.groupBy(F.col("node").alias("u"), F.col("p.node").alias("v")).agg(F.max("parts").alias("parts"))
    place = F.row_number().over(W.partitionBy("u").orderBy(F.xxhash64(F.lit(turn), "u", "v"), "v"))
    return scratch.table(met.withColumn("k", place).filter(F.col("k") <= BEST).select("u", "v", "parts"), f"{name}-met")


def _rest(prefixes: DataFrame, scratch: Scratch, name: str, percent: int) -> DataFrame:
    """Round 3: all pairs of different classes that share a prefix token and can be similar enough."""
    stats = prefixes.groupBy("token").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")).filter("low <> high")
    rows = merge_join(prefixes, stats.select("token", "parts"), "token")
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "class", "n", "at")

    def pairs(own: np.ndarray, i: int, j: int, node: np.ndarray, kind: np.ndarray, n: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
        a, b = np.flatnonzero(own == i), np.flatnonzero(own == j)
        for cut in range(0, len(a), 256):
            x, y = a[cut : cut + 256, None], b[None, :]
            ok = _fits(n[x], n[y], at[x], at[y], percent, np.minimum, np.maximum) & (kind[x] != kind[y])
            if i == j:
                ok &= x < y
            u, v = np.nonzero(ok)
            if len(u):
                u, v = node[a[cut + u]], node[b[v]]
                yield np.unique(np.stack([np.maximum(u, v), np.minimum(u, v)]), axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # the rows of the group that goes on; a group has at most 2 * BLOCK or so
        for batch in (*batches, None):
            if batch is not None:
                held.append(np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(8)]))
            rows = np.concatenate(held, axis=1) if held else np.zeros((8, 0), np.int64)
            new = np.flatnonzero(np.r_[True, (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)]) if rows.shape[1] else np.zeros(0, int)
            ends = [*new[1:].tolist(), rows.shape[1]]
            last = len(new) - (batch is not None)  # the last group may go on in the next batch
            out = [p for s, e in zip(new[:last].tolist(), ends, strict=False) if e - s > 1 for p in pairs(rows[3, s:e], rows[1, s], rows[2, s], *rows[4:, s:e])]
            held = [rows[:, new[-1] :]] if len(new) and batch is not None else []
            if out:
                found = np.unique(np.concatenate(out, axis=1), axis=1)
                for k in range(0, found.shape[1], 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found[:, k : k + (1 << 16)]], ["u", "v"])

    dealt = rows.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    return scratch.table(dealt.mapInArrow(run, "u long, v long").distinct(), f"{name}-met")


def near_duplicates(df: DataFrame, size: int = SHINGLE, percent: int = PERCENT, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_shingles, component_id and kept for every row."""
    spark, plan = df.sparkSession, layout(percent)
    scratch, rows = Scratch(spark), _rows_of(df, text, key)
    signed = scratch.table(signatures(rows, size, plan), "signed")
    first = [F.first(c).alias(c) for c in ("n", "a", "b", "sketch")]
    nodes = signed.filter("digest is not null").groupBy("digest").agg(F.min("id").alias("id"), F.min("place").alias("place"), *first)
    # numbers follow the ids, so that pivots are the first texts of their kind: most likely those that others were made from
    nodes = numbered(nodes.orderBy(F.col("id").asc_nulls_last()), scratch, "node", "nodes", codec="snappy")

    halves = nodes.select("node", "b", F.explode("a").alias("half"))
    shared = scratch.table(halves.groupBy("half").agg(F.count("*").alias("rows")).filter("rows > 1").select("half"), "shared")
    keys = merge_join(halves, shared, "half", "left_semi").select("node", "half", F.explode("b").alias("other"))
    keys = scratch.table(keys.select("node", F.xxhash64("half", "other").alias("key")), "keys")
    buckets = scratch.table(keys.groupBy("key").agg(F.min("node").alias("v"), F.count("*").alias("rows")).filter("rows > 1").select("key", "v", _parts(F.col("rows"))), "buckets")
    keys = scratch.table(merge_join(keys, buckets, "key"), "bucketed")

    ids = scratch.table(keys.select("node").distinct(), "ids")
    known = scratch.table(merge_join(nodes.select("node", "place", "digest", "n", "sketch"), ids, "node"), "known")
    texts = scratch.table(picked_texts(rows, known.select("place", "node", "digest"), size), "texts")
    facts = known.select("node", "n", "sketch")

    def decide(met: DataFrame, name: str) -> DataFrame:
        return _verify(scratch.table(_close(met, facts, percent), f"{name}-pairs"), texts, scratch, name, percent, size)

    met = keys.filter("node <> v").groupBy(F.col("node").alias("u"), "v").agg(F.max("parts").alias("parts"))
    links, keys, before, turn = decide(met, "star"), keys.select("key", "node"), None, 0
    while True:
        name = f"turn{turn}"
        opened = _open(keys, components(links, scratch, f"{name}-cc"), scratch, name)
        classes = opened.agg(F.count_distinct("class")).first()[0]
        if not classes:
            break
        last = before is not None and 2 * classes > before
        prefixes = _prefixes(opened, texts, scratch, name, percent, size)
        if last:
            links = links.union(_verify_cells(_rest(prefixes, scratch, name, percent), texts, scratch, name, percent, size))
            break
        links = links.union(decide(_best(prefixes, scratch, name, percent, turn), name))
        before, turn = classes, turn + 1
    labels = components(links, scratch, "cc")
    homes = merge_join(nodes.select("node", "digest", "id"), labels.toDF("node", "component"), "node", "left").select("digest", "id", F.coalesce("component", "node").alias("component"))
    homes = scratch.table(homes, "homes")
    least = homes.groupBy("component").agg(F.min("id").alias("home"))
    homes = scratch.table(merge_join(homes, least, "component").select("digest", "home"), "least")
    scratch.keep("signed", "least")
    signed = signed.select("id", "n", "digest")
    out = merge_join(signed.filter("digest is not null"), homes, "digest").select("id", "n", "home").union(signed.filter("digest is null").select("id", "n", F.col("id").alias("home")))
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.col("home").alias("component_id"), F.col("id").eqNullSafe(F.col("home")).alias("kept"))


def _survivors(df: DataFrame, size: int, percent: int, text: str, key: str) -> DataFrame:
    """keep_one of a table with repeated or null ids: its rows are written once with a number each, which stands for the id."""
    number = free_name(df.columns, "row")
    rows = numbered(df, Scratch(df.sparkSession), number)
    alike = near_duplicates(rows, size, percent, text, number).select(number, "n_shingles", "component_id")
    facts = rows.select(number, F.col(key).alias("id"), F.xxhash64(text).alias("hash"))
    # without shingles only equal rows belong together, and a null id stands for itself
    bare = F.col("n_shingles") == 0
    group = [F.when(~bare | F.col("id").isNull(), F.col("component_id")), F.when(bare, F.col("id")), F.when(bare, F.col("hash"))]
    best = F.min(F.struct(F.col("id").isNull(), "id", "hash", number))[number]
    kept = alike.join(facts, number).groupBy(*(c.alias(f"g{k}") for k, c in enumerate(group))).agg(best.alias(number)).select(number)
    return rows.join(kept, number, "left_semi").select(*df.columns)


def keep_one(df: DataFrame, size: int = SHINGLE, percent: int = PERCENT, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each component, with all its columns: that of the smallest id (any one of equal rows).

    Of rows that repeat an id and a text one stays. Rows with null ids are compared like all others; one stays if its
    component has no other id. Rows of one id with different texts are different rows.
    """
    if not df.groupBy(key).count().filter((F.col("count") > 1) | F.col(key).isNull()).isEmpty():
        return _survivors(df, size, percent, text, key)
    kept = near_duplicates(df, size, percent, text, key).filter("kept").select(key).distinct()
    return df.join(kept, key, "left_semi")


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
