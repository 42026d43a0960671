"""Phrase collocations: n-gram counts from word-id suffix arrays of shards, merged by phrase, and scores of the phrases.

A shard is a slice of about SHARD_BYTES of texts. Its words become numbers; prefix doubling in numpy orders the suffixes
of its pieces, and the intervals of common prefixes of at least k words are its phrases of k words, each with its count.
Spark adds the counts of all shards by (lang, phrase).

Counting takes three passes over the texts, and each prunes the next one exactly: a phrase that occurs `least` times has only
words, and pairs of neighbours, that do. Pass 1 counts words; pass 2 adds up the pairs of frequent words by buckets of their
hashes (40 bits), whose sums are at least the counts of the pairs in them; pass 3 counts the phrases whose pairs are all in buckets
that reach `least`. What may be frequent reaches the shards as bitmaps of at most MAX_BITS bits each (16 MB), the only thing that is
broadcast: what is not in a bitmap is surely rare. Beyond some 20 million frequent pairs the bitmap fills up and prunes less, which
costs shuffle, never a phrase; max_bits is a parameter for executors with more memory. Counts are exact.

Defined results: null and empty texts have no words; a null lang counts as UND; equal rows each count; words are joined
by one space, which no word has; ties in rank go to the larger count, then to the smaller phrase in UTF-8 byte order; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.llm.common import Scratch, map_arrow, merge_join
from textmill.llm.words import mix

LONGEST, LEAST, PERCENT, TOP, UND = 5, 100, 100, 2000, "und"
SHARD_BYTES = 8_000_000
#: A bitmap has some BITS_EACH bits for each of its numbers, and at most MAX_BITS.
BITS_EACH, MAX_BITS = 16, 1 << 27
BUCKET_BITS = 40
_SLOT = 32
_MARK = 46
#: A-Z in lower case, tabs as spaces, what ends a piece as one mark.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else _MARK if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))
#: Up to so many languages their totals are broadcast.
BROADCAST_LANGS = 100_000


class Bitmap:
    """Numbers: `holds` has no false negatives."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots
        self.bits = len(slots) * _SLOT

    def holds(self, numbers: np.ndarray) -> np.ndarray:
        at = numbers % self.bits
        return (self.slots[at // _SLOT] >> (at % _SLOT).astype(np.uint32) & 1).astype(bool)


def word_numbers(lang: str, words: list[bytes]) -> np.ndarray:
    """The checksums of a lang's words, as Spark has them of lang, NUL and word."""
    start = zlib.crc32(lang.encode() + b"\0")
    return np.fromiter((zlib.crc32(w, start) for w in words), np.int64, len(words))


def pair_buckets(lang: str, words: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The buckets of the pairs of words with the numbers a and b."""
    from xxhash import xxh3_64_intdigest

    seed = zlib.crc32(lang.encode())
    hashes = np.fromiter((xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))
    return (mix(mix(hashes[a]) + hashes[b] * np.uint64(3)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def bitmap_of(numbers: DataFrame, most: int = MAX_BITS) -> Bitmap:
    """The bitmap of a column `at`: its words come from an aggregation, at most `most` / 32 of them."""
    bits = min(most, max(1024, 1 << (BITS_EACH * numbers.count()).bit_length()))
    words = numbers.select((F.col("at") % bits).alias("at")).selectExpr(f"int(at div {_SLOT}) AS slot", f"shiftleft(1L, int(at % {_SLOT})) AS bit")
    found = words.groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()
    slots = np.zeros(bits // _SLOT, np.uint32)
    slots[found["slot"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return Bitmap(slots)


def word_ids(texts: list[str | None]) -> tuple[np.ndarray, list[bytes]]:
    """The words of all texts as numbers, one after another, -1 between pieces; and the words by number."""
    data = "\n".join(t for t in texts if t).encode().translate(_FOLD)
    words = pa.array(data.replace(b".", b" . ").split(), pa.binary()).dictionary_encode()
    ids, names = words.indices.to_numpy().astype(np.int64), words.dictionary.to_pylist()
    if b"." in names:
        ids[ids == names.index(b".")] = -1
    return ids, names


def suffix_order(ids: np.ndarray, room: np.ndarray, longest: int) -> np.ndarray:
    """Places of all suffixes in the order of their first `longest` words or more, by prefix doubling.

    room: how many words follow from each place up to the end of its run, the place itself included. Shorter suffixes go first.
    """
    places, rank, done = np.arange(len(ids)), ids + 1, 1
    while done < longest:
        ahead = np.minimum(places + done, len(ids) - 1)
        pairs = rank * (rank.max() + 1) + np.where(room > done, rank[ahead], 0)
        rank = np.unique(pairs, return_inverse=True)[1] + 1
        done *= 2
    return np.argsort(rank, kind="stable")


def common_prefixes(ids: np.ndarray, room: np.ndarray, order: np.ndarray, longest: int) -> np.ndarray:
    """How many words, up to `longest`, each suffix in the order shares with the one before it."""
    before, here = order[:-1], order[1:]
    shared, equal = np.zeros(len(order), np.int64), np.ones(max(len(order) - 1, 0), bool)
    for k in range(longest):
        both = equal & (room[before] > k) & (room[here] > k)
        at = np.flatnonzero(both)
        equal = np.zeros_like(both)
        equal[at] = ids[before[at] + k] == ids[here[at] + k]
        shared[1:] += equal
    return shared


def intervals(ids: np.ndarray, joined: np.ndarray, shortest: int, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each size from shortest to longest: the place of one occurrence of each phrase of so many words, and its count.

    joined: whether a place and the next one can be in one phrase. Intervals of the suffix order are the phrases.
    """
    n = len(ids)
    if not n:
        return
    ends = np.where(joined, n, np.arange(n))
    ends[-1] = n - 1
    room = np.minimum.accumulate(ends[::-1])[::-1] - np.arange(n) + 1
    order = suffix_order(ids, room, longest)
    shared, room_of = common_prefixes(ids, room, order, longest), room[order]
    for size in range(shortest, longest + 1):
        members = np.flatnonzero(room_of >= size)
        first = np.flatnonzero(shared[members] < size)
        yield size, order[members[first]], np.diff(np.r_[first, len(members)])


def runs_of(lang: str, texts: list[str | None], words: Bitmap | None, pairs: Bitmap | None) -> tuple[np.ndarray, np.ndarray, list[bytes], int]:
    """The words of a shard that the bitmaps do not rule out, as numbers; whether each is joined to the next one; the words by number; and
    how many words the shard has."""
    ids, names = word_ids(texts)
    total = int(np.count_nonzero(ids >= 0))
    alive = ids >= 0
    if words is not None and len(names):
        alive &= words.holds(word_numbers(lang, names))[ids]
    # rare words go; what stood around them is not joined
    places = np.flatnonzero(alive)
    joined = np.r_[np.diff(places) == 1, False][: len(places)]
    ids = ids[places]
    if pairs is not None and len(ids):
        two = np.flatnonzero(joined)
        joined[two] = pairs.holds(pair_buckets(lang, names, ids[two], ids[two + 1]))
        stay = joined | np.r_[False, joined[:-1]]
        ids, joined = ids[stay], joined[stay]
    return ids, joined, names, total


def shard_pairs(lang: str, texts: list[str | None], words: Bitmap) -> tuple[pa.Array, np.ndarray]:
    """Buckets and counts of a shard's pairs of words that the bitmap does not rule out."""
    ids, joined, names, _ = runs_of(lang, texts, words, None)
    for _, at, counts in intervals(ids, joined, 2, 2):
        return pa.array(pair_buckets(lang, names, ids[at], ids[at + 1])), counts
    return pa.array([], pa.int64()), np.zeros(0, np.int64)


def shard_counts(lang: str, texts: list[str | None], shortest: int, longest: int, words: Bitmap | None, pairs: Bitmap | None) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Keys and counts of a shard's phrases of shortest to longest words that the bitmaps do not rule out.

    A key is one string, so that rows are small: the length of the lang, a colon, the lang and the phrase. With shortest 1 there is one
    more row, with no phrase: how many words there are.
    """
    ids, joined, names, total = runs_of(lang, texts, words, pairs)
    start = f"{len(lang)}:{lang}".encode()
    if shortest == 1:
        yield pa.array([start]), np.array([total])
    table, first = pa.array(names, pa.binary()), pa.array([start + w for w in names], pa.binary())
    for size, at, counts in intervals(ids, joined, shortest, longest):
        if len(at):
            columns = [(table if k else first).take(pa.array(ids[at + k])) for k in range(size)]
            yield columns[0] if size == 1 else pc.binary_join_element_wise(*columns, b" "), counts


def _merged(docs: DataFrame, kind: pa.DataType, words: Bitmap | None, pairs: Bitmap | None, shard: Callable[..., Iterator[tuple[pa.Array, np.ndarray]]]) -> DataFrame:
    """key and count: what shard(lang, texts, words, pairs) gives for each lang of each slice of docs(lang, text), added up by key."""
    context = docs.sparkSession.sparkContext
    shared_words, shared_pairs = (None if b is None else context.broadcast(b) for b in (words, pairs))
    schema = pa.schema([("key", kind), ("count", pa.int64())])

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        first, second = (None if b is None else b.value for b in (shared_words, shared_pairs))

        def count(batch: pa.RecordBatch) -> pa.RecordBatch:
            langs = batch.column("lang")
            out = []
            for lang in pc.unique(langs).to_pylist():
                texts = batch.column("text").filter(pc.equal(langs, lang)).to_pylist()
                out += [pa.RecordBatch.from_arrays([keys.cast(kind), pa.array(counts, pa.int64())], schema=schema) for keys, counts in shard(lang, texts, first, second)]
            return pa.concat_batches(out) if out else pa.RecordBatch.from_pylist([], schema)

        return count

    each = map_arrow(docs, make, f"key {'long' if pa.types.is_integer(kind) else 'string'}, count long", most=SHARD_BYTES)
    return each.groupBy("key").agg(F.sum("count").alias("count"))


def phrase_counts(docs: DataFrame, shortest: int, longest: int, words: Bitmap | None = None, pairs: Bitmap | None = None) -> DataFrame:
    """key and count of phrases over all shards. docs: lang, text."""
    return _merged(docs, pa.string(), words, pairs, lambda lang, texts, first, second: shard_counts(lang, texts, shortest, longest, first, second))


def pair_sums(docs: DataFrame, words: Bitmap) -> DataFrame:
    """key (a bucket of pairs) and count over all shards. docs: lang, text."""
    return _merged(docs, pa.int64(), words, None, lambda lang, texts, first, _: [shard_pairs(lang, texts, first)])


def _phrases(counts: DataFrame) -> DataFrame:
    """lang, size, phrase and count of keys and counts."""
    length = F.substring_index("key", ":", 1)
    rest, n = F.col("key").substr(F.char_length(length) + 2, F.char_length("key")), length.cast("int")
    named = counts.select(rest.substr(F.lit(1), n).alias("lang"), rest.substr(n + 1, F.char_length(rest)).alias("phrase"), "count")
    return named.select("lang", F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " "))).alias("size"), "phrase", "count")


def count_phrases(df: DataFrame, scratch: Scratch, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, max_bits: int | None = None) -> DataFrame:
    """lang, size, phrase and count of all phrases of 1 to `longest` words that occur at least `least` times; and for each lang
    a row of size 0 that counts all its words. Each pass is written once."""
    most = max_bits or MAX_BITS
    docs = df.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UND)).alias("lang"), F.col(f"`{text}`").alias("text"))
    often = lambda counts: _phrases(counts).filter((F.col("count") >= least) | (F.col("size") == 0))
    words = scratch.table(often(phrase_counts(docs, 1, 1)), "phrases1")
    if longest == 1:
        return words
    known = bitmap_of(words.filter("size = 1").select(F.crc32(F.concat("lang", F.lit("\0"), "phrase")).alias("at")), most)
    sums = scratch.table(pair_sums(docs, known).filter(F.col("count") >= least).select(F.col("key").alias("at")), "pairs")
    return words.unionByName(scratch.table(often(phrase_counts(docs, 2, longest, known, bitmap_of(sums, most))), "phrases2"))


def weakest_cuts(counts: DataFrame) -> DataFrame:
    """lang, size, phrase, a, l, r, n and score of each phrase of two words or more: its lowest-scoring cut.

    score: floor(1000 a n / (l r)), in whole numbers of 38 digits; ties go to the shortest first part.
    """
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    parts = F.split("phrase", " ")
    cuts = counts.filter("size > 1").select("lang", "size", "phrase", F.col("count").alias("a"), parts.alias("w"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    join = lambda start, n: F.array_join(F.slice("w", start, n), " ")
    cuts = cuts.select("lang", "size", "phrase", "a", "k", join(F.lit(1), F.col("k")).alias("left"), join(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    known = counts.filter("size > 0")
    cuts = merge_join(cuts, known.select("lang", F.col("phrase").alias("left"), F.col("count").alias("l")), ["lang", "left"])
    cuts = merge_join(cuts, known.select("lang", F.col("phrase").alias("right"), F.col("count").alias("r")), ["lang", "right"])
    totals = counts.filter("size = 0").select("lang", F.col("count").alias("n"))
    best = cuts.join(F.broadcast(totals) if totals.limit(BROADCAST_LANGS + 1).count() <= BROADCAST_LANGS else totals, "lang")
    best = best.withColumn("p", whole("a") * whole("n") * F.lit(1000).cast("decimal(4,0)")).withColumn("q", whole("l") * whole("r"))
    best = best.groupBy("lang", "size", "phrase", "a", "n").agg(F.min(F.struct(F.expr("p div q").alias("score"), "k", "l", "r")).alias("c"))
    return best.select("lang", "size", "phrase", "a", "c.l", "c.r", "n", "c.score")


def without_parts(phrases: DataFrame, percent: int = PERCENT) -> DataFrame:
    """phrases without those that lie inside a longer one with at least `percent` % of their count.

    A phrase in between has at least the longer one's count, so phrases of one more word decide.
    """
    words = F.split("phrase", " ")
    ends = F.array(F.array_join(F.slice(words, F.lit(1), F.col("size") - 1), " "), F.array_join(F.slice(words, F.lit(2), F.col("size") - 1), " "))
    inner = phrases.filter("size > 2").select("lang", F.explode(ends).alias("phrase"), F.col("a").alias("longer"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    return merge_join(phrases, inner, ["lang", "phrase"], "left").filter(F.expr(f"longer IS NULL OR 100 * longer < {percent} * a")).drop("longer")


def collocations(df: DataFrame, scratch: Scratch, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, percent: int = PERCENT, top: int = TOP, max_bits: int | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: each lang's first `top` phrases of 2 to `longest` words."""
    counts = count_phrases(df, scratch, text, lang, longest, least, max_bits)
    scored = without_parts(weakest_cuts(counts), percent)
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return scored.withColumn("rank", rank).filter(F.col("rank") <= top).select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of each lang of all texts."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark))


ORACLE_SQL = {
    "op13_collocations": r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
sizes AS (SELECT unnest(range(1, 6)) AS size),
grams AS (SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, sizes WHERE len(w) >= size)),
often AS (SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
cuts AS (SELECT lang, size, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM often WHERE size > 1),
scored AS (SELECT c.lang, c.size, c.phrase, c.a, l.a AS l, r.a AS r, n, k, ((1000::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a))::BIGINT AS score
    FROM cuts c JOIN totals USING (lang)
    JOIN often l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:k], ' ')
    JOIN often r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1:], ' ')),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT * FROM weakest s WHERE NOT EXISTS (SELECT 1 FROM often o WHERE o.lang = s.lang AND o.size > s.size AND contains(' ' || o.phrase || ' ', ' ' || s.phrase || ' ') AND 100 * o.a >= 100 * s.a))
SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000
"""
}
