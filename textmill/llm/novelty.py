"""Secret scans: fixed patterns, and dictionary-primed zstandard novelty of what stands where secrets stand.

Three patterns find assignments, access keys and hexadecimal runs. Beyond them, every run of characters that secrets are made of
is a candidate if it has a digit, or a capital after a small letter, and a sensitive word stands before it on its line. Its
novelty is its marginal cost: the bytes that a zstandard frame of the surrounding text with the candidate at its end takes
beyond a frame of the surroundings alone, both primed with a dictionary of the corpus's most frequent identifiers. Names, words
and repeats of what stands around are cheap, since they are copied; a random string has to be spelled out. Candidates that
cost NOVELTY or more of their own length are reported. The measure is one of a few bytes: of random strings of 16 to 48 letters and digits
some 3 in 100 stay below NOVELTY, and of four frequent words joined by hyphens some 6 in 100 would reach it if they had a digit.

The dictionary is counted over all texts; only its first DICTIONARY_BYTES are kept, since a dictionary has a size. A text is
scanned as a whole; the surroundings of a candidate are the AROUND characters before and after it.

Defined results: null and empty texts have no spans; a null key is kept; equal rows, and rows with equal keys, each get their own
result; spans count code points, the end is exclusive, and are in order of start, then kind; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from textmill.llm.common import Scratch, free_name, map_arrow

#: Kinds in order, their patterns, the group that has a least length, and that length.
KINDS = (
    ("assign", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
NOVEL = "novel"
#: Words before a candidate on its line that make it worth a measurement, and how far before.
SENSITIVE = r"(?ai)pass(?:word|wd|phrase)?\b|pwd|secret|token|key|auth|credential|bearer|private|signature|cookie|session"
WITHIN = 48
#: Candidates: runs of these characters, and their least length.
CANDIDATE, SHORTEST = r"[A-Za-z0-9+/_=~-]+", 16
MIXED = r"[0-9]|[a-z][A-Z]"
NOVELTY = 0.8
AROUND = 100
DICTIONARY_BYTES = 100_000
LEVEL = 12


def identifier_dictionary(df: DataFrame, scratch: Scratch, text: str = "text", size: int = DICTIONARY_BYTES) -> bytes:
    """The most frequent identifiers of all texts, at most `size` bytes, the most frequent last, where references are short.

    How often an identifier must occur is read off the numbers of identifiers by the logarithm of their counts, so only about as many
    as there is room for reach the driver.
    """
    words = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(r"[A-Za-z_À-ɏ][A-Za-z0-9_À-ɏ]{3,31}"), F.lit(0))
    counts = df.select(F.explode(words).alias("w")).groupBy("w").count().filter("count > 1")
    counts = scratch.table(counts.withColumn("step", F.floor(8 * F.log2("count"))), "identifiers")
    room, steps, found = size // 5, counts.groupBy("step").agg(F.count("*").alias("n")).orderBy(F.desc("step")).collect(), 0  # some hundred steps
    for least in steps:
        found += least["n"]
        if found >= room:
            break
    best = counts.filter(F.col("step") >= (least["step"] if steps else 0)).orderBy(F.desc("count"), "w").limit(room).collect()
    scratch.drop("identifiers")
    out = b""
    for row in best:
        if len(out) + len(more := row["w"].encode() + b" ") > size:
            break
        out = more + out
    return out


class Novelty:
    """Marginal compressed bytes, primed with a dictionary."""

    def __init__(self, dictionary: bytes = b"", level: int = LEVEL):
        primed = {"dict_data": zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)} if len(dictionary) >= 8 else {}
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=False, write_content_size=False, write_dict_id=False, **primed)

    def cost(self, before: str, candidate: str, after: str) -> int:
        """How many bytes the candidate adds to its surroundings."""
        rest = (before + after + "\n").encode()
        return len(self.zstd.compress(rest + candidate.encode())) - len(self.zstd.compress(rest))


class Scanner:
    """Spans of a text: what the patterns find, and novel candidates."""

    def __init__(self, novelty: Novelty | None = None, kinds=KINDS, sensitive: str = SENSITIVE, least: float = NOVELTY):
        self.kinds = [(k, re.compile(pattern), group, length) for k, pattern, group, length in kinds]
        self.place = {k: i for i, (k, *_) in enumerate(kinds)} | {NOVEL: len(kinds)}
        self.sensitive, self.mixed = re.compile(sensitive), re.compile(MIXED)
        self.long = re.compile(rf"{CANDIDATE[:-1]}{{{SHORTEST},}}")
        self.novelty, self.least = novelty or Novelty(), least

    def base(self, text: str) -> list[tuple[str, int, int]]:
        """What the patterns find: leftmost matches of each kind that are long enough."""
        found = [(kind, m.start(), m.end()) for kind, pattern, group, length in self.kinds for m in pattern.finditer(text) if m.end(group) - m.start(group) >= length]
        return sorted(found, key=self._order)

    def novel(self, text: str, taken: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int]]:
        """Candidates in a sensitive place that cost too much to be words, apart from spans that are taken."""
        starts, reach = [a for _, a, _ in taken], [0, *accumulate((b for *_, b in taken), max)]
        for m in self.long.finditer(text):
            start, end = m.span()
            before = text[max(0, start - WITHIN) : start].rpartition("\n")[2]
            if not self.mixed.search(m.group()) or not self.sensitive.search(before) or reach[bisect_left(starts, end)] > start:
                continue
            cost = self.novelty.cost(text[max(0, start - AROUND) : start], m.group(), text[end : end + AROUND])
            if cost >= self.least * (end - start):
                yield NOVEL, start, end

    def spans(self, text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
        """The base spans, and all spans, of a text."""
        base = self.base(text) if text else []
        return base, sorted([*base, *self.novel(text, base)], key=self._order) if text else []

    def _order(self, span: tuple[str, int, int]) -> tuple[int, int]:
        return span[1], self.place[span[0]]


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def find_secrets(df: DataFrame, key: str = "doc_id", text: str = "text", dictionary: bytes | None = None, sensitive: str = SENSITIVE, least: float = NOVELTY) -> DataFrame:
    """key, base and spans (both like kind:start:end,…) and a count of base spans of each kind, n_<kind>. dictionary: by
    default that of the table's identifiers."""
    primed = df.sparkSession.sparkContext.broadcast(identifier_dictionary(df, Scratch(df.sparkSession), text) if dictionary is None else dictionary)
    kinds = [k for k, *_ in KINDS]

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        scanner = Scanner(Novelty(primed.value), sensitive=sensitive, least=least)

        def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [scanner.spans(t.as_py()) for t in batch.column(1)]
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in kinds]
            both = (pa.array([written(x[i]) for x in found], pa.string()) for i in (0, 1))
            return pa.RecordBatch.from_arrays([batch.column(0), *counts, *both], names=[name, *(f"n_{k}" for k in kinds), "base", "spans"])

        return scan

    name = free_name([*(f"n_{k}" for k in kinds), "base", "spans"], key)
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    schema = StructType([StructField(name, rows.schema[0].dataType), *(StructField(f"n_{k}", LongType()) for k in kinds), StructField("base", StringType()), StructField("spans", StringType())])
    return map_arrow(rows, make, schema, column="text")


def op12_secret_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of all texts."""
    found = find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", *(f"n_{k}" for k, *_ in KINDS), F.sha2("base", 256).alias("base_sha256"), "spans")
