"""Quality rules from a suffix array: longest-common-prefix intervals of each text's words.

All words of a slice of rows are numbered and their suffixes ordered by prefix doubling; documents stay apart because a
word's first rank holds its document. The ranks of each doubling then give the longest common prefix of neighbours by
binary lifting. A run of neighbours with a common prefix of L words or more is the interval of a maximal repeat; its
spans are united, and the rule limits the covered fraction of the words and the longest repeat.

Defined results: null and empty texts have no words, so the base rule rejects them; a repeated row is judged like the
first; columns other than doc_id and text are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from textmill.llm.common import columns_of, keyed, map_arrow

SPACE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
#: Bytes of text whose suffixes are ordered at once: some 30 numbers for each word are held meanwhile.
QUALITY_SLICE = 1_000_000


@dataclass(frozen=True)
class RepeatLimits:
    """Rejected: under min_words words, covered over max_covered of the words, or one repeat over max_longest of them."""

    min_repeat: int = 8
    min_words: int = 20
    max_covered: float = 0.3
    max_longest: float = 0.2


def _dense(keys: np.ndarray) -> tuple[np.ndarray, bool]:
    """Dense ranks of keys, and whether two are equal."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.r_[False, ordered[1:] != ordered[:-1]]
    ranks = np.empty(len(keys), np.int32)
    ranks[order] = np.cumsum(new)
    return ranks, int(new.sum()) < len(keys) - 1


def suffix_array(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of all suffixes, documents apart (doc ascends), and each one's common prefix with its predecessor."""
    n = len(words)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    here, ends = np.arange(n), np.searchsorted(doc, doc, side="right")
    rank, equal = _dense(doc * (int(words.max()) + 1) + words)
    levels, h = [rank], 1  # levels[k]: equal where the next 2**k words are
    while equal:
        after = np.where(here + h < ends, rank[np.minimum(here + h, n - 1)] + 1, 0)
        rank, equal = _dense(rank.astype(np.int64) * (n + 1) + after)
        levels.append(rank)
        h *= 2
    order = np.empty(n, np.int64)
    order[rank] = here
    left, right = order[:-1], order[1:]
    lcp = np.zeros(n, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = left + lcp[1:], right + lcp[1:]
        fits = (a < ends[left]) & (b < ends[right])
        same = fits & (levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)])
        lcp[1:] += same.astype(np.int64) << k
    return order, lcp


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in the union of the spans."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:-1]) > 0


def repeat_figures(texts: list[list[bytes]], least: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """For each list of words: how many lie in repeats of `least` words or more, and the longest repeat."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    every = [w for words in texts for w in words]
    numbers = {w: i for i, w in enumerate(dict.fromkeys(every))}
    words = np.fromiter(map(numbers.__getitem__, every), np.int64, len(every))
    doc = np.repeat(np.arange(len(texts)), sizes)
    order, lcp = suffix_array(words, doc)
    best = np.maximum(lcp, np.r_[lcp[1:], 0][: len(lcp)])  # an interval's spans: each suffix up to its best neighbour
    order, best = order[best >= least], best[best >= least]
    hit = covered(order, best, len(words))
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, doc[order], best)
    return np.bincount(doc[hit], minlength=len(texts)), longest


SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, longest_repeat long"


def _judge(batch: pa.RecordBatch, limits: RepeatLimits) -> list[np.ndarray]:
    texts = [x or "" for x in batch.column(1).to_pylist()]
    raw = [x.encode() for x in texts]
    words = [x.split() for x in raw]
    n_words = np.fromiter(map(len, words), np.int64, len(words))
    word_chars = [len(t) - len(b) + len(b.translate(None, SPACE)) for t, b in zip(texts, raw, strict=True)]
    n_symbols = [len(b) - len(b.translate(None, SYMBOLS)) for b in raw]
    n_dup = []
    for b in raw:
        lines = [x for x in b.split(b"\n") if x.strip(SPACE)]
        n_dup.append(len(lines) - len(set(lines)))
    n_repeat, longest = repeat_figures(words, limits.min_repeat)
    failed = (n_words < limits.min_words) | (100 * n_repeat > round(100 * limits.max_covered) * n_words)
    kept = ~failed & (longest <= limits.max_longest * n_words)
    return [n_words, np.array(word_chars, np.int64), np.array(n_symbols, np.int64), np.array(n_dup, np.int64), n_repeat, failed, kept, longest]


def judge(df: DataFrame, limits: RepeatLimits = RepeatLimits(), text: str = "text", key: str = "doc_id") -> DataFrame:  # noqa: B008
    """key, the counts, base_failed, kept and longest_repeat of every row. One pass, no shuffle."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, _judge(batch, limits))], [key, *(x.split()[0] for x in SCHEMA.split(", "))])

        return work

    return map_arrow(columns_of(df, key, text), make, keyed(df, key, SCHEMA), text, QUALITY_SLICE)


def keep_good(df: DataFrame, limits: RepeatLimits = RepeatLimits(), text: str = "text") -> DataFrame:  # noqa: B008
    """The rows that the rules keep, with all their columns; nothing is shuffled."""

    place = df.columns.index(text)

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            kept = _judge(pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows), batch.column(place)], ["key", "text"]), limits)[6]
            return batch.filter(pa.array(kept))

        return work

    return map_arrow(df, make, df.schema, text, QUALITY_SLICE)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
