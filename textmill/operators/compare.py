"""Comparison of two taggings of the same texts, and gender/number filling in noun phrases."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def map_tags(tokens: DataFrame, mapping: DataFrame, tagset: str, tag: str = "tag") -> DataFrame:
    """upos: what the tagset's table (tagset, tag, upos) says, else the tag itself."""
    table = mapping.filter(F.col("tagset") == tagset).select(F.col("tag").alias(tag), "upos")
    return tokens.join(table, tag, "left").withColumn("upos", F.coalesce("upos", tag))


def tag_counts(frames: dict[str, DataFrame], tag: str = "tag") -> DataFrame:
    """A row for each tag with its count in every frame (0 where absent)."""
    every = reduce(DataFrame.unionByName, (f.select(F.col(tag).alias("tag"), F.lit(n).alias("file")) for n, f in frames.items()))
    return every.groupBy("tag").pivot("file", list(frames)).count().fillna(0)


def diff_codes(tokens: DataFrame, keys: list[str], a: str, b: str, order: str = "pos") -> DataFrame:
    """island: the run of equal or unequal tokens that a token is in, counted in its group."""
    same = (F.col(a) == F.col(b)).cast("int")
    w = W.partitionBy(*keys).orderBy(order)
    t = tokens.withColumn("same", same)
    return t.withColumn("island", F.sum(F.coalesce((F.col("same") != F.lag("same").over(w)).cast("int"), F.lit(0))).over(w).cast("long"))


def diff_counts(tokens: DataFrame, word: str, a: str, b: str) -> DataFrame:
    """Counts of (word, tag, tag) that differ, as shares of all differences and of all tokens."""
    total = tokens.agg(F.count("*").alias("total"), F.count_if(F.col(a) != F.col(b)).alias("diffs"))
    counted = tokens.filter(F.col(a) != F.col(b)).groupBy(word, a, b).agg(F.count("*").alias("n"))
    return counted.join(F.broadcast(total)).select(word, a, b, "n", (100 * F.col("n") / F.col("diffs")).alias("diff_pct"), (100 * F.col("n") / F.col("total")).alias("total_pct"))


def pair_counts(counts: DataFrame, a: str, b: str) -> DataFrame:
    return counts.groupBy(a, b).agg(F.sum("n").alias("n"))


def summary(aligned: DataFrame, a: str, b: str, compared: Column | None = None) -> DataFrame:
    """Totals of a comparison. compared: which tokens take part; the others are ignored."""
    part = F.lit(True) if compared is None else compared
    same = part & (F.col(a) == F.col(b))
    t = aligned.agg(F.count("*").alias("total"), F.count_if(part).alias("compared"), F.count_if(same).alias("same"), F.count_if(part & ~same).alias("diff"), F.count_if(~part).alias("ignored"))
    return t.select("*", (100 * F.col("same") / F.col("compared")).alias("same_pct"), (100 * F.col("diff") / F.col("compared")).alias("diff_pct"))


def code_errors(codes: Column) -> Column:
    """How often a single token differs between equal ones in a string of codes (0 equal, 1 left only, 2 right only)."""
    return F.size(F.regexp_extract_all(codes, F.lit("010|020"), F.lit(0)))


# Classes of Spanish-style tokens, first match wins: (pattern of the tag, words in lower case or None for all,
# class, group of gender, group of number; 0 where it has none).
CLASSES = (
    (r"^D..(.)(.)", None, "D", 1, 2),
    (r"^SP", None, "S", 0, 0),
    (r"^P[DI].(.)(.)", None, "P", 1, 2),
    (r"^PR.(.)(.)", ("cuyo", "cuya", "cuyos", "cuyas"), "P", 1, 2),
    (r"^PT.(.)(.)", ("cuántos", "cuántas"), "P", 1, 2),
    (r"^A..(.)(.)", None, "A", 1, 2),
    (r"^N.(.)(.)", None, "N", 1, 2),
    (r"^V.P..(.)(.)", None, "V", 2, 1),
    (r"", ("no",), "O", 0, 0),
)
# Fixed value: class letters of a noun phrase.
PHRASE = "(?:D|S|P|DD|SD|DP|SP|DDD|SDD|DDP|SDP)?[ANVO]{0,9}[ANV]"


def classify(tag: Column, word: Column | None = None, classes=CLASSES) -> tuple[Column, Column, Column]:
    """Class letter, gender and number of a token; X, 0, 0 without a match. Without its word the rules of words do not apply."""
    outs = []
    for pick in range(3):
        c = F
        for pattern, words, letter, g, n in classes:
            if words and word is None:
                continue
            fits = tag.rlike(pattern) if pattern else F.lit(True)
            fits = fits & F.lower(word).isin(*words) if words else fits
            group = (None, g, n)[pick]
            c = c.when(fits, F.lit(letter) if pick == 0 else F.regexp_extract(tag, pattern, group) if group else F.lit("0"))
        outs.append(c.otherwise("X" if pick == 0 else "0"))
    return tuple(outs)


def gather(tokens: DataFrame, keys: list[str], order: str = "pos") -> DataFrame:
    """keys and t, each sentence's tokens (structs of the other columns) in their order. One shuffle."""
    rest = [c for c in tokens.columns if c not in keys]
    return tokens.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, *(c for c in rest if c != order)))).alias("t"))


def phrase_parts(letters: Column, pattern: str = PHRASE) -> Column:
    """The class letters of a sentence in parts: what is before a match, the match, what is before the next one, and so on to the
    end. Matches are maximal and found from the left, so element 2k + 1 (from 0) is match k."""
    return F.split(F.regexp_replace(letters, f"({pattern})", "<$1>"), "[<>]")


def phrase_strings(letters: Column, pattern: str = PHRASE) -> Column:
    """The matches of two letters and more."""
    return F.filter(phrase_parts(letters, pattern), lambda p, k: (k % 2 == 1) & (F.char_length(p) >= 2))


def phrase_numbers(letters: Column, pattern: str = PHRASE) -> Column:
    """For each letter of a sentence the number (from 0) of the match of two letters and more that it is in, else null."""
    number = lambda p, k: F.when((k % 2 == 1) & (F.char_length(p) >= 2), F.floor(k / 2).cast("long"))
    return F.flatten(F.transform(phrase_parts(letters, pattern), lambda p, k: F.array_repeat(number(p, k), F.char_length(p))))


def phrases(tokens: DataFrame, keys: list[str], letter: str = "cls", pattern: str = PHRASE) -> DataFrame:
    """phrase: the number (from 0) of the noun phrase of two tokens or more that a token is in, else null.

    A sentence's class letters form one string; maximal matches of the pattern are found from the left. The tokens of a sentence
    are brought together once; where sentences are rows already, phrase_numbers does it without a shuffle.
    """
    numbered = gather(tokens, keys).withColumn("_phrases", phrase_numbers(F.array_join(F.transform("t", lambda x: x[letter]), ""), pattern))
    each = numbered.select(*keys, F.inline(F.arrays_zip("t", "_phrases")))
    return each.select(*(F.col(f"`{c}`") if c in keys else F.col("t")[c].alias(c) for c in tokens.columns), F.col("_phrases").alias("phrase"))


# What is open in a phrase and what that stands for, and the definite values, of each column.
OPEN = {"gender": ("C", "M,F", ("M", "F")), "number": ("N", "S,P", ("S", "P"))}


def fill_phrases(tokens: DataFrame, keys: list[str], phrase: str = "phrase", columns: dict[str, tuple[str, str, tuple[str, ...]]] | None = None) -> DataFrame:
    """gender and number of tokens. In a phrase every value that is not definite, undefined ones (0, null) too, takes the last
    definite value so far, else the first one in the phrase, else the open value; outside it stays. Open values are then
    written out. columns: name -> (open mark, what it stands for, definite values)."""
    out = tokens
    w = W.partitionBy(*keys, phrase).orderBy("pos")
    for name, (mark, stands, values) in (columns or OPEN).items():
        definite = F.when(F.col(name).isin(*values), F.col(name))
        running = F.last(definite, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
        first = F.first(definite, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
        filled = F.when(F.col(phrase).isNotNull(), F.coalesce(running, first, F.lit(mark))).otherwise(F.col(name))
        out = out.withColumn(f"{name}_filled", F.when(filled == mark, stands).otherwise(filled))
    return out


def fill_runs(phrase: Column, value: Column, mark: str, stands: str, values: tuple[str, ...]) -> Column:
    """What fill_phrases gives one column, where a sentence is a row: phrase and value are arrays with an element for each token, and the
    tokens of a phrase stand together. Whole batches are filled at once, by places of definite values."""

    def fill(phrases_: pa.Array, given: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(given), 0).to_numpy(zero_copy_only=False)
        flat, number = pc.list_flatten(given), pc.fill_null(pc.list_flatten(phrases_), -1).to_numpy(zero_copy_only=False)
        n, at, row = len(flat), np.arange(len(flat)), np.repeat(np.arange(len(sizes)), sizes)
        if n:
            starts = np.flatnonzero(np.r_[True, (number[1:] != number[:-1]) | (row[1:] != row[:-1])])
            begin = np.repeat(starts, np.diff(np.r_[starts, n]))
            definite = pc.fill_null(pc.is_in(flat, value_set=pa.array(values, flat.type)), False).to_numpy(zero_copy_only=False)
            last = np.maximum.accumulate(np.where(definite, at, -1))
            first = np.repeat(np.minimum.reduceat(np.where(definite, at, n), starts), np.diff(np.r_[starts, n]))
            end = np.repeat(np.r_[starts[1:], n], np.diff(np.r_[starts, n]))
            source = np.where(last >= begin, last, np.where(first < end, first, -1))
            source = np.where(number < 0, at, source)
            none = source < 0
            flat = pc.if_else(pa.array(none), pa.scalar(mark, flat.type), flat.take(pa.array(np.where(none, 0, source))))
            flat = pc.if_else(pc.fill_null(pc.equal(flat, mark), False), pa.scalar(stands, flat.type), flat)
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), flat)

    return F.arrow_udf(fill, "array<string>")(phrase, value)


# Where the number stands in a tag (from 1), by how the tag begins; and lemmas that are written together.
NUMBER_AT = (("N", 4), ("A", 5), ("VMP", 6), ("D", 5))
JOINED_LEMMAS = (("de+el", "del"), ("a+el", "al"))


def gender_lemma(tokens: DataFrame, table: DataFrame, lemma: str = "lemma", tag: str = "tag") -> DataFrame:
    """gender_lemma of (lemma, tag with its number set to S) in the table, else the lemma; the table is a dictionary file.

    Only nouns, adjectives, participles and determiners are looked up.
    """
    base, joined = F, F
    for start, at in NUMBER_AT:
        base = base.when(F.col(tag).startswith(start), F.overlay(F.col(tag), F.lit("S"), at, 1))
    for old, new in JOINED_LEMMAS:
        joined = joined.when(F.col(lemma) == old, new)
    found = table.select(F.col("lemma").alias("_l"), F.col("tag").alias("_t"), F.col("gender_lemma")).dropDuplicates(["_l", "_t"])
    met = tokens.withColumn("_b", base).join(found, (F.col(lemma) == F.col("_l")) & (F.col("_b") == F.col("_t")), "left")
    return met.withColumn("gender_lemma", F.coalesce(joined, "gender_lemma", lemma)).drop("_b", "_l", "_t")


def top(df: DataFrame, order: str, n: int = 25) -> DataFrame:
    """The n rows with the largest value."""
    return df.orderBy(F.col(order).desc(), *(c for c in df.columns if c != order)).limit(n)


def pick(df: DataFrame, n: int = 25, seed: int = 0) -> DataFrame:
    """n rows in an order that a seeded hash gives."""
    cells = F.concat_ws("|", *(F.col(c).cast("string") for c in df.columns))
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), cells)), *df.columns).limit(n)
