"""Language identification of lines, sentences and documents, and what is computed from it.

The line model is pluggable: any function from a cleaned text column to a language column. The default counts function
words of each language's profile; ties go to the alphabetically first language.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.functions.text import blank_line, clean_line, fold_marks
from textmill.functions.unicode import normalize_udf, unstable_pattern

# Short function words of each language.
PROFILES = {
    "de": ("der", "die", "und", "das", "ist", "nicht", "ein", "eine", "den", "mit", "sich", "auf", "zu", "im"),
    "en": ("the", "of", "and", "to", "in", "is", "that", "was", "for", "it", "with", "as", "by", "on"),
    "es": ("el", "los", "las", "que", "y", "por", "con", "para", "una", "del", "se", "es", "al", "como"),
    "fr": ("le", "les", "et", "des", "est", "une", "dans", "pour", "que", "du", "au", "sur", "qui", "pas"),
}

LineModel = Callable[[Column], Column]


def _is_in(words: tuple[str, ...]) -> Callable[[Column], Column]:
    return lambda w: w.isin(*words)


def _function_words(words: Column, profiles: dict[str, tuple[str, ...]]) -> Column:
    """The words that any language counts, so that the others are looked at once."""
    return F.filter(words, _is_in(tuple(sorted({w for p in profiles.values() for w in p}))))


def profile_model(profiles: dict[str, tuple[str, ...]] = PROFILES) -> LineModel:
    """The language with most function words; `unknown` without any."""

    names = sorted(profiles)

    def pick(scores: Column) -> Column:
        best = F.greatest(*(scores[n] for n in names))
        out = F.when(best == 0, "unknown")
        for n in names:
            out = out.when(scores[n] == best, n)
        return out

    def model(text: Column) -> Column:
        # one-element arrays bind the words and the scores, so neither is computed more than once
        words = F.array(_function_words(F.split(F.lower(text), " "), profiles))
        scores = F.transform(words, lambda ws: F.struct(*(F.size(F.filter(ws, _is_in(profiles[n]))).alias(n) for n in names)))
        return F.element_at(F.transform(scores, pick), 1)

    return model


def profile_score(profiles: dict[str, tuple[str, ...]] = PROFILES) -> LineModel:
    """How sure the profile model is: the share of words that are function words of the best language."""

    def score(text: Column) -> Column:
        words = F.split(F.lower(text), " ")
        share = lambda x: F.greatest(*(F.size(F.filter(x["found"], _is_in(p))) for p in profiles.values())) / x["n"]
        counts = F.transform(F.array(words), lambda ws: F.struct(_function_words(ws, profiles).alias("found"), F.size(ws).alias("n")))
        return F.element_at(F.transform(counts, share), 1)

    return score


def tidy_lines(df: DataFrame, line: str = "line", blank: bool = True) -> DataFrame:
    """df with each line normalised as by normalize_line, then cleaned; without blank, only lines of which something is left.

    Lines of characters that no normal form changes, without references and markup, which are nearly all, are folded by
    built-in expressions; only the others pass through Python. Each part reads df. A null line stays null.
    """
    c = F.col(f"`{line}`")
    plain = F.coalesce(~c.rlike(unstable_pattern()), F.lit(True))
    some = lambda part: part if blank else part.filter(~blank_line(line))  # noqa: E731  asked before a line is cleaned, which is dear
    native = some(df.filter(plain).withColumn(line, fold_marks(c))).withColumn(line, clean_line(line))
    return native.unionByName(some(df.filter(~plain).withColumn(line, normalize_udf()(c))).withColumn(line, clean_line(line)))


def explode_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, line_idx (from 0) and line of each line."""
    return df.select(key, F.posexplode(F.split(text, "\n")).alias("line_idx", "line"))


def identify_lines(df: DataFrame, key: str = "doc_id", text: str = "text", min_len: int = 10, model: LineModel | None = None) -> DataFrame:
    """key, line_idx, lang and bytes of each cleaned line that is not blank; lines under min_len characters are `short`."""
    cleaned = tidy_lines(explode_lines(df, key, text), blank=False)
    lang = F.when(F.char_length("line") < min_len, "short").otherwise((model or profile_model())(F.col("line")))
    return cleaned.select(key, "line_idx", lang.alias("lang"), F.octet_length("line").cast("long").alias("bytes"))


def relabel_unsure(lang: Column, score: Column, threshold: float = 0.6) -> Column:
    """`unknown` where the model's score is not above the threshold."""
    return F.when(score > threshold, lang).otherwise("unknown")


def language_shares(lines: DataFrame, key: str = "doc_id", max_langs: int = 4) -> DataFrame:
    """key, lang, share of each language that is kept: share of bytes, rounded half to even, at least 1/(languages+1)."""
    sums = lines.groupBy(key, "lang").agg(F.sum("bytes").alias("b"))
    doc = W.partitionBy(key)
    shares = sums.select(key, "lang", F.bround(F.col("b") / F.sum("b").over(doc), 2).alias("share"), F.count("*").over(doc).alias("n"))
    return shares.filter(F.col("share") >= 1 / (F.least("n", F.lit(max_langs)) + 1)).select(key, "lang", "share")


def share_maps(shares: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, lid (map of shares, largest first), l1 (first of it) and l1_size."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("share")).alias("s"), "lang")))
    maps = shares.groupBy(key).agg(ordered.alias("o")).select(key, F.map_from_arrays(F.transform("o", lambda x: x["lang"]), F.transform("o", lambda x: -x["s"])).alias("lid"), F.col("o")[0]["lang"].alias("l1"))
    return maps.withColumn("l1_size", F.element_at("lid", F.col("l1")))


def identify(df: DataFrame, key: str = "doc_id", text: str = "text", min_len: int = 10, max_langs: int = 4, model: LineModel | None = None) -> DataFrame:
    return share_maps(language_shares(identify_lines(df, key, text, min_len, model), key, max_langs), key)


def identification_params(min_len: int, max_langs: int, model: str) -> str:
    """The parameters of a run, as JSON with sorted keys."""
    return json.dumps({"max_langs": max_langs, "min_len": min_len, "model": model}, sort_keys=True)


def identify_changed(df: DataFrame, done: DataFrame | None, key: str = "doc_id", text: str = "text", tool: str = "profile", min_len: int = 10, max_langs: int = 4, model: LineModel | None = None, seen: Observation | None = None, digest: str | None = None) -> DataFrame:
    """key, digest, lid, l1, l1_size, tool, params and identified (when) of each text: rows of `done` (what this gave before) where text,
    tool and parameters are still the same, and new ones for all others; rows of texts that are gone go.

    digest: a column that tells contents apart; by default SHA-256 of the text, which reads it but does not identify it. seen:
    observes how many texts were identified. A null text has no lines, so its lid is null; keys are unique.
    """
    params = identification_params(min_len, max_langs, tool)
    now = df.select(F.col(key), F.col(text).alias("text"), (F.col(digest) if digest else F.sha2(F.coalesce(F.col(text), F.lit("\0")), 256)).alias("digest"))
    kept = None
    if done is not None:
        kept = done.filter((F.col("tool") == tool) & (F.col("params") == params)).join(now.select(key, "digest"), [key, "digest"], "left_semi")
        now = now.join(kept.select(key, "digest"), [key, "digest"], "left_anti")
    lines = now.select(key, "text")
    if seen is not None:
        lines = lines.observe(seen, F.count("*").alias("identified"))
    found = now.select(key, "digest").join(identify(lines, key, "text", min_len, max_langs, model), key, "left")
    new = found.select(key, "digest", "lid", "l1", "l1_size", F.lit(tool).alias("tool"), F.lit(params).alias("params"), F.current_timestamp().alias("identified"))
    return new if kept is None else kept.select(*new.columns).unionByName(new)


def is_multilingual(lid: Column | str = "lid") -> Column:
    return F.size(F.array_except(F.map_keys(lid), F.array(F.lit("unknown"), F.lit("short")))) > 1


def has_language(lang: str, lid: Column | str = "lid") -> Column:
    return F.map_contains_key(lid, lang)


def share_at_least(lang: str, least: float = 0.8, lid: str = "lid") -> Column:
    return F.coalesce(F.col(lid)[lang] >= least, F.lit(False))


def l1_is(lang: str) -> Column:
    return F.col("l1") == lang


def l1_between(low: float = 0.0, high: float = 1.0) -> Column:
    """Both included."""
    return F.col("l1_size").between(low, high)


def sentence_languages(tokens: DataFrame, keys: list[str], pos: str = "pos", word: str = "word", short: int = 4, long: int = 500, languages: tuple[str, ...] = ("en", "fr", "es"), model: LineModel | None = None) -> DataFrame:
    """keys and lang of each sentence of `short` tokens or more; from `long` on by vote of chunks, ties for the first seen."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(pos, word))), lambda t: t[word]), " ")
    return text_languages(tokens.groupBy(*keys).agg(text.alias("text")), keys, short, long, languages, model)


def text_languages(texts: DataFrame, keys: list[str], short: int = 4, long: int = 500, languages: tuple[str, ...] = ("en", "fr", "es"), model: LineModel | None = None) -> DataFrame:
    """sentence_languages of sentences (keys and text, the words by spaces) that are rows already."""
    sentences = tidy_lines(texts.select(*keys, "text"), "text", blank=False).withColumn("words", F.split("text", " "))
    sentences = sentences.filter((F.size("words") >= short) & (F.col("words")[0] != ""))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size("words") - 1) / long).cast("int")), lambda i: F.slice("words", i * long + 1, F.lit(long)))
    each = sentences.select(*keys, F.posexplode(F.when(F.size("words") < long, F.array("words")).otherwise(chunks)).alias("chunk", "words"))
    model = model or profile_model({k: v for k, v in PROFILES.items() if k in languages})
    named = each.select(*keys, "chunk", model(F.array_join("words", " ")).alias("lang"))
    votes = named.groupBy(*keys, "lang").agg(F.count("*").alias("n"), F.min("chunk").alias("first"))
    return votes.groupBy(*keys).agg(F.min_by("lang", F.struct(-F.col("n"), "first")).alias("lang"))


def sample_lines(df: DataFrame, key: str, text: str, size: int, seed: int = 0) -> DataFrame:
    """key and line: `size` distinct cleaned lines of each document, picked by a hash; size 0 or more than there are: all."""
    cleaned = tidy_lines(explode_lines(df, key, text), blank=False)
    if not size:
        return cleaned.select(key, "line")
    one = cleaned.groupBy(key, "line").agg(F.count("*").alias("copies"))
    doc = W.partitionBy(key)
    ranked = one.withColumn("rank", F.row_number().over(doc.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), "line")), "line"))).withColumn("lines", F.sum("copies").over(doc))
    few = ranked.filter(F.col("lines") < size).select(key, F.explode(F.array_repeat("line", F.col("copies").cast("int"))).alias("line"))
    return ranked.filter((F.col("lines") >= size) & (F.col("rank") <= size)).select(key, "line").union(few)


def line_statistics(df: DataFrame, key: str, text: str) -> DataFrame:
    """Characters, lines and the quartiles of line length (nearest rank, half to even) of each text."""
    lengths = F.array_sort(F.transform(F.split(text, "\n"), F.char_length))
    stats = df.select(key, F.char_length(text).cast("long").alias("chars"), lengths.alias("l"))
    at = lambda q: F.col("l")[F.bround(F.lit(q) * (F.size("l") - 1)).cast("int")]
    return stats.select(key, "chars", F.size("l").cast("long").alias("lines"), *(at(q).cast("long").alias(n) for q, n in ((0.0, "min"), (0.25, "q1"), (0.5, "q2"), (0.75, "q3"), (1.0, "max"))))
