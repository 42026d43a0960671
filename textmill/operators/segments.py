"""Segments of ordered lines and tokens: capped groups, batches of sentences, and names joined over function words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.operators.compare import gather, phrase_numbers, phrase_parts

#: Lines of a group at most, and sentences of a batch.
MOST_LINES, MOST_SENTENCES = 10_000, 1_000
# Words that may stand inside a name, and punctuation after which a capital may be a beginning.
FUNCTION_WORDS = ("the", "a", "an", "of", "for", "'s", "&", "de", "d'", "von")
OPENING = ("Fpa", "Fca", "Fla", "Fp", "Fs", "Fd", "Fg", "Fe", "Fia", "Fit", "Faa", "Fat", "Fra", "Frc")
#: A name: capitals, with function words only between them.
NAME = "C(?:F*C)*"


def capped_groups(lines: DataFrame, file: str = "file", order: str = "line_idx", value: str = "value", stop: str = "</s>", most: int = MOST_LINES) -> DataFrame:
    """group (from 0) of each line of a file: a group ends with a `stop` line, or when it has `most` lines.

    Both ends set the count back, so a line's group within its sentence is its place there divided by `most`; the groups
    of the sentences before are added. A null value is no stop; an empty table gives no rows; ties in the order are the caller's.
    Stops are found before lines are shuffled, so values travel only where they are asked for. Where sentences are rows already,
    capped_sentences shuffles no line.
    """
    by = W.partitionBy(file).orderBy(order)
    stops = F.coalesce((F.col(value) == stop).cast("int"), F.lit(0))
    t = lines.withColumn("_stop", stops).withColumn("_sent", F.coalesce(F.sum("_stop").over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    t = t.withColumn("_place", F.row_number().over(W.partitionBy(file, "_sent").orderBy(order)) - 1)
    new = (F.col("_place") % most == 0).cast("int")
    return t.withColumn("group", F.sum(new).over(by) - 1).drop("_stop", "_sent", "_place")


def capped_sentences(sentences: DataFrame, file: str = "file", order: str = "sent", lines: str = "lines", most: int = MOST_LINES) -> DataFrame:
    """file, group and lines (how many) of the groups that capped_groups gives sentences whose lines are counted, the stop line with
    them. A row that is shuffled is a sentence."""
    before = W.partitionBy(file).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    groups = F.ceil(F.col(lines) / most).cast("long")
    t = sentences.filter(F.col(lines) > 0).select(file, order, F.col(lines).cast("long").alias("_n"), groups.alias("_k"))
    t = t.withColumn("_before", F.coalesce(F.sum("_k").over(before), F.lit(0)))
    t = t.select(file, "_n", "_before", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_k") - 1)).alias("_i"))
    return t.select(file, (F.col("_before") + F.col("_i")).alias("group"), F.least(F.lit(most).cast("long"), F.col("_n") - F.col("_i") * most).alias("lines"))


def sentence_batches(lines: DataFrame, file: str = "file", order: str = "line_idx", value: str = "value", most: int = MOST_SENTENCES) -> DataFrame:
    """batch (from 0) of each line of a file: a new one begins with the sentence tag that follows `most` sentences. Lines before the
    first sentence belong to batch 0."""
    starts = F.coalesce(F.col(value).rlike(r"^<s[ >]").cast("int"), F.lit(0))
    sentence = F.sum("_start").over(W.partitionBy(file).orderBy(order))  # starts are found before lines are shuffled
    return lines.withColumn("_start", starts).withColumn("batch", F.floor(F.greatest(sentence - 1, F.lit(0)) / most).cast("long")).drop("_start")


def name_class(word: Column, tag: Column, initial: Column, known: Column, after: Column | None = None, functions: tuple[str, ...] = FUNCTION_WORDS, opening: tuple[str, ...] = OPENING) -> Column:
    """C: a capitalised word, unless it is in the dictionary and begins a sentence or follows opening punctuation; F: a function word; X:
    another. after: the tag before."""
    begins = initial if after is None else initial | F.coalesce(after.isin(*opening), F.lit(False))
    capital = word.rlike(r"^\p{Lu}") & ~(begins & known)
    return F.when(capital, "C").when(F.lower(word).isin(*functions), "F").otherwise("X")


def name_units(items: Column, letters: Column, joiner: str = "_", tag: str = "NP00000") -> Column:
    """The tokens of a sentence (structs of pos, word, lemma and tag), the longest names of two tokens and more as one: structs of pos (of
    the first token), size, word, lemma and tag. letters: their classes (see name_class) as one string."""

    def units(b: Column) -> Column:
        parts, numbers, every = b["parts"], b["numbers"], b["items"]
        starts = F.filter(F.sequence(F.lit(0), F.size(every) - 1), lambda i: numbers[i].isNull() | ~numbers[i].eqNullSafe(F.get(numbers, i - 1)))

        def unit(i: Column) -> Column:
            one = every[i]
            size = F.char_length(F.get(parts, (2 * numbers[i] + 1).cast("int")))
            text = lambda c: F.array_join(F.transform(F.slice(every, i + 1, size), lambda x: x[c]), joiner)
            alone = F.struct(one["pos"].alias("pos"), F.lit(1).cast("long").alias("size"), one["word"].alias("word"), one["lemma"].alias("lemma"), one["tag"].alias("tag"))
            name = F.struct(one["pos"].alias("pos"), size.cast("long").alias("size"), text("word").alias("word"), F.lower(text("word")).alias("lemma"), F.lit(tag).alias("tag"))
            return F.when(numbers[i].isNull(), alone).otherwise(name)

        return F.when(F.size(every) > 0, F.transform(starts, unit))

    bound = F.array(F.struct(phrase_parts(letters, NAME).alias("parts"), phrase_numbers(letters, NAME).alias("numbers"), items.alias("items")))
    return F.element_at(F.transform(bound, units), 1)


def join_names(tokens: DataFrame, keys: list[str], cls: str = "cls", joiner: str = "_", tag: str = "NP00000") -> DataFrame:
    """keys, pos (of the first token), size, word, lemma and tag, where the longest names of two tokens and more are one token.

    tokens: keys, pos, word, lemma, tag and cls (see name_class). A function word is joined only between capitals. A
    sentence is a unit, as for phrases, and is brought together once.
    """
    sentences = gather(tokens.select(*keys, "pos", "word", "lemma", "tag", F.col(cls).alias("_cls")), keys)
    return sentences.select(*keys, F.inline(name_units(F.col("t"), F.array_join(F.transform("t", lambda x: x["_cls"]), ""), joiner, tag)))
