"""Tagged texts, CoNLL-U and vertical: readers, the default annotator, multi-word tokens, references, verification.

Line order is an explicit line_idx within a file; nothing depends on the order of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.operators.corpus import global_positions

CONLLU = ("id", "form", "lemma", "upos", "xpos", "feats", "head", "deprel", "deps", "misc")
# Fixed values of the default sentence splitter: enders, starters that begin the next sentence, longest sentence in words.
ENDERS, STARTERS, LONGEST = ".?!", "¿¡", 250


def sentences(df: DataFrame, key: str = "doc_id", text: str = "text", longest: int = LONGEST) -> DataFrame:
    """key, sent (from 0) and sentence: split after . ? ! and before ¿ ¡, at line ends, and each `longest` words."""
    return df.select(key, F.posexplode(sentence_list(text, longest)).alias("sent", "sentence"))


def sentence_list(text: str = "text", longest: int = LONGEST) -> Column:
    """The sentences of a text as one array.

    White space is mended where a text has other than single spaces and line ends, and the text is split once as a whole: where white
    space follows an ender, comes before a starter or has a line end. Only a sentence long enough to have more than `longest` words is
    taken apart.
    """
    text = F.col(text) if isinstance(text, str) else text
    other = reduce(or_, (text.contains(c) for c in ("  ", "\t", "\x0b", "\f", "\r")))
    mended = F.trim(F.when(other, F.regexp_replace(text, r"[\t\x0B\f\r][ \t\x0B\f\r]*| [ \t\x0B\f\r]+", " ")).otherwise(text))
    parts = F.split(mended, rf"[ \n](?:(?<=[{ENDERS}][ \n]|\n)[ \n]*|\n[ \n]*|(?=[{STARTERS}]))")
    cut = lambda s: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(F.split(s, " ")) - 1) / longest).cast("int")),
        lambda i: F.array_join(F.slice(F.split(s, " "), i * longest + 1, F.lit(longest)), " "),
    )
    return F.flatten(F.transform(F.filter(parts, lambda s: s != ""), lambda s: F.when(F.octet_length(s) <= 2 * longest, F.array(s)).otherwise(cut(s))))


def words_of(sentence: Column) -> Column:
    """Words, numbers with their points, and single other marks."""
    return F.regexp_extract_all(sentence, F.lit(r"[\p{L}\p{M}]+(?:['’-][\p{L}\p{M}]+)*|\p{N}+(?:[.,]\p{N}+)*|[^\s\p{L}\p{M}\p{N}]"), F.lit(0))


def tokens(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, sent, pos (from 1) and word."""
    return sentences(df, key, text).select(key, "sent", F.posexplode(words_of(F.col("sentence"))).alias("pos", "word")).withColumn("pos", F.col("pos") + 1)


def class_of(word: Column) -> Column:
    """The default annotator's class of a token. What begins with a letter or digit of ASCII is known by its first byte."""
    short = F.when(F.char_length(word) <= 3, "ADP").otherwise("NOUN")
    return (
        F.when((word >= "a") & (word < "{"), short).when((word >= "A") & (word < "["), "PROPN").when((word >= "0") & (word < ":"), "NUM")
        .when(word.rlike(r"^\p{N}"), "NUM").when(word.rlike(r"^[^\p{L}\p{M}\p{N}]"), "PUNCT").when(word.rlike(r"^\p{Lu}"), "PROPN").otherwise(short)
    )


def annotate(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The default annotator: tokens with lemma (lower case), upos, head (the word before) and deprel."""
    t = tokens(df, key, text)
    return t.select(key, "sent", "pos", "word", F.lower("word").alias("lemma"), class_of(F.col("word")).alias("upos"), (F.col("pos") - 1).alias("head"), F.when(F.col("pos") == 1, "root").otherwise("dep").alias("deprel"))


def size_route(text: Column, units: Column, big: int = 10_000, chunk: int = 1_000, most: int = 8) -> tuple[Column, Column]:
    """How an annotator takes a document: `whole` under `big` bytes, else `bulk` groups or single `units`; and the number of groups."""
    size = F.octet_length(text)
    groups = F.ceil(size / chunk).cast("long")
    route = F.when(size < big, "whole").when(size / F.least(groups, units) <= chunk * most, "bulk").otherwise("units")
    return route, F.when(size < big, F.lit(1).cast("long")).otherwise(F.least(groups, units.cast("long")))


def render_conllu(tokens_: DataFrame, key: str) -> DataFrame:
    """key, line_idx and value: comment and token lines of each document, a blank line after each sentence.

    Each token carries the lines around it; a running count numbers them. One shuffle by document, and no document is held as a whole. Where
    documents are rows already, conllu_texts shuffles no token.
    """
    w = W.partitionBy(key).orderBy("sent", "pos")
    row = F.concat_ws("\t", F.col("pos").cast("string"), "word", "lemma", "upos", F.lit("_"), F.lit("_"), F.col("head").cast("string"), "deprel", F.lit("_"), F.lit("_"))
    t = tokens_.select(key, "sent", "pos", row.alias("_row"), F.row_number().over(w).alias("_i"), F.lag("sent").over(w).alias("_old"), F.lead("sent").over(w).alias("_new"))
    parts = F.array(
        F.when(F.col("_i") == 1, F.concat(F.lit("# newdoc id="), F.col(key).cast("string"))), F.when(~F.col("_old").eqNullSafe(F.col("sent")), F.concat(F.lit("# sent_id = "), F.col("sent").cast("string"))),
        F.col("_row"), F.when(~F.col("_new").eqNullSafe(F.col("sent")), ""))
    t = t.select(key, "sent", "pos", "_i", F.filter(parts, lambda x: x.isNotNull()).alias("_lines"))
    before = F.sum(F.size("_lines")).over(W.partitionBy(key).orderBy("sent", "pos", "_i").rowsBetween(W.unboundedPreceding, 0)) - F.size("_lines")
    t = t.withColumn("_before", before).select(key, "_before", F.posexplode("_lines").alias("_k", "value"))
    return t.select(key, (F.col("_before") + F.col("_k")).cast("int").alias("line_idx"), "value")


def conllu_texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and value: the lines that render_conllu gives each document of the default annotator, as one text without a last line end.

    A document is a row from its text on, so nothing is shuffled. One without tokens, which is one of white space, gives no row.
    """
    tab, end = F.lit("\t"), F.lit("\n")
    line = lambda w, i: F.concat((i + 1).cast("string"), tab, w, tab, F.lower(w), tab, class_of(w), F.lit("\t_\t_\t"), i.cast("string"), F.when(i == 0, "\troot\t_\t_").otherwise("\tdep\t_\t_"))
    sentence = lambda s, k: F.concat(F.lit("# sent_id = "), k.cast("string"), end, F.array_join(F.transform(words_of(s), line), "\n"), end)
    head = F.concat_ws("", F.lit("# newdoc id="), F.col(key).cast("string"), end)
    body = F.array_join(F.transform(sentence_list(text), sentence), "\n")
    return df.filter(F.col(text).rlike(r"\S")).select(key, F.concat(head, body).alias("value"))


def text_lines(texts: DataFrame, key: str = "doc_id", value: str = "value") -> DataFrame:
    """key, line_idx and value: the lines of texts that are whole."""
    return texts.select(key, F.posexplode(F.split(value, "\n")).alias("line_idx", "value"))


def line_kind(value: Column) -> Column:
    return (
        F.when((value >= "0") & (value < ":"), "token").when(value.startswith("# newdoc"), "doc").when(value.startswith("# sent_id"), "sent").when(value.startswith("# text"), "text")
        .when(value.startswith("#"), "meta").when(F.trim(value) == "", "blank").otherwise("unknown")
    )


def _is_token(kind: Column) -> Column:
    """Whether a line is a token's; a line of no known kind is an error."""
    return F.when(kind == "token", True).when(kind == "unknown", F.raise_error(F.lit("a line is neither comment nor token")).cast("boolean")).otherwise(False)


def _token_columns(columns: tuple[str, ...] = CONLLU) -> list[Column]:
    """These columns of a token's line, which is taken apart no further than the last of them."""
    places = [CONLLU.index(c) for c in columns]
    parts = F.split("value", "\t", max(places) + 2)
    return [F.get(parts, F.lit(i)).alias(c) for i, c in zip(places, columns, strict=True)]


def parse_conllu(lines: DataFrame, file: str = "file") -> DataFrame:
    """file, line_idx, doc_seq and sent_seq (from 0; sentences count anew in each document) and the ten columns of token lines.

    Lines are brought together by file. Where files are whole texts, parse_conllu_texts shuffles no line.
    """
    order = W.partitionBy(file).orderBy("line_idx")
    kinds = lines.withColumn("kind", line_kind(F.col("value")))
    so_far = lambda kind: F.sum((F.col("kind") == kind).cast("int")).over(order)
    seq = kinds.withColumn("doc_seq", so_far("doc") - 1).withColumn("_sents", so_far("sent"))
    before = F.last(F.when(F.col("kind") == "doc", F.col("_sents")), ignorenulls=True).over(order)  # sentences of the documents before
    seq = seq.withColumn("sent_seq", F.col("_sents") - F.coalesce(before, F.lit(0)) - 1)
    return seq.filter(_is_token(F.col("kind"))).select(file, "line_idx", "doc_seq", "sent_seq", *_token_columns())


def parse_conllu_texts(texts: DataFrame, file: str = "file", value: str = "value", columns: tuple[str, ...] = CONLLU) -> DataFrame:
    """What parse_conllu gives of lines, of files that are whole texts; line_idx is a line's place in its sentence. columns: those of the
    ten that are asked for.

    A text is taken apart at the lines that begin documents, a document at those that begin sentences, so a piece's place is its number.
    """
    apart = lambda c, start: F.posexplode(F.split(c, rf"\n(?=# {start})"))
    docs = texts.select(file, apart(F.concat(F.lit("\n"), value), "newdoc").alias("_doc", "_text"))
    sents = docs.select(file, (F.col("_doc") - 1).cast("long").alias("doc_seq"), apart("_text", "sent_id").alias("_sent", "_text"))
    lines = sents.select(file, "doc_seq", (F.col("_sent") - 1).cast("long").alias("sent_seq"), F.posexplode(F.split("_text", "\n")).alias("line_idx", "value"))
    return lines.filter(_is_token(line_kind(F.col("value")))).select(file, "line_idx", "doc_seq", "sent_seq", *_token_columns(columns))


def splice_multiword(rows: DataFrame, keys: list[str], together: bool = False, columns: tuple[str, ...] = CONLLU) -> DataFrame:
    """Token rows (line_idx and those of the ten columns that are asked for, id among them) with each multi-word range and its members as one row. keys name the sentence.

    Form and misc come from the range's row, the other columns join the members' values by comma, or keep the one value that all
    share. A range ends at its last member, at the next range or with the sentence; one without members stays as it is.
    together: the rows of a sentence stand together and in order already, as they do where they were made of it; nothing is shuffled
    then. Whole batches are spliced at once, by places of ranges.
    """
    named = [*keys, "line_idx", *columns]
    marked = rows.select(*keys, F.col("line_idx").cast("long"), *columns)
    if not together:
        marked = marked.repartition(*keys).sortWithinPartitions(*keys, "line_idx")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if held is not None:
                batch = pa.concat_batches([held, batch])
            starts = _sentence_starts(batch, keys)
            if len(starts):  # what may go on in the next batch waits for it
                held = batch.take(pa.array(np.arange(starts[-1], batch.num_rows)))  # a copy, so that the batch can go
                if starts[-1]:
                    yield _spliced(batch.slice(0, starts[-1]), starts[:-1], named)
        if held is not None:
            yield _spliced(held, np.zeros(1, np.int64), named)

    return marked.mapInArrow(run, marked.schema)


def _differ(c: pa.Array) -> np.ndarray:
    """Whether each value but the first is another than the one before it; nulls are equal."""
    a, b = c.slice(1), c.slice(0, max(len(c) - 1, 0))
    same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
    return ~same.to_numpy(zero_copy_only=False)


def _numbers(c: pa.Array) -> np.ndarray:
    """Whole numbers of strings, as a cast gives them; -1 for what is none."""
    fits = pc.fill_null(pc.match_substring_regex(c, r"^[\x00-\x20]*\+?0*[0-9]{1,10}[\x00-\x20]*$"), False)
    digits = pc.if_else(fits, pc.utf8_trim(c, "".join(map(chr, range(33))) + "+"), "-1")
    found = pc.cast(digits, pa.int64()).to_numpy(zero_copy_only=False)
    return np.where(found < 1 << 31, found, -1)


def _sentence_starts(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """The places of the first rows of sentences: another key, or a smaller line_idx."""
    if not batch.num_rows:
        return np.zeros(0, np.int64)
    at = batch.column("line_idx").to_numpy(zero_copy_only=False)
    new = at[1:] < at[:-1]
    for k in keys:
        new = new | _differ(batch.column(k))
    return np.flatnonzero(np.r_[True, new])


def _spliced(batch: pa.RecordBatch, starts: np.ndarray, named: list[str]) -> pa.RecordBatch:
    """The rows of whole sentences, spliced. starts: the places of their first rows."""
    n = batch.num_rows
    at = np.arange(n)
    ids = batch.column("id")
    is_range = pc.fill_null(pc.match_substring(ids, "-"), False).to_numpy(zero_copy_only=False)
    spans = pc.extract_regex(ids.filter(pa.array(is_range)), r"^(?P<a>[0-9]+)-(?P<b>[0-9]+)$")
    limits = np.full((2, n), -1)
    limits[:, is_range] = [_numbers(pc.struct_field(spans, k)) for k in "ab"]
    own = np.where(is_range, -1, _numbers(pc.if_else(pa.array(is_range), None, ids)))
    begin = np.repeat(starts, np.diff(np.r_[starts, n]))
    head = np.maximum.accumulate(np.where(is_range, at, -1))  # the last range so far
    inside = (own >= 0) & (head >= begin) & (limits[:, head] >= 0).all(axis=0) & (limits[0, head] <= own) & (own <= limits[1, head])
    members, source = np.flatnonzero(inside), at.copy()
    first = np.flatnonzero(np.r_[True, np.diff(head[members]) > 0][: len(members)])
    source[head[members][first]] = n + np.arange(len(first))
    kept, whole = pa.array(source[~inside]), pa.array(at[~inside])
    lists = pa.array(np.r_[first, len(members)], pa.int32())

    def column(name: str) -> pa.Array:
        c = batch.column(name)
        if name not in CONLLU or name in ("form", "misc") or not len(members):
            return c.take(whole)
        values = c.take(pa.array(members))
        other = np.r_[False, _differ(values)]
        other[first] = False
        several = pa.array(np.add.reduceat(other, first, dtype=np.int64) > 0)
        joined = pc.binary_join(pa.ListArray.from_arrays(lists, pc.fill_null(values, "")), ",")
        return pa.concat_arrays([c, pc.if_else(several, joined, values.take(pa.array(first)))]).take(kept)

    return pa.RecordBatch.from_arrays([column(c) for c in named], names=named)


def read_tagged(lines: DataFrame, file: str = "file") -> DataFrame:
    """file, doc_seq, tag and body of each <doc …> … </doc> in lines(file, line_idx, value); an unclosed last one counts."""
    order = W.partitionBy(file).orderBy("line_idx")
    t = lines.withColumn("doc_seq", F.sum(F.col("value").startswith('<doc id="').cast("int")).over(order) - 1).filter("doc_seq >= 0")
    part = F.array_sort(F.collect_list(F.struct("line_idx", "value")))
    docs = t.groupBy(file, "doc_seq").agg(part.alias("l"))
    body = F.filter(F.transform(F.slice("l", F.lit(2), F.greatest(F.size("l") - 1, F.lit(0))), lambda x: x["value"]), lambda v: v != "</doc>")
    return docs.select(file, "doc_seq", F.col("l")[0]["value"].alias("tag"), F.array_join(body, "\n").alias("body"))


def number_documents(docs: DataFrame, order: list[str], start: int = 1, random: bool = False) -> DataFrame:
    """ref: a count over all files from `start` on, or a random identifier."""
    if random:
        return docs.withColumn("ref", F.expr("uuid()"))
    return global_positions(docs, order, "ref").withColumn("ref", F.col("ref") + start)


def update_tag(tag: Column, values: dict[str, Column], name: str = "doc", first: tuple[str, ...] = ("id", "file_id", "ref")) -> Column:
    """A start tag with some attributes set, others kept; `first` go first."""
    kept = F.map_filter(T.tag_attributes(tag), lambda k, v: ~k.isin(*values))
    new = F.create_map(*(x for n, v in values.items() for x in (F.lit(n), v.cast("string"))))
    return T.start_tag(F.map_concat(kept, new), name, first)


def wrap_files(lines: DataFrame, names: DataFrame, file: str = "file") -> DataFrame:
    """Lines of each file between <docx ref name> and </docx>; such lines that are there already go first.

    names: file, ref, name.
    """
    inside = lines.filter(~F.col("value").rlike("^</?docx")).select(file, F.col("line_idx").cast("long"), "value")
    tag = T.start_tag(F.create_map(F.lit("ref"), F.col("ref").cast("string"), F.lit("name"), "name"), "docx", ("ref",))
    heads = names.select(file, F.lit(-1).cast("long").alias("line_idx"), tag.alias("value"))
    tails = names.select(file, F.lit((1 << 62)).cast("long").alias("line_idx"), F.lit("</docx>").alias("value"))
    return heads.unionByName(inside).unionByName(tails)


def add_sentence_language(lines: DataFrame, languages: DataFrame, file: str = "file") -> DataFrame:
    """Vertical lines with lang set in the <s …> tags that languages(file, line_idx, lang) names; others stay."""
    found = lines.join(languages.select(file, "line_idx", "lang"), [file, "line_idx"], "left")
    changed = update_tag(F.col("value"), {"lang": F.col("lang")}, "s", ("id",))
    return found.withColumn("value", F.when(F.col("lang").isNotNull() & F.col("value").rlike(r"^<s[ >]"), changed).otherwise(F.col("value"))).drop("lang")


def verify_counts(*formats: DataFrame, file: str = "file") -> DataFrame:
    """file, the least and the largest count of documents, and whether all formats (each: file, value of start lines) agree."""
    counts = None
    for k, f in enumerate(formats):
        n = f.groupBy(file).agg(F.count("*").alias("n")).withColumn("format", F.lit(k))
        counts = n if counts is None else counts.unionByName(n)
    out = counts.groupBy(file).agg(F.min("n").alias("least"), F.max("n").alias("most"), F.count("*").alias("formats"))
    return out.select(file, "least", "most", ((F.col("least") == F.col("most")) & (F.col("formats") == len(formats))).alias("ok"))


def glue(tokens_: DataFrame, keys: list[str], start: str = "start", finish: str = "finish") -> DataFrame:
    """glued: whether a token begins where the one before it ends (or earlier). Where sentences are rows already, count_glued shuffles no
    token."""
    before = F.lag(finish).over(W.partitionBy(*keys).orderBy("pos"))
    return tokens_.withColumn("glued", F.coalesce(F.col(start) <= before, F.lit(False)))


def count_glued(items: Column, start: Callable[[Column, Column], Column], size: Callable[[Column], Column]) -> Column:
    """How many tokens of a sentence, which is an array, glue marks. start(item, end): where a token starts, given where the one before it
    ends (null for the first); size(item): how long it is."""
    number = lambda c: c.cast("long")
    none = F.lit(None).cast("long")
    marked = lambda a: a["n"] + F.when(a["start"] <= a["before"], 1).otherwise(0)

    def step(a: Column, item: Column) -> Column:
        end = a["start"] + a["size"]
        return F.struct(number(start(item, end)).alias("start"), number(size(item)).alias("size"), end.alias("before"), number(marked(a)).alias("n"))

    zero = F.struct(none.alias("start"), none.alias("size"), none.alias("before"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(items, zero, step, marked)


def proper_noun(word: Column, initial: Column, known: Column) -> Column:
    """Capitalised words that are neither sentence-initial nor in the dictionary."""
    return word.rlike(r"^\p{Lu}") & (~initial | ~known)


def files_in_order(df: DataFrame, name: str = "name") -> DataFrame:
    """Ordered by the number before the file's suffixes."""
    return df.orderBy(F.regexp_extract(name, r"\.(\d+)\.", 1).try_cast("int"), name)
