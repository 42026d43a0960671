"""Annotators as plug-ins, for texts with inline markup.

An annotator is made on the executors, one for each Python worker, and analyses lists of plain texts, some BATCH_BYTES at once.
Markup never reaches it: tags are cut out with their places before the analysis and put back between the tokens after it.
Structure tags (BREAKERS) end what is analysed at once, so no sentence goes across them.

Defined results: null and blank texts give their tags and no tokens; a tag inside a token goes after it; tags before a sentence's first
token stand inside the sentence, but structure tags stand outside; equal rows each give their rows, which then cannot be told
apart by the key; an empty table gives no rows.
"""

from __future__ import annotations

import operator
import re
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple, Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

BATCH_BYTES = 1_000_000
# What is markup, and the names of the tags that end a sentence.
MARKUP = r"""<!--.*?-->|<[!?/]?[^\W\d][\w:.-]*(?:\s+[^\W\d][\w:.-]*\s*=\s*(?:'[^']*'|"[^"]*"))*\s*/?\s*>"""
BREAKERS = ("doc", "p", "align", "s")


class Token(NamedTuple):
    """A token: its place in the text that was analysed (end exclusive) and what is known of it."""

    start: int
    end: int
    lemma: str
    tag: str
    head: int = 0
    deprel: str = "dep"


class Annotator(Protocol):
    """What a plug-in has to offer."""

    def analyze(self, texts: list[str]) -> list[list[list[Token]]]:
        """The sentences of each text, in order."""


class Rules:
    """An annotator without a model: words, numbers and single marks; sentences end at . ? ! or at a line end."""

    word = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*|\d+(?:[.,]\d+)*|[^\w\s]|_")

    def analyze(self, texts: list[str]) -> list[list[list[Token]]]:
        out, make = [], Token._make
        for text in texts:
            sentences, now, last = [], [], 0
            for m in self.word.finditer(text):
                w, (start, end) = m[0], m.span()
                if now and (now[-1][3] == "END" or text.find("\n", last, start) >= 0):
                    sentences.append(now)
                    now = []
                c = w[0]
                tag = ("PROPN" if c.isupper() else "WORD") if c.isalpha() else "NUM" if c.isdigit() else "END" if w in ".?!" else "PUNCT"
                now.append(make((start, end, w.lower(), tag, len(now), "dep" if now else "root")))
                last = end
            out.append([*sentences, now] if now else sentences)
        return out


def cut_markup(text: str, breakers: tuple[str, ...] = BREAKERS) -> Iterator[tuple[str, list[tuple[int, str]], str]]:
    """The parts of a text that are analysed at once: each part's plain text, its tags by place in it, and the structure tag that ends
    it (empty at the end of the text)."""
    ends = re.compile(rf"</?(?:{'|'.join(map(re.escape, breakers))})(?=[\s/>])")
    plain, tags, at, length = [], [], 0, 0
    for m in re.finditer(MARKUP, text, re.S):
        plain.append(text[at : m.start()])
        length += m.start() - at
        at = m.end()
        if ends.match(m[0]):
            yield "".join(plain), tags, m[0]
            plain, tags, length = [], [], 0
        else:
            tags.append((length, m[0]))
    yield "".join(plain) + text[at:], tags, ""


_MODELS: dict[str, Annotator] = {}


def _model(name: str, make: Callable[[], Annotator]) -> Annotator:
    """This worker's annotator; another one takes its place."""
    if name not in _MODELS:
        _MODELS.clear()
        _MODELS[name] = make()
    return _MODELS[name]


ITEM = (("seq", LongType()), ("sent", LongType()), ("pos", LongType()), ("kind", StringType()), ("word", StringType()), ("lemma", StringType()), ("tag", StringType()), ("head", LongType()), ("deprel", StringType()), ("glued", BooleanType()))


def annotate(df: DataFrame, make: Callable[[], Annotator] = Rules, key: str = "doc_id", text: str = "text", batch_bytes: int = BATCH_BYTES, breakers: tuple[str, ...] = BREAKERS) -> DataFrame:
    """key and the items of each text in the order of seq: kind token (word, lemma, tag, head, deprel, and whether it is glued to the
    one before), tag, or break (a structure tag). sent counts from 0 in a text."""
    name = uuid.uuid4().hex
    rows = df.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias("_text" if key != "_text" else "__text"))
    schema = StructType([StructField(key, rows.schema[0].dataType), *(StructField(n, t) for n, t in ITEM)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, arrow = _model(name, make), None

        def flush(held: list[tuple[object, list]]) -> pa.RecordBatch:
            plain = [p for _, parts in held for p, *_ in parts if p.strip()]
            found = iter(model.analyze(plain))
            columns: list[list] = [[] for _ in range(len(ITEM) + 1)]

            def add(n: int, *values: object) -> None:
                """n rows; a value that is no list holds for all of them."""
                for c, v in zip(columns, values, strict=True):
                    c.extend(v if isinstance(v, (list, tuple, range)) else [v] * n)

            for k, parts in held:
                seq = sent = 0
                for p, tags, end in parts:
                    sentences, at = next(found) if p.strip() else [], 0
                    for s, tokens in enumerate(sentences, sent):
                        if not tokens:
                            continue
                        starts, ends, lemmas, kinds, heads, deprels = zip(*tokens, strict=True)
                        glued = [False, *map(operator.le, starts[1:], ends)]
                        words = [p[x:y] for x, y in zip(starts, ends, strict=True)]
                        i, n = 0, len(tokens)
                        while i < n:  # the tokens up to the next tag, which goes before the first that starts at its place or later
                            while at < len(tags) and tags[at][0] <= starts[i]:
                                add(1, [k], seq, s, None, "tag", [tags[at][1]], None, None, None, None, False)
                                seq, at = seq + 1, at + 1
                            j = next((x for x in range(i, n) if starts[x] >= tags[at][0]), n) if at < len(tags) else n
                            add(j - i, [k] * (j - i), range(seq, seq + j - i), s, range(i + 1, j + 1), "token", words[i:j], lemmas[i:j], kinds[i:j], heads[i:j], deprels[i:j], glued[i:j])
                            seq, i = seq + j - i, j
                    for tag in [t for _, t in tags[at:]]:
                        add(1, [k], seq, None, None, "tag", [tag], None, None, None, None, False)
                        seq += 1
                    if end:
                        add(1, [k], seq, None, None, "break", [end], None, None, None, None, False)
                        seq += 1
                    sent += len(sentences)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

        held, size = [], 0
        for batch in batches:
            if arrow is None:
                kinds = {LongType: pa.int64(), StringType: pa.string(), BooleanType: pa.bool_()}
                arrow = pa.schema([pa.field(key, batch.schema.field(0).type), *(pa.field(n, kinds[type(t)]) for n, t in ITEM)])
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                t = t.as_py() or ""
                if held and size + len(t) > batch_bytes:
                    yield flush(held)
                    held, size = [], 0
                held.append((k, list(cut_markup(t, breakers))))
                size += len(t)
        if held:
            yield flush(held)

    return rows.mapInArrow(run, schema)


def tokens_of(items: DataFrame, key: str = "doc_id") -> DataFrame:
    """The tokens alone, as the CoNLL-U writer takes them."""
    return items.filter("kind = 'token'").select(key, "sent", "pos", "word", "lemma", F.col("tag").alias("upos"), "head", "deprel")


def vertical_lines(items: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, seq, part and value: vertical lines in the order of seq and part. A sentence stands between <s> and </s>, a token without
    a space before it behind <g/>."""
    w = W.partitionBy(key).orderBy("seq")
    first = F.col("sent").isNotNull() & ~F.coalesce(F.lag("sent").over(w) == F.col("sent"), F.lit(False))
    last = F.col("sent").isNotNull() & ~F.coalesce(F.lead("sent").over(w) == F.col("sent"), F.lit(False))
    value = F.when(F.col("kind") == "token", F.concat_ws("\t", "word", "tag", "lemma")).otherwise(F.col("word"))
    parts = F.array(F.when(first, "<s>"), F.when(F.col("glued"), "<g/>"), value, F.when(last, "</s>"))
    return items.select(key, "seq", parts.alias("parts")).select(key, "seq", F.posexplode(F.filter("parts", lambda x: x.isNotNull())).alias("part", "value"))


def proper_noun_tags(word: Column, tag: Column, lemma: Column, initial: Column, guessed: Column, known: Column) -> tuple[Column, Column]:
    """Tag and lemma after simple detection of names: a capitalised word keeps its form as its lemma and gets a tag of names if it begins a
    sentence and its analysis was guessed, or stands elsewhere and is a noun or not in the dictionary. Else the lemma is lower case."""
    upper, noun = word.rlike(r"^\p{Lu}"), tag.startswith("N")
    named, plain = F.concat(F.lit("NP"), tag.substr(3, 1 << 20)), F.lit("NP00000")
    new = F.when(upper & initial & guessed, F.when(noun, named).otherwise(plain)).when(upper & ~initial & noun, named).when(upper & ~initial & ~known, plain)
    return F.coalesce(new, tag), F.when(new.isNotNull(), word).otherwise(F.lower(lemma))


def with_pos(tokens: DataFrame, table: DataFrame, tag: str = "tag", default: str = "x") -> DataFrame:
    """pos_letter: what table(tag, pos) has for a token's tag, else the default. The table is a set of tags, so it goes to every task; by a
    shuffle all tokens of a tag would meet in one."""
    letters = table.select(F.col("tag").alias("_tag"), F.col("pos").alias("_pos")).dropDuplicates(["_tag"])
    return tokens.join(F.broadcast(letters), F.col(tag) == F.col("_tag"), "left").withColumn("pos_letter", F.coalesce("_pos", F.lit(default))).drop("_tag", "_pos")
