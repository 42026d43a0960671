"""Documents that are rows already: how they are split, rendered and read again, and that no token is shuffled."""

import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from textmill.operators import tokens as K

SF = "/root/testdata/sf0.001"
WHITE = " \t\n\x0b\f\r"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df) -> list:
    return sorted(map(str, df.collect()))


def sentences(text: str, longest: int) -> list[str]:
    """One replacement after the other, as the SQL has it."""
    marked = re.sub(rf"[{WHITE}]+([¿¡])", r"\n\1", re.sub(rf"([.?!]+)[{WHITE}]+", r"\1\n", text))
    parts = [re.sub(f"[{WHITE}]+", " ", p).strip(" ") for p in marked.split("\n")]
    return [" ".join(p.split(" ")[i : i + longest]) for p in parts if p for i in range(0, len(p.split(" ")), longest)]


@pytest.fixture(scope="module")
def texts():
    r = random.Random(9)
    pieces = ["a", "Bc", "éa", "Ñu", "b", "٣", "12", "1.5", "…", "...", "?", "!", ".", ",", "¿", "¡", "x-y", " ", " ", "́", "#", *WHITE, " ", "  ", "\r\n", " \n ", "\n\n"]
    return [None, "", " \n\t", "# newdoc", *("".join(r.choices(pieces, k=r.choice((1, 3, 12, 60)))) for _ in range(400))]


@pytest.mark.parametrize("longest", [2, 250])
def test_sentences(spark, texts, longest):
    long = ["w " * 249 + "w", "w " * 250 + "w", "ab " * 777, "w." * 300]
    df = spark.createDataFrame([(t,) for t in [*texts, *long]], "text string")
    got = df.select("text", K.sentence_list("text", longest).alias("s")).collect()
    assert len(got) == len(texts) + len(long)
    for r in got:
        assert r.s == (None if r.text is None else sentences(r.text, longest))


def test_classes(spark):
    words = ["a", "z", "zoo", "zoos", "{", "`", "A", "Z", "Zoo", "[", "@", "0", "9", "9a", ":", "/", "é", "É", "éclair", "٣", "…", "́a", "ǅ", "日本", "日本日本", "", None]
    w = F.col("w")
    want = F.when(w.rlike(r"^\p{N}"), "NUM").when(w.rlike(r"^[^\p{L}\p{M}\p{N}]"), "PUNCT").when(w.rlike(r"^\p{Lu}"), "PROPN").when(F.char_length(w) <= 3, "ADP").otherwise("NOUN")
    for r in spark.createDataFrame([(x,) for x in words], "w string").select("w", K.class_of(w).alias("got"), want.alias("want")).collect():
        assert r.got == r.want, r


def test_texts_have_the_lines_of_tokens(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = rows(K.render_conllu(K.annotate(df), "doc_id"))
    assert len(want) > 1000 and rows(K.text_lines(K.conllu_texts(df))) == want


def test_texts_are_read_as_lines_are(spark):
    r = random.Random(10)
    kinds = ["# newdoc id=1", "# newdoc", "# sent_id = 2", "# sent_id", "# text = x", "#", "# other", "", "  ", "1\ta\tb\tc", "2-3\tde", "10\t" + "\t".join("abcdefghi"), "4\t # sent_id\r\tx\t\t", "5\t# newdoc"]
    files = [(k, r.choices(kinds, k=r.choice((0, 1, 5, 40)))) for k in range(120)]
    texts = spark.createDataFrame([*((k, "\n".join(f)) for k, f in files), (999, None)], "file long, value string")
    lines = spark.createDataFrame([(k, i, v) for k, f in files for i, v in enumerate(f)], "file long, line_idx long, value string")
    got, want = K.parse_conllu_texts(texts), K.parse_conllu(lines)
    assert len(rows(want)) > 300 and rows(got.drop("line_idx")) == rows(want.drop("line_idx"))
    some = ("form", "id", "upos")
    assert rows(K.parse_conllu_texts(texts, columns=some).drop("line_idx")) == rows(want.select("file", "doc_seq", "sent_seq", *some))
    order = [(x.line_idx, x.id) for x in K.parse_conllu_texts(spark.createDataFrame([(1, "# sent_id\n# text\n1\ta\n2\tb")], texts.schema)).collect()]
    assert order == [(2, "1"), (3, "2")]
    with pytest.raises(Exception, match="neither comment nor token"):
        K.parse_conllu_texts(spark.createDataFrame([(1, "1\ta\nnone")], texts.schema)).collect()


def test_glued_tokens_are_counted_as_they_are_marked(spark):
    r = random.Random(11)
    spans = []
    for k in range(200):
        at, s = 0, []
        for _ in range(r.choice((0, 1, 2, 20))):
            start = None if r.random() < 0.1 else at + r.choice((-1, 0, 0, 1, 2))
            s.append((start, r.randint(0, 5)))
            at = (start or 0) + s[-1][1]
        spans.append((k, s))
    df = spark.createDataFrame(spans, "k long, s array<struct<start:int,size:int>>")
    t = df.select("k", F.posexplode("s").alias("pos", "x")).select("k", "pos", "x.start", (F.col("x.start") + F.col("x.size")).alias("finish"))
    want = {x.k: x.n for x in K.glue(t, ["k"]).groupBy("k").agg(F.count_if("glued").alias("n")).collect()}
    got = {x.k: x.n for x in df.select("k", K.count_glued(F.col("s"), lambda x, end: x["start"], lambda x: x["size"]).alias("n")).collect()}
    assert len(got) == 200 and sum(got.values()) > 100 and got == {k: want.get(k, 0) for k in got}


def test_round_trip_shuffles_nothing(spark):
    p = plan(entry.queries()["conllu_roundtrip"](spark, SF))
    assert "Exchange" not in p and "Window" not in p


@pytest.mark.parametrize("name", ["glue", "conllu_counts"])
def test_only_counts_are_shuffled(spark, name):
    p = plan(entry.queries()[name](spark, SF))
    assert "Window" not in p and "HashAggregate" in p.split("Exchange")[1].split("Exchange")[0] and p.count("Sort") == 0
