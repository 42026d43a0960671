"""Operators on sentences that are rows already: what they give, and that no token is shuffled."""

import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from textmill.operators import compare as C
from textmill.operators import segments as G

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def sentences():
    r = random.Random(5)
    return [("".join(r.choices("DSPANVOXCF", k=r.choice((0, 1, 2, 5, 40)))), k) for k in range(300)]


def numbers(letters: str, pattern: str) -> list:
    out = [None] * len(letters)
    for k, m in enumerate(re.finditer(pattern, letters)):
        if len(m[0]) > 1:
            out[m.start() : m.end()] = [k] * len(m[0])
    return out


def test_phrase_numbers(spark, sentences):
    df = spark.createDataFrame(sentences, "letters string, k int")
    got = df.select("letters", C.phrase_numbers(F.col("letters")).alias("n"), C.phrase_strings(F.col("letters")).alias("s")).collect()
    assert len(got) == 300
    for r in got:
        assert r["n"] == numbers(r["letters"], C.PHRASE)
        assert r["s"] == [x for x in re.findall(f"({C.PHRASE})", r["letters"]) if len(x) > 1]


def test_rows_fill_as_tokens_do(spark, sentences):
    r = random.Random(6)
    rows = [(k, p + 1, c, r.choice(["M", "F", "C", "0", None]), r.choice("SPN0")) for s, k in sentences for p, c in enumerate(s)]
    found = C.phrases(spark.createDataFrame(rows, "k int, pos int, cls string, gender string, number string"), ["k"])
    want = {(x["k"], x["pos"]): (x["gender_filled"], x["number_filled"]) for x in C.fill_phrases(found, ["k"]).collect()}
    t = C.gather(found, ["k"])
    for i, (name, marks) in enumerate(C.OPEN.items()):
        values = t.select("k", F.posexplode(C.fill_runs(F.col("t")["phrase"], F.col("t")[name], *marks)).alias("at", "v")).collect()
        assert {(x["k"], x["at"] + 1): x["v"] for x in values} == {key: v[i] for key, v in want.items()}


def test_name_units(spark):
    t = [(1, "John", "john", "N"), (2, "of", "of", "P"), (3, "Gaunt", "gaunt", "N"), (4, "ran", "run", "V"), (5, "X", "x", "N")]
    df = spark.createDataFrame([(t, "CFCXC"), ([], ""), (t[3:4], "X")], "t array<struct<pos:int,word:string,lemma:string,tag:string>>, l string")
    got = [r[0] for r in df.select(G.name_units(F.col("t"), F.col("l"))).collect()]
    assert [tuple(x) for x in got[0]] == [(1, 3, "John_of_Gaunt", "john_of_gaunt", "NP00000"), (4, 1, "ran", "run", "V"), (5, 1, "X", "x", "N")]
    assert not got[1] and [tuple(x) for x in got[2]] == [(4, 1, "ran", "run", "V")]


@pytest.mark.parametrize("name", ["np_fill", "noun_phrases"])
def test_no_token_is_shuffled(spark, name):
    assert "Exchange" not in plan(entry.queries()[name](spark, SF))


@pytest.mark.parametrize("name", ["np_phrases", "name_joins"])
def test_only_counts_are_shuffled(spark, name):
    p = plan(entry.queries()[name](spark, SF))
    assert p.count("Exchange") == 1 and "Window" not in p and "Join" not in p


def test_rows_align_as_tokens_do(spark):
    from textmill.operators import align as A

    r = random.Random(7)
    docs = [(k, [(r.choice("abcde"), r.choice("NV")) for _ in range(r.choice((0, 1, 3, 12)))], [(r.choice("abcde"), r.choice("NV")) for _ in range(r.choice((0, 2, 12)))]) for k in range(60)]
    token = "array<struct<word:string,tag:string>>"
    df = spark.createDataFrame([*docs, (98, None, [("a", None)]), (99, [(None, "N")] * 30, [(None, "N")] * 29)], f"k long, left {token}, right {token}")
    each = lambda c: df.select("k", F.posexplode(c).alias("pos", "v")).select("k", "pos", "v.word", "v.tag")
    rows = lambda a: sorted(map(str, a.collect()))
    want = rows(A.align(each("left"), each("right"), "k"))
    assert len(want) > 50 and rows(A.align_rows(df, "k")) == want
    whole = A.align_rows(df, "k", cut=11)  # some go the other way
    assert rows(whole.groupBy("k").agg(F.sum("n_left"), F.sum("n_right"))) == rows(A.align_rows(df, "k").groupBy("k").agg(F.sum("n_left"), F.sum("n_right")))


@pytest.mark.parametrize("name", ["align_codes", "align_tokens"])
def test_short_documents_are_aligned_in_place(spark, name):
    p = plan(entry.queries()[name](spark, SF))
    assert p.count("Exchange") == 1 and "MapInArrow" in p and "Join" not in p


def test_sentences_are_spliced_in_place(spark):
    """Rows that stand together are spliced as shuffled ones are, over the ends of batches too, without a shuffle."""
    from textmill.operators import tokens as K

    r = random.Random(8)
    rows = []
    for s in range(90):
        ids, n = [], 1
        while n < r.randint(2, 30):
            ids += [f"{n}-{n + r.randint(0, 2)}"] if r.random() < 0.4 else ["x-y"] if r.random() < 0.1 else []
            ids.append(r.choice([str(n), str(n), str(n), f"{n}.1", None]))
            n += 1
        rows += [(None if s % 7 == 0 else s % 5, s, k, i, *(r.choice(["_", "a", None]) for _ in range(9))) for k, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "k long, sent int, line_idx long, " + ", ".join(f"{c} string" for c in K.CONLLU)).coalesce(1)
    want = sorted(map(str, K.splice_multiword(df.repartition(3), ["k", "sent"]).collect()))
    assert 90 < len(want) < len(rows)
    for most in ("1", "7", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", most)
        try:
            got = K.splice_multiword(df, ["k", "sent"], together=True)
            assert "Exchange" not in plan(got) and sorted(map(str, got.collect())) == want
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    p = plan(entry.queries()["mwt_splice"](spark, SF))
    assert "Exchange" not in p and "MapInArrow" in p


def test_tags_are_looked_up_in_place(spark):
    """Tokens do not meet by their tag, of which there are few."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(entry.queries()["lempos_table"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_codes_are_made_in_place(spark):
    assert "Exchange" not in plan(entry.queries()["diff_errors"](spark, SF))
