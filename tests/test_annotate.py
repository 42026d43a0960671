"""Annotator plug-ins with inline markup, deadlines of rows, and rules of names."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from textmill.__main__ import to_conll
from textmill.functions.deadline import map_with_deadline
from textmill.operators import annotate as N


class Double:
    """A test double: words between spaces, a sentence for each `.`; it must never see markup."""

    def analyze(self, texts):
        out = []
        for text in texts:
            assert "<" not in text and text.strip()
            sentences, now = [], []
            for m in re.finditer(r"[^\s.]+|\.", text):
                now.append(N.Token(m.start(), m.end(), m[0].lower(), "." if m[0] == "." else "N", len(now)))
                if m[0] == ".":
                    sentences.append(now)
                    now = []
            out.append([*sentences, now] if now else sentences)
        return out


def random_text(rng):
    parts = ["one", "two", ".", " ", "\n", "<b>", "</b>", "<i a='x > y'>", "<br/>", "<!-- - -->", "<p>", "</p>", '<s id="3">', "</s>", "é日", "Kin", " ", " "]
    return "".join(rng.choices(parts, k=rng.randint(0, 40)))


def test_tags_in_are_tags_out(spark):
    rng = random.Random(7)
    texts = [random_text(rng) for _ in range(120)] + [None, "", " \n", "<b></b>", "no markup . at all", "x " * 20_000]
    df = spark.createDataFrame([(f"k{i}", t, 1, "w") for i, t in enumerate(texts)], "`my id` string, text string, seq int, word string").repartition(3)
    rows = N.annotate(df, Double, "my id", batch_bytes=200).collect()
    by = {}
    for r in sorted(rows, key=lambda r: r.seq):
        by.setdefault(r["my id"], []).append(r)
    for i, t in enumerate(texts):
        got, t = by.get(f"k{i}", []), t or ""
        assert [r.seq for r in got] == list(range(len(got)))
        assert [r.word for r in got if r.kind != "token"] == [m[0] for m in re.finditer(N.MARKUP, t, re.S)]
        plain = re.sub(N.MARKUP, lambda m: "\n" if re.match("</?[ps][ >]", m[0]) else "", t)  # only structure tags part words
        assert [r.word for r in got if r.kind == "token"] == re.findall(r"[^\s.]+|\.", plain)
        sents = [r.sent for r in got if r.sent is not None]
        assert sents == sorted(sents) and set(sents) == set(range(len(set(sents))))
        for a, b in zip(got, got[1:]):  # a structure tag ends a sentence
            assert "break" not in (a.kind, b.kind) or a.sent is None or a.sent != b.sent
        glued = [r.word for r in got if r.glued]
        assert all(w == "." or re.search(rf"\.{re.escape(w)}|{re.escape(w)}", plain) for w in glued)


def test_tags_stand_where_they_stood(spark):
    df = spark.createDataFrame([(1, "<doc><b>One</b> two<br/>three. <i>Four</i>")], "doc_id long, text string")
    items = N.annotate(df, Double)
    lines = [r.value for r in N.vertical_lines(items).orderBy("seq", "part").collect()]
    assert lines == ["<doc>", "<s>", "<b>", "One\tN\tone", "</b>", "twothree\tN\ttwothree", "<br/>", "<g/>", ".\t.\t.", "</s>", "<s>", "<i>", "Four\tN\tfour", "</s>", "</i>"]


def test_conllu_with_an_annotator(spark, tmp_path):
    (tmp_path / "a.txt").write_text('<doc id="7" file_id="0" >\n<p>Red <b>cats</b> sat. Up\n</p>\n</doc>\n')
    values = [r.value for r in to_conll(spark, str(tmp_path), annotator=Double).orderBy("line_idx").collect()]
    assert values[0] == "# newdoc id=7 file_id=0"
    assert [v.split("\t")[1] for v in values if "\t" in v] == ["Red", "cats", "sat", ".", "Up"]
    assert [v for v in values if v.startswith("# sent")] == ["# sent_id = 0", "# sent_id = 1"]


def test_nothing_to_annotate(spark):
    assert N.annotate(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert N.annotate(spark.createDataFrame([(None, "a b")], "doc_id long, text string")).count() == 2


def test_rules_of_names(spark):
    cases = [  # word, tag, lemma, initial, guessed, known, then tag and lemma
        ("Paris", "NN", "Paris", False, False, True, "NP", "Paris"), ("Paris", "NNS", "paris", False, True, False, "NPS", "Paris"), ("Paris", "VB", "pari", False, False, False, "NP00000", "Paris"),
        ("Paris", "VB", "PARI", False, False, True, "VB", "pari"), ("The", "DT", "The", True, False, True, "DT", "the"), ("Zork", "NN", "zork", True, True, False, "NP", "Zork"),
        ("Zork", "JJ", "zork", True, True, True, "NP00000", "Zork"), ("zork", "NN", "Zork", False, True, False, "NN", "zork"), ("Zork", "NN", "zork", True, False, False, "NN", "zork"),
    ]
    df = spark.createDataFrame(cases, "word string, tag string, lemma string, initial boolean, guessed boolean, known boolean, t string, l string")
    tag, lemma = N.proper_noun_tags(*(F.col(c) for c in ("word", "tag", "lemma", "initial", "guessed", "known")))
    assert df.filter((tag != F.col("t")) | (lemma != F.col("l"))).count() == 0
    table = spark.createDataFrame([("NN", "n"), ("NN", "n"), ("VB", "v")], "tag string, pos string")
    assert sorted((r.tag, r.pos_letter) for r in N.with_pos(df.select("tag").distinct(), table).collect()) == [("DT", "x"), ("JJ", "x"), ("NN", "n"), ("NNS", "x"), ("VB", "v")]


def _slow():
    seen = []

    def work(n):
        seen.append(n)
        if n == 3:
            time.sleep(60)
        if n == 5:
            raise ValueError("five")
        if n == 7:
            import os

            os._exit(9)
        print("noise", n)
        return n * 10 + len(seen) * 0

    return work


def test_deadlines(spark):
    df = spark.createDataFrame([(n, "x") for n in [*range(10), None]], "n long, text string").coalesce(1)
    before = time.time()
    got = {r.n: (r.result, r.error) for r in map_with_deadline(df, "n", _slow, 1.5, LongType()).collect()}
    assert time.time() - before < 40
    assert got.pop(3) == (None, "timeout after 1.5 s")
    assert got.pop(5) == (None, "ValueError: five")
    assert got.pop(7) == (None, "the process ended with code 9")
    assert got == {n: (n * 10, None) for n in (0, 1, 2, 4, 6, 8, 9)} | {None: (None, None)}
    assert map_with_deadline(df.limit(0), "n", _slow, 1.5, LongType()).collect() == []


def test_large_values_and_a_child_that_cannot_start(spark):
    df = spark.createDataFrame([("y" * 3_000_000,), ("",)], "text string")
    assert sorted(r.result for r in map_with_deadline(df, "text", lambda: str.upper, 20).collect()) == ["", "Y" * 3_000_000]

    def broken():
        raise OSError("no model")

    with pytest.raises(Exception, match="no model"):
        map_with_deadline(df, "text", broken, 5).collect()
