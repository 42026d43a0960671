"""Groups, batches and names against loops; attachments; incremental identification; counts on the way."""

import os
import random
import re

import duckdb
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from textmill.operators import corpus as O
from textmill.operators import langid as L
from textmill.operators import segments as S
from textmill.sources import attachments as A
from textmill.sources import files


def split_by(values, stop, most):
    """The loop: groups end with a stop, or when they are full."""
    out, group, size = [], 0, 0
    for v in values:
        out.append(group)
        size += 1
        if v == stop or size >= most:
            group, size = group + 1, 0
    return out


@pytest.mark.parametrize("most", [1, 2, 3, 7, 1000])
def test_capped_groups(spark, most):
    rng = random.Random(most)
    streams = {f"f{k}": rng.choices(["a\tb", "</s>", "<s>", None, "</s> "], weights=[6, 2, 1, 1, 1], k=rng.randint(1, 60)) for k in range(8)}
    rows = [(f, i * 2, v) for f, vs in streams.items() for i, v in enumerate(vs)]
    rng.shuffle(rows)
    got = S.capped_groups(spark.createDataFrame(rows, "file string, line_idx long, value string"), most=most).collect()
    for f, vs in streams.items():
        assert [r.group for r in sorted((r for r in got if r.file == f), key=lambda r: r.line_idx)] == split_by(vs, "</s>", most)
    assert S.capped_groups(spark.createDataFrame([], "file string, line_idx long, value string")).collect() == []


@pytest.mark.parametrize("most", [1, 3])
def test_sentence_batches(spark, most):
    values = ["<doc>", "<s>", "a", "</s>", '<s id="1">', "<span>", "b", "</s>", "<g/>", "<s>", "</s>", "<s>", "c", "</s>", "</doc>"]
    batch, held, want = 0, 0, []
    for v in values:
        if v.startswith(("<s>", "<s ")):
            if held == most:
                batch, held = batch + 1, 0
            held += 1
        want.append(batch)
    df = spark.createDataFrame([("f", i, v) for i, v in enumerate(values)], "file string, line_idx long, value string")
    assert [r.batch for r in S.sentence_batches(df, most=most).orderBy("line_idx").collect()] == want


def walk(classes):
    """The automaton by hand: from each capital the longest walk over function words that ends in a capital."""
    out, i = [], 0
    while i < len(classes):
        end = i
        if classes[i] == "C":
            j = i + 1
            while j < len(classes) and classes[j] in "CF":
                if classes[j] == "C":
                    end = j
                j += 1
        out.append((i, end - i + 1))
        i = end + 1
    return out


def test_names(spark):
    rng = random.Random(3)
    sents = ["".join(rng.choices("CFX", k=rng.randint(1, 15))) for _ in range(150)] + ["C" + "F" * 5, "CFFFC", "FCF", "CC", "X"]
    rows = [(s, p + 1, f"W{p}", f"w{p}", "T", c, "extra") for s, cs in enumerate(sents) for p, c in enumerate(cs)]
    df = spark.createDataFrame(rows, "sent long, pos int, word string, lemma string, tag string, cls string, size string").repartition(4)
    got = S.join_names(df, ["sent"]).collect()
    for s, cs in enumerate(sents):
        mine = sorted((r.pos, r["size"], r.word, r.lemma, r.tag) for r in got if r.sent == s)
        assert mine == [(i + 1, n, "_".join(f"W{k}" for k in range(i, i + n)), "_".join(f"w{k}" for k in range(i, i + n)), "NP00000" if n > 1 else "T") for i, n in walk(cs)]
        found = [m.span() for m in re.finditer(S.NAME, cs) if m.end() - m.start() > 1]  # the same by a pattern
        assert found == [(i, i + n) for i, n in walk(cs) if n > 1]
    assert S.join_names(df.limit(0), ["sent"]).collect() == []


def test_name_classes(spark):
    rows = [("Bank", "NN", False, True, None, "C"), ("Of", "IN", True, True, None, "F"), ("of", "IN", False, True, None, "F"), ("The", "DT", True, False, None, "C"), ("Bank", "NN", True, True, None, "X"), ("Bank", "NN", False, True, "Fp", "X"), ("cat", "NN", False, True, None, "X"), ("Ünal", "NN", False, False, "Fp", "C")]
    df = spark.createDataFrame(rows, "word string, tag string, initial boolean, known boolean, after string, want string")
    cls = S.name_class(F.col("word"), F.col("tag"), F.col("initial"), F.col("known"), F.col("after"))
    assert df.filter(cls != F.col("want")).count() == 0


def test_rate():
    now, waits = [0.0], []

    def sleep(s):
        waits.append(s)
        now[0] += s

    bucket = A.Bucket(2.0, 3, lambda: now[0], sleep)
    for _ in range(7):
        bucket.take()
    assert waits == [0.5] * 4
    now[0] += 100
    waits.clear()
    for _ in range(4):
        bucket.take()
    assert waits == [0.5]


def _answers():
    held = {"u1": (200, b"one"), "u2": (404, b""), "u4": (200, b"")}

    def fetch(url):
        if url == "u3":
            raise OSError("no route")
        return held[url]

    return fetch


def _blocks():
    def read(content):
        if content == b"slow":
            import time

            time.sleep(30)
        if content == b"bad":
            raise ValueError("no file of this kind")
        return content.decode().split("|")

    return read


def test_attachments(spark, tmp_path):
    """Plan, fetch, list, extract: what is there in the right length is not fetched, what has a text is not extracted."""
    rows = [(k, f"u{k}" if k < 5 else None, n) for k, n in ((1, 3), (2, 9), (3, 9), (4, 0), (5, 1), (6, 2))]
    attached = spark.createDataFrame(rows, "file_id long, url string, filesize long")
    present = spark.createDataFrame([(6, 2), (1, 2)], "file_id long, length long")
    plan = O.download_plan(attached, present)
    assert {r.file_id for r in plan.collect()} == {1, 2, 3, 4, 5}
    got = {r.file_id: (r.status, r.length, r.content and bytes(r.content)) for r in A.fetch_files(plan, _answers, rate=1000, tasks=2).collect()}
    assert got == {1: ("ok", 3, b"one"), 2: ("404", None, None), 3: ("OSError: no route", None, None), 4: ("ok", 0, b""), 5: ("no address", None, None)}
    for name, data in (("a", b"x|y"), ("b", b"slow"), ("c", b"bad"), ("d", b"old"), ("e", b"  ")):
        (tmp_path / f"{name}.pdf").write_bytes(data)
    listed = files.list_files(spark, str(tmp_path))
    contents = spark.read.format("binaryFile").load(str(tmp_path)).select("path", "content").join(listed, "path").select("stem", "content").coalesce(1)
    texts = spark.createDataFrame([("d", "text of d")], "stem string, text string")
    done = {r.stem: (r.text, r.error) for r in A.extract_texts(contents, _blocks, texts, seconds=1.5).collect()}
    assert done == {"a": ("x\ny", None), "b": (None, "timeout after 1.5 s"), "c": (None, "ValueError: no file of this kind"), "e": (None, None)}
    assert A.extract_texts(contents.filter("stem = 'd'"), _blocks, texts, overwrite=True, seconds=20).first().text == "old"


def test_texts_by_path(spark, tmp_path):
    os.makedirs(tmp_path / "7")
    (tmp_path / "7" / "3.txt").write_text("from\na file\n")
    docs = spark.createDataFrame([(7, 0, "own"), (7, 3, None), (7, 4, "stale"), (8, None, "no file id")], "id long, file_id long, text string")
    got = sorted(((r.id, r.file_id or 0, r.text, r.path) for r in O.with_file_texts(docs, files.read_texts(spark, str(tmp_path)), str(tmp_path)).collect()), key=str)
    assert got == [(7, 0, "own", None), (7, 3, "from\na file\n", f"{tmp_path}/7/3.txt"), (7, 4, None, f"{tmp_path}/7/4.txt"), (8, 0, "no file id", None)]


def test_only_changed_texts_are_identified(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")

    def run(df, done, **options):
        seen = Observation()
        out = L.identify_changed(df, done, seen=seen, **options)
        out.write.mode("overwrite").parquet(f"{tmp_path}/next")
        os.rename(tmp_path / "next", tmp_path / (name := f"run{len(os.listdir(tmp_path))}"))
        return spark.read.parquet(f"{tmp_path}/{name}"), O.observed(seen, "identified")

    one, n = run(docs, None)
    assert n == docs.count() == one.count()
    two, n = run(docs, one)
    assert n == 0 and sorted(map(str, two.collect())) == sorted(map(str, one.collect()))
    changed = docs.filter("doc_id % 10 <> 3").withColumn("text", F.when(F.col("doc_id") % 10 == 4, F.concat("text", F.lit("\nthe end of the text is here"))).otherwise(F.col("text")))
    three, n = run(changed, two)
    assert n == docs.filter("doc_id % 10 = 4").count()
    plain = lambda df: sorted(str((r.doc_id, r.lid, r.l1, r.l1_size)) for r in df.collect())
    full, n = run(changed, None)
    assert n == changed.count() and plain(three) == plain(full)
    _, n = run(changed, three, min_len=20)  # other parameters: all again
    assert n == changed.count()
    assert run(changed.limit(0), three)[0].count() == 0


def test_counts_on_the_way(spark):
    rows = [(1, "a", "t"), (2, " \n", "t"), (3, None, "t"), (4, "b", None), (5, "", None)]
    df = spark.createDataFrame(rows, "id long, text string, tool string")
    seen = Observation()
    assert {(r.id, r.text) for r in O.with_counts(df, seen, tool="tool").collect()} == {(1, "a"), (2, None), (3, None)}
    c = duckdb.connect()
    c.execute("create table t (id int, text varchar, tool varchar)")
    c.executemany("insert into t values (?, ?, ?)", rows)
    (want,) = c.sql("select count(*), count(*) filter (text is null), count(*) filter (trim(text, ' \t\n\r') = ''), count(*) filter (tool is null) from t").fetchall()
    assert tuple(seen.get[k] for k in ("rows", "missing", "blank", "no_tool")) == want == (5, 1, 2, 2)


@pytest.mark.parametrize("most", [1, 3, 1000])
def test_capped_sentences(spark, most):
    """Counted sentences have the groups of their lines, and no line is shuffled."""
    import __spark_entry__ as entry

    rng = random.Random(most)
    sizes = {f"f{k}": [rng.randint(1, 9) for _ in range(rng.randint(1, 12))] for k in range(6)}
    rows = [(f, s, n) for f, ns in sizes.items() for s, n in enumerate(ns)]
    rng.shuffle(rows)
    got = S.capped_sentences(spark.createDataFrame([*rows, ("f0", 99, 0)], "file string, sent int, lines int"), most=most).collect()
    for f, ns in sizes.items():
        groups = split_by([v for n in ns for v in ["a"] * (n - 1) + ["</s>"]], "</s>", most)
        assert sorted((r.group, r.lines) for r in got if r.file == f) == [(g, groups.count(g)) for g in sorted(set(groups))]
    p = entry.queries()["capped_groups"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert p.count("Exchange") == 1 and "Union" not in p
