"""The pipeline on tables with repeated rows and rows without an id."""

import random
import shutil

import corpus_pipeline as C
from textmill.llm import neardup

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join("".join(rng.choices("aeioubcdst", k=rng.randint(2, 8))) for _ in range(n))


def kept(spark, rows):
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).repartition(3)
    out = neardup.keep_one(df)
    assert out.columns == df.columns
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)


def test_keep_one_of_repeated_rows(spark):
    rng = random.Random(3)
    a, b, short = prose(rng, 150), prose(rng, 150), prose(rng, 5)
    near = " ".join(["changed" if k == 40 else w for k, w in enumerate(a.split())])
    assert kept(spark, [(1, a), (1, a), (1, a), (2, near), (3, b), (4, short), (4, short), (5, ""), (5, ""), (6, "")]) == sorted([(1, a), (3, b), (4, short), (5, ""), (6, "")], key=repr)


def test_keep_one_without_ids(spark):
    rng = random.Random(4)
    a, b, c, d = (prose(rng, 150) for _ in range(4))
    near = lambda t: " ".join(["changed" if k == 40 else w for k, w in enumerate(t.split())])
    rows = [(None, a), (7, b), (None, b), (None, near(b)), (None, c), (None, c), (None, ""), (None, None), (None, None), (-9, near(d)), ((1 << 63) - 1, d)]
    assert kept(spark, rows) == sorted([(None, a), (7, b), (None, c), (None, ""), (None, None), (None, None), (-9, near(d))], key=repr)


def test_pipeline_of_repeated_rows(spark, tmp_path):
    """A clean document that is there as two equal rows keeps its text, and one without an id reaches the end."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = {r.doc_id for r in C.run(spark, SF).filter("n_tokens > 100").collect()}
    *rows, last = [tuple(r) for r in docs.orderBy("doc_id").collect() if r.doc_id in clean and r.text.isascii()][:12]
    place = docs.columns.index("doc_id")
    ids = lambda x: (*last[:place], x, *last[place + 1 :])
    done = {}
    for name, table in (("plain", [*rows, ids(-1)]), ("repeated", [*rows, ids(None), rows[0], rows[0], rows[5]])):
        spark.createDataFrame(table, docs.schema).repartition(3).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        shutil.copy(f"{SF}/benchmark.parquet", f"{tmp_path}/{name}/benchmark.parquet")
        done[name] = sorted(((r.doc_id, r.n_tokens, r.ids) for r in C.run(spark, f"{tmp_path}/{name}").collect()), key=repr)
    assert len(done["plain"]) == len(rows) + 1
    assert done["repeated"] == sorted([(None if i == -1 else i, *rest) for i, *rest in done["plain"]], key=repr)
