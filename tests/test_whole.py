"""Queries over whole values, on small tables whose interesting part lies far from the start."""

import xml.sax.saxutils as X

import duckdb

import __spark_entry__ as entry

XML = {"\n": "&#10;", "\r": "&#13;", "\t": "&#9;"}


def test_whole_pages_are_quoted(spark, tmp_path):
    """The style of quotation marks and the escapes depend on all of a page."""
    far = "x" * 900
    pages = [far, far + '"', far + "'", far + "\"'", far + "<&>\n\r\t", '"' + far + "'" + far + "&", "short", ""]
    rows = list(enumerate(pages))
    spark.createDataFrame([*rows, (99, None)], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.quoted for r in entry.queries()["xml_quote"](spark, str(tmp_path)).collect()}
    assert got == {i: X.quoteattr(h, XML) if h else h for i, h in [*rows, (99, None)]}


def test_whole_texts_are_cleaned(spark, tmp_path):
    """Control characters past the first hundred go, all others stay."""
    far = "é" * 300
    texts = [far, far + "\x0b" + far + "\x0c", "\x1c" + far + "\x1d\x1ez", far + "\t\n\r\x1f", "", "\x0b"]
    rows = list(enumerate(texts))
    spark.createDataFrame([*rows, (99, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.text for r in entry.queries()["xml_tokens"](spark, str(tmp_path)).collect()}
    assert got == {i: "abc" + "".join(x for x in t if x not in "\x0b\x0c\x1c\x1d\x1e") + "abc" for i, t in rows} | {99: None}


def test_multiword_tokens_of_all_ids(spark, tmp_path):
    """Large, negative and null ids, against the SQL."""
    ids = [1, 10**9, 10**9 + 1, (1 << 63) - 1, -5, None]
    spark.createDataFrame([(i, "One two three, four five. Six seven!") for i in ids], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = entry.queries()["mwt_splice"](spark, str(tmp_path))
    c = duckdb.connect()
    c.sql(f"create view documents as from '{tmp_path}/documents.parquet/*.parquet'")
    want = c.sql(f"SELECT {', '.join(got.columns)} FROM ({entry.oracle_sql()['mwt_splice']})").fetchall()
    assert {r[0] for r in want} == set(ids)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
