"""The operators on tables with nulls, empty and long texts, ties, repeated rows, no rows and clashing columns."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from textmill.llm import bpe, decontam, langcode, neardup, packed, quality, suffixdedup, unigram, urlrules, warc
from textmill.llm.common import Scratch

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, key int, digest string, place long, spans int, packed string, n int"
RANKS = P.path("byte_bpe_50k.tiktoken")


def odd_rows():
    rng = random.Random(9)
    prose = lambda n: " ".join("".join(rng.choices("aeioubcdst", k=rng.randint(2, 8))) for _ in range(n))
    base = prose(150)
    near = base.split()
    near[40] = "changed"
    passage = prose(60)
    texts = [None, "", " \n\t", "word", base, base, " ".join(near), prose(30) + " " + passage + " " + prose(20), passage + " " + prose(40), prose(6000), "abc" * 3000, "é日" * 300, "x " * 400, passage[:150], "a b c d", "A  b c\nD"]
    rows = [(i, t, "en" if i % 2 else None, "s", 1, "i", 2, "d", 3, 4, "p", 5) for i, t in enumerate(texts)]
    return [*rows, rows[4], rows[8]]  # repeated rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("table", ["odd", "docs"])
def test_bpe(request, table):
    import tiktoken

    df = request.getfixturevalue(table)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    want = []
    for i, t in texts_of(df):
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, bpe.round_trip_digests(df, RANKS, P.PATTERN).collect())) == sorted(want)
    assert sorted(len(r.ids) for r in bpe.encode_ids(df, RANKS, P.PATTERN).collect()) == sorted(w[1] for w in want)


@pytest.mark.parametrize("table", ["odd", "docs"])
def test_packed_files(request, spark, table):
    from tokenizers import Tokenizer

    df = request.getfixturevalue(table)
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = packed.read_ids(spark, packed.write_ids(df, P.path("byte_bpe_50k.json"), 2, Scratch(spark)))
    want, start = [], 0
    for i, t in sorted(texts_of(df), key=lambda x: (x[0], x[1] or "")):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_quality(odd):
    rows = {r.doc_id: r for r in quality.judge(odd).collect()}
    assert [rows[i].n_words for i in (0, 1, 2, 3)] == [0, 0, 0, 1]
    assert all(rows[i].base_failed and not rows[i].kept for i in (0, 1, 2, 3, 12))
    assert rows[12].n_repeat_words == 400 and rows[4].kept and rows[9].kept
    assert rows[7].word_chars == sum(map(len, odd_rows()[7][1].split()))
    assert quality.keep_good(odd).columns == odd.columns
    assert quality.keep_good(odd).count() == sum(r.kept for r in quality.judge(odd).collect())


@pytest.mark.parametrize("block_bytes", [1 << 20, 600])
def test_decontamination(spark, odd, block_bytes):
    texts = dict(texts_of(odd))
    items = [("a", " ".join(texts[9].split()[100:140])), ("b", "word"), (None, texts[4]), ("c", None), ("c", ""), ("a", " ".join(texts[8].split()[:14]))]
    bench = spark.createDataFrame(items, "item_id string, text string")
    rows = decontam.report(odd, bench, block_bytes=block_bytes).collect()
    assert len(rows) == odd.count()
    one = {r.doc_id: r for r in rows}
    assert (one[9].n_hit, one[9].n_items, one[9].contaminated) == (40, 1, False)
    assert (one[3].n_hit, one[3].contaminated) == (1, True)
    assert one[4].n_hit == one[4].n_words == 150 and one[4].n_items == 0
    assert one[8].n_hit == 14 and one[8].items_sha256 == hashlib.sha256(b"a").hexdigest()
    assert one[0].n_words == one[1].n_words == 0 and not one[0].contaminated
    clean = decontam.keep_clean(odd, bench, block_bytes=block_bytes)
    assert clean.columns == odd.columns and clean.count() == sum(not r.contaminated for r in rows)


def near_brute(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[a : a + 5]) for a in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    by = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    pairs = Counter((a, b) for ids in by.values() for a in ids for b in ids if a > b)
    for (a, b), n in pairs.items():
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            top[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i, _ in rows)


@pytest.mark.parametrize("table", ["odd", "docs"])
def test_near_duplicates(request, table):
    df = request.getfixturevalue(table)
    assert sorted(map(tuple, neardup.near_duplicates(df).collect())) == near_brute(texts_of(df))


def test_near_duplicates_of_a_family(spark, monkeypatch):
    """Many edits of one text: some link only to each other; blocks of three members."""
    monkeypatch.setattr(neardup, "BLOCK", 3)
    rng = random.Random(10)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(120)] = f"e{rng.randint(0, 3)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, neardup.near_duplicates(df).collect())) == near_brute(rows)


def repeat_brute(rows, length=200):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[s : s + length] for _, b in raw for s in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("table", ["odd", "docs"])
def test_repeats(request, table):
    df = request.getfixturevalue(table)
    assert sorted(map(tuple, suffixdedup.removal_digests(df).collect())) == repeat_brute(texts_of(df))


def test_repeats_of_a_hot_passage(spark):
    """Anchors with more contexts than a task may hold are counted window by window."""
    rng = random.Random(11)
    letters = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    passage = letters(230)
    rows = [(i, letters(rng.randint(0, 150)) + passage + letters(rng.randint(0, 150))) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, suffixdedup.removal_digests(df, hot=3).collect())) == repeat_brute(rows)


def test_remove_repeats_keeps_columns(odd):
    out = suffixdedup.remove_repeats(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert {r.text for r in out.filter("doc_id = 9").collect()} == {odd_rows()[9][1]}


def test_language(docs, odd):
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = langcode.train(docs.filter(~held_out))
    got = langcode.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter(held_out).collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)
    rows = {r.doc_id: r for r in langcode.identify(odd, model).collect()}
    assert [rows[i].lang_pred for i in (0, 1, 2)] == ["und"] * 3
    alone = langcode.train(odd)
    assert {r.lang_pred for r in langcode.identify(odd, alone).collect()} == {"en", "und"}
    nothing = langcode.train(odd.filter("lang = 'zz'"))
    assert {r.lang_pred for r in langcode.identify(odd, nothing).collect()} == {"und"}


def test_token_counts(odd):
    import regex

    scores = unigram.rank_scores(bpe.read_ranks(RANKS))
    model = unigram.Unigram(scores)
    for r in unigram.token_counts(odd, RANKS, P.PATTERN).collect():
        pieces = [p.encode() for p in regex.findall(P.PATTERN, dict(texts_of(odd))[r.doc_id] or "")]
        counts = model.counts(set(pieces))
        assert (r.n_pretokens, r.n_tokens) == (len(pieces), sum(counts[p] for p in pieces))


def test_warc(spark):
    big = "x" * 1000
    rows = [(1, "http://a/", big), (2, None, big), (None, "http://a/é\r\nX: y", big), (5, "http://b.c/", big), (5, "http://b.c/", big), (6, "", "short"), (7, "q", None), (8, "z", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    scratch = Scratch(spark)
    index = scratch.table(warc.merge_index(warc.write_archives(df, scratch), scratch), "index")
    got = warc.read_archives(index).collect()
    sha = lambda t: hashlib.sha1(t.encode()).hexdigest()
    want = [(p, len((h or "").encode()), sha(h or ""), "revisit" if h == big and p != 5 else "response", 5 if h == big and p != 5 else None) for p, _, h in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_merge_of_many_runs(spark, monkeypatch):
    """Several runs in a task, several blocks in a run, several ranges, and more runs than one task merges."""
    for name, value in (("RUN_RECORDS", 7), ("BLOCK_RECORDS", 3), ("RANGE_RECORDS", 25), ("FAN_IN", 4)):
        monkeypatch.setattr(warc, name, value)
    rng = random.Random(13)
    rows = [(i if i % 9 else None, f"http://{rng.choice('abc')}.org/{rng.randint(0, 5)}", "x" * rng.randint(0, 9)) for i in range(200)]
    df, scratch = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5), Scratch(spark)
    blocks = warc.write_archives(df, scratch)
    assert blocks.select("run").distinct().count() > 4
    got = warc.merge_index(blocks, scratch).collect()
    keys = [(r.urlkey, r.date, r.page_id is not None, r.page_id or 0) for r in got]
    assert keys == sorted(keys) and sorted((k, p) for k, _, _, p in keys) == sorted((warc.url_key(u), i or 0) for i, u, _ in rows)
    back = warc.read_archives(scratch.table(warc.merge_index(blocks, scratch), "index")).collect()
    assert sorted((r.page_id or 0, r.payload_bytes) for r in back) == sorted((i or 0, len(h)) for i, _, h in rows)


@pytest.mark.parametrize("name", ["op3_url_filter", "op4_warc"])
def test_against_sql(spark, name):
    from textmill.llm.queries import oracle_sql, queries

    duck = duckdb.connect()
    duck.sql(f"create view pages as from '{SF}/pages.parquet'")
    df = queries()[name](spark, SF)
    want = duck.sql(f"SELECT {', '.join(df.columns)} FROM ({oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)


def test_urls(spark):
    rows = [(1, None), (2, ""), (3, "HTTP://A.Example.NET/en/x?y"), (3, "HTTP://A.Example.NET/en/x?y"), (4, "ftp://org/fr/"), (None, "x://net/" + "p" * 5000)]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(1))
    got = {(r.page_id, r.host, r.path[:6], r.rule, r.verdict) for r in urlrules.judge_urls(df, hosts=urlrules.QUERY_HOST_RULES).collect()}
    assert got == {(1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "a.example.net", "/en/x", "example.net/en/", "allow"), (4, "org", "/fr/", "org/fr/", "allow"), (None, "net", "/ppppp", "net/", "block")}


def test_empty_tables(spark, odd):
    none, scratch = odd.limit(0), Scratch(spark)
    bench = spark.createDataFrame([], "item_id string, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for df in (
        bpe.round_trip_digests(none, RANKS, P.PATTERN), packed.read_ids(spark, packed.write_ids(none, P.path("byte_bpe_50k.json"), 2, scratch)), quality.judge(none), decontam.report(none, bench),
        neardup.near_duplicates(none), suffixdedup.removal_digests(none), langcode.identify(none, langcode.train(none)), unigram.token_counts(none, RANKS, P.PATTERN), urlrules.judge_urls(pages),
        warc.read_archives(scratch.table(warc.merge_index(warc.write_archives(pages, scratch), scratch), "index")),
    ):
        assert df.count() == 0
    assert decontam.report(odd, bench).filter("n_hit > 0").count() == 0


def test_pipeline(spark, tmp_path):
    """Each stage against brute force on its own input."""
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = {}
    for k, (name, stage) in enumerate(C.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        steps[name] = docs, (docs := spark.read.parquet(f"{tmp_path}/{k}"))
        assert k == len(C.STAGES) - 1 or docs.columns == steps["quality rules"][0].columns
    before, after = steps["quality rules"]
    kept = {r.doc_id for r in quality.judge(before).filter("kept").collect()}
    assert {i for i, _ in texts_of(after)} == kept
    before, after = steps["near-duplicates"]
    assert {i for i, _ in texts_of(after)} == {i for i, _, _, k in near_brute(texts_of(before)) if k}
    before, after = steps["repeated passages"]
    cut = {i: s for i, _, _, _, s in repeat_brute(texts_of(before))}
    assert {i for i, t in texts_of(after) if hashlib.sha256(t.encode()).hexdigest() != cut[i]} <= {i for i, t in texts_of(before) if not t.isascii()}
    before, after = steps["decontamination"]
    clean = {r.doc_id for r in decontam.report(before, spark.read.parquet(f"{SF}/benchmark.parquet")).filter("not contaminated").collect()}
    assert {i for i, _ in texts_of(after)} == clean
    before, after = steps["byte-level BPE"]
    decoder = bpe.ByteBPE(bpe.read_ranks(RANKS), P.PATTERN)
    texts = dict(texts_of(before))
    assert {r.doc_id: decoder.decode(r.ids).decode() for r in after.collect()} == texts
    assert C.run(spark, SF).count() == len(texts)


@pytest.fixture(scope="module")
def strange(spark):
    """Rows without an id, two texts on one id, no letters, a column whose name needs quotes; texts long enough to repeat."""
    rng = random.Random(21)
    prose = lambda n: " ".join("".join(rng.choices("aeioubcdst", k=rng.randint(2, 8))) for _ in range(n))
    a, b, c = prose(120), prose(121), prose(122)
    rows = [(None, None), (None, a), (None, b), (42, a), (7, c), (7, prose(90)), (8, f"{prose(30)} {c}"), (9, "\u00bd\u00b2"), (10, "\u2167 \u2460"), (7, c), (None, "")]
    return spark.createDataFrame([(i, t, k, "x") for k, (i, t) in enumerate(rows)], "doc_id long, text string, `my col` int, row string").repartition(3)


def test_repeats_of_strange_rows(strange):
    texts = texts_of(strange)
    want = sorted((w[1:] for w in repeat_brute([(k, t) for k, (_, t) in enumerate(texts)])))
    assert sorted(tuple(r)[1:] for r in suffixdedup.removal_digests(strange).collect()) == want
    out = suffixdedup.remove_repeats(strange)
    assert out.columns == strange.columns and sorted(r["my col"] for r in out.collect()) == list(range(11))


def test_near_duplicates_of_strange_rows(strange):
    got = sorted((tuple(r) for r in neardup.near_duplicates(strange).collect()), key=str)
    by = {(r[0], r[1]): (r[2], r[3]) for r in got}
    n = {k: len({tuple(w[i : i + 5]) for i in range(len(w) - 4)}) for k, t in ((r["my col"], r["text"]) for r in strange.collect()) for w in [(t or "").split()]}
    assert all(r[3] is not None for r in got) and len(got) == 11
    assert by[None, n[1]] == (42, False) and by[42, n[1]] == (42, True)
    assert by[None, n[2]] == (None, True) and by[None, 0] == (None, True)
    assert by[7, n[4]] == (7, True) and by[7, n[5]] == (7, True)


@pytest.mark.parametrize("block_bytes", [1 << 20, 500])
def test_decontamination_of_strange_rows(spark, strange, block_bytes):
    """By row, whatever the ids and the number of blocks."""
    texts = {r["my col"]: r["text"] for r in strange.collect()}
    items = [("p", texts[2]), ("q", texts[5]), ("r", "some words that nobody has " * 30), ("p", texts[2])]
    bench = spark.createDataFrame(items, "item_id string, text string")
    clean = decontam.keep_clean(strange, bench, block_bytes=block_bytes)
    assert clean.columns == strange.columns and sorted(r["my col"] for r in clean.collect()) == [0, 1, 3, 4, 6, 7, 8, 9, 10]
    hits = [r.n_hit for r in decontam.report(strange, bench, block_bytes=block_bytes).collect()]
    assert len(hits) == 11 and sorted(h for h in hits if h) == [90, 121]


def test_other_operators_on_strange_rows(spark, strange):
    model = langcode.train(strange.withColumn("lang", F.lit("en")))
    got = {(r.doc_id, r.lang_pred) for r in langcode.identify(strange, model).collect()}
    assert {(9, "und"), (10, "und"), (42, "en"), (None, "en"), (None, "und")} <= got
    assert bpe.round_trip_digests(strange, RANKS, P.PATTERN).count() == quality.judge(strange).count() == unigram.token_counts(strange, RANKS, P.PATTERN).count() == 11
    kept = quality.keep_good(strange)
    assert kept.columns == strange.columns and kept.count() == 7
    assert packed.read_ids(spark, packed.write_ids(strange, P.path("byte_bpe_50k.json"), 2, Scratch(spark))).count() == 11


def test_repeats_in_long_texts(spark):
    """A text over several segments, one letter again and again, and a short pattern."""
    rng = random.Random(22)
    long = "".join(rng.choices("abcdefgh ", k=700_000))
    rows = [(1, long), (2, "y" * 300_000), (3, "xyz" * 50_000), (4, long[400_000:400_500] + "!" + long[249_800:250_300])]
    got = {r.doc_id: tuple(r)[1:4] for r in suffixdedup.removal_digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (700_000, 1000, 2), 2: (300_000, 300_000, 1), 3: (150_000, 150_000, 1), 4: (1001, 1000, 2)}


def test_copies_in_sql(spark):
    """Groups of equal texts by SQL are within components."""
    rows = neardup.near_duplicates(spark.read.parquet(f"{SF}/documents.parquet")).toPandas()  # noqa: F841
    q = f"SELECT count(*) FROM (SELECT d.text FROM '{SF}/documents.parquet' d JOIN rows r USING (doc_id) WHERE r.n_shingles > 0 GROUP BY d.text HAVING count(DISTINCT component_id) > 1)"
    assert duckdb.sql(q).fetchall() == [(0,)]
