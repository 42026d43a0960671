import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textmill.operators import compare as C
from textmill.operators import corpus as O
from textmill.operators import langid as L
from textmill.operators import tokens as K
from textmill.sources import files, paged


@pytest.mark.parametrize(
    ("sizes", "kept"),
    [({"en": 800, "es": 150, "short": 50}, {"en": 0.8}), ({"en": 670, "es": 330}, {"en": 0.67}), ({x: 20 for x in "abcde"}, {x: 0.2 for x in "abcde"}), ({"x": 5}, {"x": 1.0})],
)
def test_shares(spark, sizes, kept):
    lines = spark.createDataFrame([(1, k, n) for k, n in sizes.items()], "doc_id long, lang string, bytes long")
    row = L.share_maps(L.language_shares(lines)).first()
    assert row.lid == kept
    assert row.l1 == min(kept, key=lambda k: (-kept[k], k))


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (None, "n", 0)], "id long, url string, v int")
    new = spark.createDataFrame([(3, "b", 1), (1, "c", 1)], "id long, url string, v int")
    assert sorted(map(tuple, O.upsert(old, new, ["id"], ["url"]).collect()), key=str) == sorted([(None, "n", 0), (1, "c", 1), (3, "b", 1)], key=str)


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_positions_do_not_depend_on_partitions(spark, parts):
    ids = random.Random(1).sample(range(1000), 200)
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(parts)
    assert sorted(map(tuple, O.global_positions(df, ["id"]).collect())) == [(i, k) for k, i in enumerate(sorted(ids))]


def test_positions_of_wide_and_uneven_rows(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    wide = docs.withColumn("row", F.repeat("text", (F.col("doc_id") % 7).cast("int"))).withColumn("attrs", F.create_map(F.lit("_part"), "source")).withColumn("_part", F.lit(1)).withColumn("_row", F.lit("x"))
    for order in (["doc_id"], ["source", "doc_id"], ["lang"]):
        O.batch_numbers(wide, order, 64).write.mode("overwrite").parquet(f"{tmp_path}/n")
        got = spark.read.parquet(f"{tmp_path}/n")
        assert got.count() == docs.count() == got.select("doc_id").distinct().count()
        sizes = sorted(r["count"] for r in got.groupBy("batch").count().collect())
        assert sizes == sorted([64] * (10_000 // 64) + [10_000 % 64])
    K.number_documents(wide, ["doc_id"]).select("doc_id", "ref").write.mode("overwrite").parquet(f"{tmp_path}/n")
    assert spark.read.parquet(f"{tmp_path}/n").filter("ref <> doc_id + 1").count() == 0


def test_positions_of_ties_and_of_nothing(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b"), (1, "c"), (None, None)] * 20, "`a key` int, pos string").repartition(7)
    got = O.global_positions(df, ["a key"], "n").collect()
    assert sorted(r.n for r in got) == list(range(100)) and all((r["a key"] is None) == (r.n < 40) for r in got)
    assert O.global_positions(df.limit(0), ["a key"], "n").collect() == []


def test_equal_groups(spark):
    df = spark.range(10).withColumn("k", F.lit(1))
    assert [r["count"] for r in O.equal_groups(df, ["k"], ["id"], 4).groupBy("group").count().orderBy("group").collect()] == [3, 3, 2, 2]


def _conllu(rows):
    return [(n, "\t".join([i, w, *"____", h, "d", "_", m])) for n, (i, w, h, m) in enumerate(rows)]


def test_multiword(spark):
    rows = _conllu([("1-2", "can't", "_", "M"), ("1", "ca", "0", "_"), ("2", "n't", "1", "_"), ("3-4", "au", "_", "N"), ("3", "à", "2", "_"), ("4", "le", "2", "_"), ("5", "x", "1", "_")])
    head = [("f", 0, "# newdoc id=1"), ("f", 1, "# sent_id = 9")]
    lines = spark.createDataFrame(head + [("f", n + 2, v) for n, v in rows] + [("f", 99, "")], "file string, line_idx long, value string")
    got = K.splice_multiword(K.parse_conllu(lines), ["file", "doc_seq", "sent_seq"]).orderBy("line_idx").collect()
    assert [(r.id, r.form, r.head, r.misc) for r in got] == [("1,2", "can't", "0,1", "M"), ("3,4", "au", "2", "N"), ("5", "x", "1", "_")]


def splice_loop(rows):
    """Lines in order: a range takes the numbers within it that follow, until one that is not, the next range or the end."""
    out, groups, last = [], {}, None
    for at, cells in rows:
        if "-" in cells[0]:
            low, _, high = cells[0].partition("-")
            last = (at, int(low), int(high))
            groups[at] = (cells, [])
        elif last and cells[0].isdigit() and last[1] <= int(cells[0]) <= last[2]:
            groups[last[0]][1].append(cells)
        else:
            groups[at] = (cells, [])
    for at, (head, members) in groups.items():
        if not members:
            out.append((at, *head))
            continue
        columns = [[m[k] for m in members] for k in range(10)]
        joined = [v[0] if len(set(v)) == 1 else ",".join(v) for v in columns]
        joined[1], joined[9] = head[1], head[9]
        out.append((at, *joined))
    return sorted(out)


def test_multiword_against_a_loop(spark):
    rng = random.Random(9)
    sents, rows = [], []
    for s in range(80):
        lines, n = [], 1
        while n < rng.randint(1, 12):
            if rng.random() < 0.3:
                lines.append([f"{n}-{n + rng.randint(0, 3)}"])
            for _ in range(rng.randint(0, 2)):
                lines.append([str(n) if rng.random() < 0.9 else f"{n}.1"])
                n += 1
            n += 1
        lines = [(3 * k, [i, *(rng.choice(["_", "a", "b", "é x"]) for _ in range(9))]) for k, (i,) in enumerate(lines)]
        sents.append(lines)
        rows += [("f", s, at, *cells) for at, cells in lines]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "file string, sent_seq int, line_idx long, " + ", ".join(f"{c} string" for c in K.CONLLU)).repartition(4)
    got = K.splice_multiword(df, ["file", "sent_seq"]).collect()
    for s, lines in enumerate(sents):
        assert sorted(tuple(r)[2:] for r in got if r.sent_seq == s) == splice_loop(lines)
    assert K.splice_multiword(df.limit(0), ["file", "sent_seq"]).collect() == []


def test_unknown_line_is_an_error(spark):
    bad = spark.createDataFrame([("f", 0, "oops")], "file string, line_idx long, value string")
    with pytest.raises(Exception, match="neither comment nor token"):
        K.parse_conllu(bad.union(bad)).collect()


def test_enrichment_is_idempotent(spark):
    lines = spark.createDataFrame([("f", 0, "<docx old>"), ("f", 1, '<s id="1">'), ("f", 2, "</docx>")], "file string, line_idx long, value string")
    names = spark.createDataFrame([("f", 3, "n.vert")], "file string, ref int, name string")
    once = K.wrap_files(lines, names)
    values = lambda df: [r.value for r in df.orderBy("line_idx").collect()]
    assert values(once) == ['<docx ref="3" name="n.vert" >', '<s id="1">', "</docx>"] == values(K.wrap_files(once, names))
    langs = spark.createDataFrame([("f", 1, "es")], "file string, line_idx long, lang string")
    assert '<s id="1" lang="es" >' in values(K.add_sentence_language(lines, langs))


def test_tagged_text(spark, tmp_path):
    (tmp_path / "a.txt").write_text('<doc id="1" >\nx\ny\n</doc>\n<doc id="2" >\nz\n</doc>\n')
    lines = files.read_lines(spark, str(tmp_path))
    assert [(r.tag, r.body) for r in K.read_tagged(lines).orderBy("doc_seq").collect()] == [('<doc id="1" >', "x\ny"), ('<doc id="2" >', "z")]
    assert {(r.tag, r.body) for r in files.read_tagged_splits(spark, str(tmp_path)).collect()} == {('<doc id="1" >', "x\ny"), ('<doc id="2" >', "z")}


def test_xz_lines(spark, tmp_path):
    import lzma

    (tmp_path / "b.vert.xz").write_bytes(lzma.compress(b"<s>\na DT a-d\nb NN b-c-n\n</s>\n"))
    assert [(r.line_idx, r.word, r.lempos) for r in files.read_vertical(spark, str(tmp_path)).orderBy("line_idx").collect()] == [(1, "a", "a-d"), (2, "b", "b-c-n")]


def test_phrases_and_fill(spark):
    t = spark.createDataFrame([(1, i, c, g, n) for i, (c, g, n) in enumerate([("D", "C", "S"), ("N", "F", "N"), ("X", "0", "0"), ("N", "C", "N")])], "s long, pos int, cls string, gender string, number string")
    p = C.phrases(t, ["s"])
    got = [(r.phrase, r.gender_filled, r.number_filled) for r in C.fill_phrases(p, ["s"]).orderBy("pos").collect()]
    assert got == [(0, "F", "S"), (0, "F", "S"), (None, "0", "0"), (None, "M,F", "S,P")]


def test_fill_against_the_loop(spark):
    """Every value that is not definite takes the running one, undefined ones too."""
    rng = random.Random(6)
    rows = [(s, p, rng.choice("CMF0"), rng.choice("NSP0"), rng.choice([None, 1, 2]) if p % 5 else None) for s in range(60) for p in range(12)]
    # a phrase is a run
    rows = [(s, p, g, n, None if ph is None else ph * 100 + p // 4) for s, p, g, n, ph in rows]
    want = {}
    for s in range(60):
        for phrase in {r[4] for r in rows if r[0] == s}:
            inside = [r for r in rows if r[0] == s and r[4] == phrase]
            for at, definite, mark, stands in ((2, "MF", "C", "M,F"), (3, "SP", "N", "S,P")):
                now = next((r[at] for r in inside if r[at] in definite), mark)
                for r in inside:
                    now = r[at] if r[at] in definite else now
                    value = r[at] if phrase is None else now
                    want[s, r[1], at] = stands if value == mark else value
    df = spark.createDataFrame(rows, "s long, pos int, gender string, number string, phrase int").repartition(5)
    for r in C.fill_phrases(df, ["s"]).collect():
        assert (r.gender_filled, r.number_filled) == (want[r.s, r.pos, 2], want[r.s, r.pos, 3])


def _records(folder, n):
    with open(f"{folder}/records.jsonl", "w") as f:
        for i in range(n):
            f.write(json.dumps({"id": i, "fields": {"date": {"changed": f"2024-01-{i % 28 + 1:02d}T00:00:00+00:00"}, "title": f"t{i}"}}) + "\n")


def test_paged_source(spark, tmp_path):
    _records(tmp_path, 25)
    paged.register(spark)
    df = spark.read.format("paged").options(folder=str(tmp_path), limit="10").load()
    assert df.count() == 25 == df.select("id").distinct().count()
    assert paged.high_watermark(df).startswith("2024-01-25")
    quota = paged.Quota(10)
    assert sum(r["count"] for r in paged.harvest(paged.folder_fetch(str(tmp_path)), {}, quota, 10)) == 25
    assert quota.made <= 4
    assert [paged.wait_seconds(c, {"1": 10, "5": 100, "49": None}) for c in (5, 50, 500)] == [1, 5, 49]


def test_stream_upsert(spark, tmp_path):
    from textmill.streaming import ingest

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"id": 1, "changed": "2024-01-01", "v": "a"}\n{"id": 1, "changed": "2024-01-02", "v": "b"}\n{"id": 2, "changed": "2024-01-01", "v": "c"}\n')
    stream = spark.readStream.schema("id long, changed string, v string").json(str(tmp_path / "in"))
    ingest.upsert_stream(stream, str(tmp_path / "t"), str(tmp_path / "c"), ["id"], ["changed"]).awaitTermination()
    (tmp_path / "in" / "b.json").write_text('{"id": 2, "changed": "2024-01-03", "v": "d"}\n')
    ingest.upsert_stream(stream, str(tmp_path / "t"), str(tmp_path / "c"), ["id"], ["changed"]).awaitTermination()
    now = ingest.current(spark.read.parquet(str(tmp_path / "t")), ["id"], ["changed"])
    assert sorted((r.id, r.v) for r in now.collect()) == [(1, "b"), (2, "d")]


def test_stream_offset_survives_changes(tmp_path):
    """A record that changes between two pages moves to the end, and no other one is skipped."""
    _records(tmp_path, 4)
    stream = paged._Stream({"folder": str(tmp_path), "limit": "2"}, StructType.fromDDL(paged.SCHEMA))
    rows, offset = stream.read(stream.initialOffset())
    seen = [r[0] for r in rows]
    lines = [json.loads(x) for x in (tmp_path / "records.jsonl").read_text().splitlines()]
    lines[0]["fields"]["date"]["changed"] = "2024-02-01T00:00:00+00:00"
    (tmp_path / "records.jsonl").write_text("".join(json.dumps(x) + "\n" for x in lines))
    first = offset
    while True:
        rows, after = stream.read(offset)
        got = [r[0] for r in rows]
        if not got:
            break
        seen, offset = seen + got, after
    assert seen == [0, 1, 2, 3, 0]
    assert [r[0] for r in stream.readBetweenOffsets(first, offset)] == [2, 3, 0]


def test_named_batches(spark, tmp_path):
    rows = [(i, i % 2, 1 + i // 4, f"text {i}") for i in range(10)]
    df = spark.createDataFrame(rows, "id long, file_id long, batch int, body string").repartition(3)
    names = files.write_named_batches(df, f"file://{tmp_path}/out", "rw_en_2000")
    assert names == [f"rw_en_2000.{k}.txt" for k in (1, 2, 3)] == sorted(p.name for p in (tmp_path / "out").iterdir())
    assert (tmp_path / "out" / names[1]).read_text() == "\n".join(f"text {i}" for i in (4, 5, 6, 7))


def test_phrase_prefixes(spark):
    """Spans by hand: (classes of a sentence, tokens in phrases)."""
    cases = {"SDNX": "SDN", "DPNX": "DPN", "DDDN": "DDDN", "SPDN": "DN", "XN": "", "DDPNA": "DDPNA", "DOX": "", "POAN": "POAN", "SS": ""}
    rows = [(k, i, c) for k, s in enumerate(cases) for i, c in enumerate(s)]
    got = C.phrases(spark.createDataFrame(rows, "sent long, pos int, cls string"), ["sent"]).filter("phrase is not null").orderBy("sent", "pos").collect()
    for k, want in enumerate(cases.values()):
        assert "".join(r.cls for r in got if r.sent == k) == want


def test_lines_are_normalised_before_they_are_cleaned(spark):
    """References, compatibility forms, quotes and spaces fold first, then marks and digits go; plain lines stay."""
    cases = {
        "caf&eacute; &amp; bar": "café amp bar", "ｗｉｄｅ ﬁne": "wide fine", "a b c": "a b c", "soft­hyphen": "softhyphen", "one two": "one two",
        "plain line, 12 words": "plain line words", "SHOUTED LINE": "shouted line", "&#65;BC": "abc", "\x00\x07": "", "": "",
    }
    rows = spark.createDataFrame(list(enumerate(cases)), "k long, line string")
    got = {r.k: r.line for r in L.tidy_lines(rows).collect()}
    assert got == dict(enumerate(cases.values()))
