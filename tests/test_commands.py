import pytest

from textmill import __main__ as M
from textmill.operators import tokens as K


def test_from_tagged_to_enriched(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('<doc id="7" file_id="0" >\nThe cat sat. It did not move at all today.\n</doc>\n<doc id="8" >\nEnd.\n</doc>\n')
    conll = M.to_conll(spark, str(tmp_path / "in"))
    assert K.parse_conllu(conll.withColumn("line_idx", conll.line_idx.cast("long"))).count() == 4 + 8 + 2
    lines = M.to_vertical(conll.selectExpr("'f' AS file", "trim(substring(file, 1, 20)) * 1000 + line_idx AS line_idx", "value"))
    got = [r.value for r in lines.orderBy("line_idx").collect()]
    assert got[0] == '<doc id="7" file_id="0" >' and got[-1] == "</doc>" and got.count("</s>") == 3 and got[1] == '<s id="0">'
    assert got.count("</doc>") == 2 and got[got.index('<doc id="8" >') + 1] == '<s id="0">'
    langs = M.sentence_languages(lines)
    assert {(r.line_idx, r.lang) for r in langs.collect()} <= {(r.line_idx, x) for r in lines.filter("value LIKE '<s%'").collect() for x in ("en", "fr", "es", "unknown")}
    rich = [r.value for r in M.enrich(lines, langs, doc_n=5).orderBy("line_idx").collect()]
    assert rich[0].startswith('<docx ref="1" name="f"') and rich[-1] == "</docx>"
    assert [x for x in rich if x.startswith("<doc ")] == ['<doc id="7" file_id="0" ref="5" >', '<doc id="8" ref="6" >']


def test_document_without_sentences_is_closed(spark):
    lines = spark.createDataFrame([("f", 0, "# newdoc id=1"), ("f", 1, "# newdoc id=2"), ("f", 2, "# sent_id = 0"), ("f", 3, "\t".join(["1", "a", *"________"]))], "file string, line_idx long, value string")
    got = [r.value for r in M.to_vertical(lines).orderBy("line_idx").collect()]
    assert got[:3] == ['<doc id="1" >', "</doc>", '<doc id="2" >'] and got[-1] == "</doc>"


def test_normalize_command(monkeypatch, capsys):
    import io

    monkeypatch.setattr("sys.stdin", io.TextIOWrapper(io.BytesIO("ﬁ “x”\n".encode())))
    assert M.main(["normalize"]) == 0
    assert capsys.readouterr().out == 'fi "x"\n'


def test_attachments_of_one_record_stay_apart(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('<doc id="7" file_id="9" >\nFour five six.\n</doc>\n<doc id="7" file_id="0" >\nOne two three.\n</doc>\n')
    got = [r.value for r in M.to_conll(spark, str(tmp_path / "in")).orderBy("file", "line_idx").collect()]
    assert [x for x in got if x.startswith("#") and "newdoc" in x] == ["# newdoc id=7 file_id=0", "# newdoc id=7 file_id=9"]
    assert [x.split("\t")[1] for x in got if x[:1].isdigit()] == ["One", "two", "three", ".", "Four", "five", "six", "."]


def test_languages_belong_to_their_file(spark, tmp_path):
    (tmp_path / "in").mkdir()
    line = lambda w: "\t".join(["1", w, w, *"_______"])
    for name, words in (("a", "the cat was on the table and it was not in the house".split()), ("b", "le chat est sur la table et il est dans la maison".split())):
        (tmp_path / "in" / f"{name}.vert").write_text("\n".join(['<doc id="1" >', '<s id="0">', *map(line, words), "</s>", "</doc>"]) + "\n")
    assert M.main(["langid", str(tmp_path / "in"), str(tmp_path / "lang")]) == 0
    assert M.main(["enrich", str(tmp_path / "in"), str(tmp_path / "out"), "--langid", str(tmp_path / "lang")]) == 0
    got = [r.value for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert [x for x in got if x.startswith("<s ")] == ['<s id="0" lang="en" >', '<s id="0" lang="fr" >'] and len([x for x in got if x.startswith("<docx")]) == 2


def test_a_file_for_each_file(spark, tmp_path):
    """Plain and compressed files of the same lines, named as what they come from."""
    import lzma

    (tmp_path / "in").mkdir()
    for name in ("a.1", "b"):
        (tmp_path / "in" / f"{name}.conllu").write_text("\n".join([f"# newdoc id={name[0]}", "# sent_id = 0", *("\t".join([str(k), f"w{k}é", *"________"]) for k in (1, 2, 3)), "", ""]))
    assert M.main(["to-vert", str(tmp_path / "in"), str(tmp_path / "out"), "--each", "--compress", "--keep", "-T", "2"]) == 0
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["a.vert", "a.vert.xz", "b.vert", "b.vert.xz"]
    plain = (tmp_path / "out" / "b.vert").read_text()
    assert plain.splitlines()[0] == '<doc id="b" >' and plain.splitlines()[-1] == "</doc>" and len(plain.splitlines()) == 7
    assert lzma.decompress((tmp_path / "out" / "b.vert.xz").read_bytes()).decode() == plain
    assert M.main(["enrich", str(tmp_path / "out" / "b.vert.xz"), str(tmp_path / "rich"), "--each", "--compress"]) == 0
    rich = lzma.decompress((tmp_path / "rich" / "b.vert.xz").read_bytes()).decode().splitlines()
    assert rich[0].startswith("<docx ref") and rich[1] == '<doc id="b" ref="1" >' and rich[-1] == "</docx>"


def test_export_command(spark, tmp_path, capsys):
    """Texts of a language and of a range of dates, own ones and those of attachments, in files with the names of the range."""
    from pyspark.sql import functions as F

    (tmp_path / "texts" / "5").mkdir(parents=True)
    (tmp_path / "texts" / "5" / "1.txt").write_text("attached")
    share = lambda en: F.create_map(F.lit("en"), F.lit(en))
    texts = spark.createDataFrame([(i, 0, f"text {i}") for i in range(1, 9)] + [(5, 1, None), (6, 2, None)], "id long, file_id long, text string")
    texts = texts.withColumn("lid", F.when(F.col("id") == 2, share(0.7)).otherwise(share(0.8)))
    tables = tmp_path / "tables"
    texts.write.parquet(f"{tables}/texts")
    spark.createDataFrame([(i, f'<doc id="{i}" file_id="FILE_ID" >') for i in range(1, 9)], "id long, doc_tag string").write.parquet(f"{tables}/attrs")
    spark.createDataFrame([(i, f"202{i}-01-01T00:00:00+00:00") for i in range(1, 9)], "id long, date string").write.parquet(f"{tables}/records")
    args = ["export", str(tables), str(tmp_path / "out"), "--lang", "en", "--stem", "rw", "--start", "2021-01-01", "--end", "2026-01-01", "--per-file", "3", "--texts", str(tmp_path / "texts")]
    assert M.main(args) == 0
    names = [f"rw_en_2021-01-01_2026-01-01.{k}.txt" for k in (1, 2)]
    assert capsys.readouterr().out.split() == names == sorted(p.name for p in (tmp_path / "out").iterdir())
    first, second = ((tmp_path / "out" / n).read_text() for n in names)
    assert first == "\n".join(f'<doc id="{i}" file_id="0" >\ntext {i}\n</doc>' for i in (1, 3, 4))
    assert second == '<doc id="5" file_id="0" >\ntext 5\n</doc>\n<doc id="5" file_id="1" >\nattached\n</doc>\n<doc id="6" file_id="0" >\ntext 6\n</doc>'
    with pytest.raises(SystemExit):
        M.main([*args[:-6], "--start", "2021-1-1"])
    assert "no date of the form" in capsys.readouterr().err


def test_compare_command(spark, tmp_path, capsys):
    """Documents are aligned by id, whatever file they are in; tags are compared as a mapping says."""
    import json

    def write(name, docs):
        (tmp_path / name).mkdir()
        for k, (i, tokens) in enumerate(docs):
            rows = [f"{w}\t{t}\tx-y" for w, t in tokens]
            (tmp_path / name / f"{k}.vert").write_text("\n".join([f'<doc id="{i}" file_id="0" >', "<s>", *rows, "</s>", "</doc>"]))

    one, two = [("the", "DT"), ("cat", "NN"), ("sat", "VBD")], [("a", "DT"), ("b", "NN")]
    write("first", [(1, one), (2, two)])
    write("second", [(2, [("a", "Z"), ("b", "Nx")]), (1, [("the", "Z"), ("cat", "Vx"), ("sat", "Vx"), ("down", "Rx")])])
    (tmp_path / "map.json").write_text(json.dumps({"p": {"DT": {"upos": "DET"}, "NN": {"upos": "NOUN"}, "VBD": {"upos": "VERB"}}, "f": {"Z": "DET", "Nx": "NOUN", "Vx": "VERB"}}))
    assert M.main(["compare", str(tmp_path / "first"), str(tmp_path / "second"), "--mapping", str(tmp_path / "map.json"), "--tagset", "p", "f", "--out", str(tmp_path / "out")]) == 0
    text = capsys.readouterr().out
    assert "| 1-second | 5 | 4 | 1 | 0 | 1 | 0 | 80.00 | 20.00 |" in text and "| Rx | 0 | 1 |" in text and "| cat | NOUN | VERB | 1 | 100.00 | 20.00 |" in text
    assert (tmp_path / "out" / "report.md").read_text() == text
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["1-second-differences", "1-second-errors", "1-second-ignored", "1-second-pairs", "report.md", "tags"]


def test_normalize_options(monkeypatch, capsys):
    import io

    def run(text, *options):
        monkeypatch.setattr("sys.stdin", io.TextIOWrapper(io.BytesIO(text.encode("latin-1" if "-e" in options else "utf-8"))))
        assert M.main(["normalize", *options]) == 0
        return capsys.readouterr().out

    assert run(" a \n\nb\n", "-s") == " a \nb\n" and run("a\n\n \nb\n", "-z") == "a\n\n\nb\n"
    assert run("a\nb\n", "-n", "dos") == "a\r\nb\r\n"
    assert run("a\tb\n", "-t", "none") == "ab\n" and run("a\tb\n", "-t", "tab", "-c", "9") == "a\tb\n" and run("a\tb\n", "-t", "tab") == "ab\n"
    assert run("ﬁ “x” —\n", "-f", "NFC", "-q", "-a") == "ﬁ “x” —\n" and run("café\n", "-e", "latin-1") == "café\n"


def test_update_command(spark, tmp_path, capsys):
    """Each language's texts of the range are exported and annotated; markup stays between the tokens."""
    import lzma

    from pyspark.sql import functions as F

    tables = tmp_path / "tables"
    texts = spark.createDataFrame([(1, 0, "One <b>two</b>. Three"), (2, 0, "Un deux"), (3, 0, "Late")], "id long, file_id long, text string")
    texts.withColumn("lid", F.create_map(F.when(F.col("id") == 2, "fr").otherwise("en"), F.lit(1.0))).write.parquet(f"{tables}/texts")
    spark.createDataFrame([(i, f'<doc id="{i}" file_id="FILE_ID" >') for i in (1, 2, 3)], "id long, doc_tag string").write.parquet(f"{tables}/attrs")
    spark.createDataFrame([(i, f"202{i}-05-01T00:00:00+00:00") for i in (1, 2, 3)], "id long, date string").write.parquet(f"{tables}/records")
    assert M.main(["update", str(tables), str(tmp_path / "out"), "--langs", "en", "fr", "es", "--start", "2021-01-01", "--end", "2022-12-31", "--stem", "c"]) == 0
    assert capsys.readouterr().out.split("\n")[:3] == ["en\t1", "fr\t1", "es\t0"]
    name = "c_{}_2021-01-01_2022-12-31.1"
    assert (tmp_path / "out" / "fr" / "text" / (name.format("fr") + ".txt")).read_text() == '<doc id="2" file_id="0" >\nUn deux\n</doc>'
    got = lzma.decompress((tmp_path / "out" / "en" / "vertical" / (name.format("en") + ".vert.xz")).read_bytes()).decode().splitlines()
    assert got == ['<doc id="1" file_id="0" >', "<s>", "One\tPROPN\tone", "<b>", "two\tWORD\ttwo", "</b>", "<g/>", ".\tEND\t.", "</s>", "<s>", "Three\tPROPN\tthree", "</s>", "</doc>"]
    assert not (tmp_path / "out" / "es" / "vertical").exists()
    assert M.main(["annotate", str(tmp_path / "out" / "fr" / "text"), str(tmp_path / "v"), "-s"]) == 0
    assert (tmp_path / "v" / (name.format("fr") + ".vert")).read_text().splitlines() == ['<doc id="2" file_id="0" >', "Un\tPROPN\tun", "deux\tWORD\tdeux", "</doc>"]
