import pytest
from pyspark.sql import functions as F

from textmill.functions import nested as N
from textmill.functions import text as T
from textmill.functions import unicode as U


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(f(F.col("c")).alias("r")).first().r


def test_clean_line(spark):
    assert one(spark, " 12 HELLO,\tWORLD • ", T.clean_line) == "hello world"
    assert one(spark, "Straße it's", T.clean_line) == "Straße it's"


def test_folds(spark):
    assert one(spark, "‘a’ “b” «c»", lambda c: T.fold_quotes(c, True)) == "'a' \"b\" \"c\""
    assert one(spark, "a‐b — c", T.fold_dashes) == "a-b – c"
    assert one(spark, "a\x00­b‍c", T.remove_control) == "ab‍c"


def test_extracted(spark):
    assert one(spark, " a \n b\t\tc\n\n\n\nd ", T.clean_extracted) == "a\nb c\n\nd"
    assert one(spark, "the exam-\nple is", T.join_hyphenated) == "the example \nis"


@pytest.mark.parametrize("value", ["plain", 'say "x"', "it's", "both \" and '", "a&b<c>\n\t", ""])
def test_quote_round_trip(spark, value):
    quoted = one(spark, value, T.xml_quote)
    assert quoted == "" if value == "" else one(spark, quoted, T.xml_unquote) == value


def test_tag(spark):
    df = spark.createDataFrame([({"title": 'a "q"', "id": "7", "b": "x", "none": None, "empty": "", "file_id": "FILE_ID"},)], "m map<string,string>")
    tag = df.select(T.start_tag(F.col("m")).alias("t")).first().t
    assert tag == "<doc id=\"7\" file_id=\"FILE_ID\" b=\"x\" title='a \"q\"' >"
    assert one(spark, tag, T.tag_attributes) == {"id": "7", "file_id": "FILE_ID", "b": "x", "title": 'a "q"'}
    assert one(spark, "# k = v & w", T.comment_attribute) == ' k="v &amp; w"'


def test_lists(spark):
    assert one(spark, [" a", "b|c", None], N.list_join, "array<string>") == "a|b%7Cc|None"
    with pytest.raises(Exception, match="separator"):
        one(spark, ["b|c"], lambda c: N.list_join(c, replacement=None), "array<string>")
    assert one(spark, ["", None], N.empty_list_to_null, "array<string>") is None
    assert one(spark, " NaN ", T.null_like) is None


def test_flatten(spark):
    df = spark.createDataFrame([(1, [{"id": 5, "type": [{"n": "x"}], "loc": {"lat": 1.0}}, {"id": None, "type": None, "loc": None}], {"a-b": "c"})], "id long, list array<struct<id:long,type:array<struct<n:string>>,loc:struct<lat:double>>>, rec struct<`a-b`:string>")
    flat = N.flatten_records(df)
    assert flat.columns == ["id", "list__id", "list__loc__lat", "rec__a_b"]
    assert flat.first().asDict() == {"id": 1, "list__id": [5, None], "list__loc__lat": [1.0, None], "rec__a_b": "c"}


def test_conform(spark):
    schema = spark.createDataFrame([], "a long, b string").schema
    df, extra = N.conform(spark.createDataFrame([(1, 2)], "a int, z int"), schema)
    assert (df.first().asDict(), extra) == ({"a": 1, "b": None}, ["z"])


def test_normalize_line():
    assert U.normalize_line("ﬁ &amp; &eacute;&#8212;“x” a­b\x07") == 'fi &amp; é–"x" ab\n'
    assert U.normalize_line("a\u2028b\n") == "a\nb\n"
    assert U.normalize_text("a\n\nb") == "a\nb\n"
    assert U.normalize_text("a\n\nb", keep_empty=True) == "a\n\nb\n"
    assert U.normalize_line("&lt;", full_decode=True) == "<\n"


def test_html_and_objects():
    page = "<p>a&amp;b</p><script>x</script><!-- c -->"
    assert U.html_text(page) == "a&bx"
    assert U.html_text(page, " ", ("script",)) == "a&b"
    assert [U.str_to_obj(x) for x in ('{"a": 1}', "['b']", "plain")] == [{"a": 1}, ["b"], "plain"]


def test_open_references():
    page = "<title>a&amp;b&amp</title><style>p{}</style><script>x&amp;&y</script>&copy 1&#65;&#66 &no; &notit;&"
    assert U.html_text(page, open_references=False) == "a&b&ampp{}x&amp;&y&copy 1A&#66 &no; &notit;&"
    assert U.html_text("<title>a&amp</title>b") == "a&b"


def test_xz_round_trip(spark):
    df = spark.createDataFrame([("é\n",), (None,)], "t string")
    assert [r.x for r in df.select(U.unxz_udf()(U.xz_udf()("t")).alias("x")).collect()] == ["é\n", None]


def test_params_hash(spark):
    """The digest of sorted keys, whatever their order and spaces."""
    import hashlib
    import json

    texts = ['{"b": 1, "a": [2, {"d": null, "c": "é"}]}', '{ "a":[2,{"c":"é","d":null}],"b":1}', "{}", '{"a": 1.50}']
    want = [hashlib.blake2b(json.dumps(json.loads(t), sort_keys=True).encode(), digest_size=16).hexdigest() for t in texts]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "k int, t string")
    got = {r.k: r.h for r in df.select("k", U.params_hash_udf()("t").alias("h")).collect()}
    assert got == dict(enumerate([*want, None])) and want[0] == want[1]
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("props").collect()
    counted = {}
    for r in events:
        h = hashlib.blake2b(json.dumps(json.loads(r.props), sort_keys=True).encode(), digest_size=16).hexdigest()
        counted[h] = counted.get(h, 0) + 1
    import __spark_entry__ as entry

    assert {r.hash: r.n for r in entry.queries()["params_hash"](spark, "/root/testdata/sf0.001").collect()} == counted


def test_lines_are_cleaned_by_classes(spark):
    from textmill.functions import text as T
    from textmill.operators import langid as L

    rows = [(k, "".join(c)) for k, c in enumerate(["a…b", " 12 ", "", "\x0b–", "ÉCOLE 1", "École", "a  b\tc", "x`y“z”", "«›", "d—e"])]
    df = spark.createDataFrame([*rows, (99, None)], "k int, line string")
    c = F.col("line")
    drops = T.DROP_DIGITS + T.DROP_PUNCTUATION + T.DROP_SYMBOLS + T.DROP_SPACES
    spaced = F.trim(F.regexp_replace(F.translate(c, drops, " " * len(drops)), r"\s+", " "))
    plain = F.when(spaced.rlike(r"\p{Lu}") & ~spaced.rlike(r"[\p{Ll}\p{Lt}]"), F.lower(spaced)).otherwise(spaced)
    for r in df.select(T.clean_line(c).alias("got"), plain.alias("want"), T.blank_line(c).alias("blank"), T.fold_marks(c).alias("folded"), T.fold_dashes(T.fold_quotes(c)).alias("marks")).collect():
        assert (r["got"], r["folded"], r["blank"]) == (r["want"], r["marks"], None if r["want"] is None else r["want"] == "")
    left = L.tidy_lines(df, blank=False).collect()
    assert sorted(r.k for r in left) == [r.k for r in L.tidy_lines(df).orderBy("k").collect() if r.line]
    assert "regexp_replace" not in L.tidy_lines(df, blank=False).filter("k > 0")._jdf.queryExecution().optimizedPlan().toString().split("Filter")[-1]


def test_results_are_kept_in_chunks(monkeypatch):
    """Values come and go as Arrow arrays, and results are no list of a whole batch."""
    import pyarrow as pa

    monkeypatch.setattr(U, "CHUNK", 5)
    texts = ["ﬁ one", None, "", "two & three", "x"]
    got = U.normalize_udf().func(pa.array(texts))
    assert isinstance(got, pa.Array) and got.to_pylist() == [None if t is None else U.normalize_text(t) for t in texts]
    assert U.xz_udf().func(pa.array(texts)).type == pa.binary() and U.normalize_udf().func(pa.array([], pa.string())).to_pylist() == []


def test_a_short_text_needs_a_small_dictionary():
    import lzma

    for text in ("", "é\n" * 3, "ab" * 100_000):
        assert lzma.decompress(U.xz_bytes(text), memlimit=1 << 20).decode() == text
