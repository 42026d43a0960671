"""Names of keys, kinds of keys, and inputs at the edges of the operators."""

import hashlib
import random
import zlib
from itertools import combinations

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from textmill.llm import bpe, langcode, neardup, packed, quality, suffixdedup, unigram, urlrules, warc
from textmill.llm.common import Scratch

RANKS, VOCABULARY = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")


@pytest.mark.parametrize("key", ["my id", "a.b", "select", "ids"])
def test_keys_of_any_name(spark, key):
    texts = ["one two three four five six seven eight nine ten " * 3, "", None, "x"]
    df = spark.createDataFrame([(f"k{i}", t, "en") for i, t in enumerate(texts)], ["key", "text", "lang"]).withColumnRenamed("key", key)
    keys = {"k0", "k1", "k2", "k3"}
    assert {r[0] for r in bpe.encode_table(df, RANKS, P.PATTERN, lambda b, ids: (len(ids),), "n_tokens long", key=key).collect()} == keys
    assert {r[0]: r.n_words for r in quality.judge(df, key=key).collect()} == {"k0": 30, "k1": 0, "k2": 0, "k3": 1}
    assert {r[0]: r.n_tokens for r in unigram.token_counts(df, RANKS, P.PATTERN, key=key).collect()}.keys() == keys
    model = langcode.train(df, key=key)
    assert {r[0]: r.lang_pred for r in langcode.identify(df, model, key=key).collect()} == {"k0": "en", "k1": "und", "k2": "und", "k3": "en"}


def test_keys_that_are_no_numbers_are_refused(spark):
    df = spark.createDataFrame([("a1", "text")], "doc_id string, text string")
    with pytest.raises(TypeError, match="whole numbers"):
        packed.write_ids(df, VOCABULARY, 2, Scratch(spark))
    with pytest.raises(TypeError, match="whole numbers"):
        neardup.near_duplicates(df)


def test_special_strings_are_text_and_large_files_flush(spark, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packed, "GROUP", 2)  # a flush for each two blocks
    library = Tokenizer.from_file(VOCABULARY)
    library.encode_special_tokens = True
    special = list(Tokenizer.from_file(VOCABULARY).get_added_tokens_decoder().values())
    texts = [f"a {t.content} b" for t in special] + ["word " * 40_000, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    got = packed.read_ids(spark, packed.write_ids(df, VOCABULARY, 2, Scratch(spark))).collect()
    start = 0
    for r in sorted(got, key=lambda r: r.doc_id):
        ids = [*library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_rules_that_ignore_case():
    """Letters that have other cases outside ASCII are in no token of a rule, so no rule is missed."""
    assert urlrules.literal_tokens(r"(?i)/kasino/") == () and urlrules.literal_tokens(r"(?ai)/kasino/") == ("kasino",)
    assert urlrules.literal_tokens(r"(?i)/porn/") == ("porn",) and urlrules.literal_tokens(r"/kasino/") == ("kasino",)


def test_bounds_of_urls_with_nul_sort_as_records_do():
    rng = random.Random(1)
    urls = ["".join(rng.choices(["a", "\x00", "!", "%00", "http://", "x.org", "/"], k=rng.randint(0, 6))) for _ in range(300)]
    rows = [(warc.url_key(u), "2000", True, i, "f", 0, 1) for i, u in enumerate(urls)]
    assert [r[3] for r in sorted(rows)] == [r[3] for r in sorted(rows, key=warc._bound)]


def test_windows_that_do_not_fit_are_refused(spark):
    df = spark.createDataFrame([(1, "x" * 3000)], "doc_id long, text string")
    with pytest.raises(ValueError, match="bytes long"):
        suffixdedup.removal_digests(df, length=1500).collect()
    assert suffixdedup.removal_digests(df, length=1000).first().n_removed == 3000


def test_recall_on_a_larger_table(spark):
    """Every link of at least 0.85, by comparing all pairs that share a shingle."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    sets, where = {}, {}
    for r in docs:
        words = (r.text or "").translate({c: c + 32 for c in range(65, 91)}).translate(dict.fromkeys(range(9, 14), 32)).split(" ")
        words = [w for w in words if w]
        sets[r.doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
        for s in sets[r.doc_id]:
            where.setdefault(s, []).append(r.doc_id)
    pairs = {p for ids in where.values() for p in combinations(sorted(ids), 2)}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = 0
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
            links += 1
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert links > 50
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.op10_near_duplicates(spark, sf).collect()}
    assert got == {i: (len(s), find(i)) for i, s in sets.items()}


def test_quality_columns_by_hand(spark):
    cases = {"a b\n\na b\n a b\n#$ %": (8, 9, 3, 1), "é日 é\té": (3, 4, 0, 0), "x\r\nx\r\n": (2, 2, 0, 1), "<|>&*[]": (1, 7, 5, 0), " \n \n": (0, 0, 0, 0)}
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) for r in quality.judge(df).collect()}
    assert got == dict(enumerate(cases.values()))


def test_pipeline_at_the_edges(spark, tmp_path):
    """All stages over no rows, and over very long texts, nulls and columns with names that the operators use."""
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 9))) for _ in range(4000)]
    long = " ".join(rng.choices(words, k=60_000))
    texts = [long, long + " end", None, "", " ".join(rng.choices(words, k=200)), "x"]
    rows = [(i, t, "en", "s", 1, 5, 6, "d", 7, "p", 8) for i, t in enumerate(texts)] + [(None, " ".join(rng.choices(words, k=150)), "en", "s", 1, 5, 6, "d", 7, "p", 8)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row long, key int, digest string, place long, packed string, n int"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == {0, 4, None}
    assert got[0].decoded_sha256 == hashlib.sha256(long.encode()).hexdigest()
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.schema.names == [x.split()[0] for x in schema.split(", ")]
    none = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, str(tmp_path))
        assert none.count() == 0


def test_token_counts_by_brute_force(spark):
    """Every pre-token of whole texts spelt by its own dynamic program, without a trie."""
    import regex

    scores = unigram.rank_scores(bpe.read_ranks(RANKS))

    def pieces(word: bytes) -> int:
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            best.append(max((best[s][0] + scores[word[s:end]], best[s][1] - 1) for s in range(max(0, end - 40), end) if word[s:end] in scores))
        return -best[-1][1]

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-1, "aaaa" * 50 + " it's 12345 \t\n  日本語 ﬁ!!"), (-2, None), (-3, "")], "doc_id long, text string")
    rows = docs.limit(40).union(extra).collect()  # a fixture: brute force is slow
    got = {r.doc_id: (r.n_pretokens, r.n_tokens) for r in unigram.token_counts(spark.createDataFrame(rows, "doc_id long, text string"), RANKS, P.PATTERN).collect()}
    for r in rows:
        parts = [p.encode() for p in regex.findall(P.PATTERN, r.text or "")]
        assert got[r.doc_id] == (len(parts), sum(map(pieces, parts)))


@pytest.mark.parametrize("n", [2, 4, 9])
def test_decoding_by_hand(n):
    """Losses of all codewords, one by one; the least one wins, and its share of the odds is the score."""
    import math

    rng = np.random.default_rng(n)
    code = langcode.codewords(n)
    trust = rng.random(code.shape) + 0.1
    trust /= trust.sum(axis=1, keepdims=True)
    model = langcode.Model([f"l{k}" for k in range(n)], code, np.zeros((code.shape[1], langcode.FEATURES), np.float32), np.zeros(code.shape[1]), trust)
    margins = rng.normal(size=(30, code.shape[1])) * 3
    got = model.decode(margins)
    for row, odds in zip(margins, got, strict=True):
        losses = [sum(trust[k][b] * math.log1p(math.exp(-row[b] * code[k][b])) for b in range(code.shape[1])) for k in range(n)]
        weights = [math.exp(-4 * x) for x in losses]
        assert np.allclose(odds, np.array(weights) / sum(weights)) and odds.argmax() == losses.index(min(losses))
    # margins are means of weights over the n-grams of a text
    model.weights[:] = rng.normal(size=model.weights.shape)
    texts = ["Ab c", "é", "", "the cat sat"]
    for text, row in zip(texts, model.margins(texts), strict=True):
        grams, starts = langcode._grams([text])
        assert np.allclose(row, [np.mean([model.weights[k][f] for g in grams for f in g[: len(grams[0])]]) for k in range(code.shape[1])], atol=1e-4)
