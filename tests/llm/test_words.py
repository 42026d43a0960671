"""Spelling variants, secret scans and collocations against brute force, on odd tables too."""

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import duckdb
import numpy as np
import pytest

from textmill.llm import collocations, novelty, spelling
from textmill.llm.common import Scratch

SCHEMA = "doc_id long, text string, lang string, word string, n int, key string, gap string, phrase string, base string, spans string"


def table(spark, texts, langs=None):
    rows = [(i, t, langs[i] if langs else "en", "w", 1, "k", "g", "p", "b", "s") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


# spelling variants


def counted(texts):
    words = Counter()
    for t in texts:
        words.update(re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""))
    return {w: n for w, n in words.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(words):
    forms, out = {}, set()
    for w, n in words.items():
        others = [(-m, v) for v, m in words.items() if near(w, v)]
        best = min(others, default=(0, None))
        forms[w] = (best[1], -best[0]) if best[1] and -best[0] >= 5 * n else (None, None)
        out.add((w, n, len(others)))
    rows = set()
    for w, n, count in out:
        root = w
        while forms[root][0]:
            root = forms[root][0]
        rows.add((w, forms[w][0], root, n, count, forms[w][1]))
    return rows


def spelled_texts():
    rng = random.Random(4)
    pool = ["".join(rng.choices("abé", k=rng.randint(5, 8))) for _ in range(60)]  # many near words of equal letters
    chain = ["aabbaabb"] * 700 + ["aabbaab"] * 130 + ["aabbaa"] * 25 + ["aabbca"] * 5  # forms of forms
    tied = ["zzzzzza"] * 40 + ["zzzzzzb"] * 40 + ["zzzzzz"] * 8 + ["Ézzzzz"] * 5 + ["ézzzzz"] * 6
    words = rng.choices(pool, k=2500) + chain + tied
    rng.shuffle(words)
    texts = [" ".join(words[i : i + 100]).upper().replace("É", "é") if i % 300 == 0 else " ".join(words[i : i + 100]) for i in range(0, len(words), 100)]
    return [*texts, None, "", "short x", "a" * 50_000, *["tie-breaker's"] * 6, texts[1], texts[1]]


def test_spelling_groups(spark):
    texts = spelled_texts()
    words = spelling.count_words(table(spark, texts))
    assert {(r.word, r.n) for r in words.collect()} == set(counted(texts).items())
    got = spelling.group_spellings(words, Scratch(spark)).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == grouped(counted(texts))
    assert {r.root for r in got if r.word in ("aabbca", "aabbaa", "aabbaab")} == {"aabbaabb"}  # three steps


def test_spelling_of_nothing(spark):
    assert spelling.group_spellings(spelling.count_words(table(spark, [None, "", "a b"])), Scratch(spark)).collect() == []
    assert spelling.group_spellings(spelling.count_words(table(spark, ["x"]).limit(0)), Scratch(spark)).collect() == []


def test_spelling_query_and_sql(spark):
    sf = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    duck.sql(f"create view documents as from '{sf}/documents.parquet'")
    want = duck.sql(f"select word, form, root, n, n_near, form_n from ({spelling.ORACLE_SQL['op11_spelling_variants']})").fetchall()
    assert sorted(map(tuple, spelling.op11_spelling_variants(spark, sf).collect())) == sorted(want)
    # the checksum and the deleted letter, apart from Spark and SQL
    words = Counter()
    for i, t in duck.sql("select doc_id, text from documents").fetchall():
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            h = zlib.crc32(f"{i}:{w}".encode())
            words[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 199 == 0 else w] += 1
    assert {(r[0], r[3]) for r in want} == {(w, n) for w, n in words.items() if len(w) >= 6 and n >= 5}


# secrets


def plain_base(text):
    """Maximal runs and prefixes by hand, without the patterns of the operator."""
    out = []
    for kind, pattern, group, least in (("assign", r"(password|passwd|secret|token|apikey|api_key)([\"'])?( )*[:=]( )*([\"'])?([A-Za-z0-9+/_.=-]+)", 6, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24)):
        at = 0
        found = re.compile(pattern, re.ASCII | (re.IGNORECASE if kind == "assign" else 0))
        while m := found.search(text, at):
            at = m.end()
            if len(m[group]) >= least:
                out.append((m.start(), ("assign", "access", "hex").index(kind), f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x for *_, x in sorted(out))


def secret_texts():
    rng = random.Random(3)
    hexes, letters = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rand = lambda abc, n: "".join(rng.choices(abc, k=n))
    prose = "the station master of the northern line said that international communication would be restored before the evening "
    texts = [None, "", "a", prose * 3, f"é token = \"{rand(hexes, 40)}\" 日", f"PassWord: abc password=12345 password={rand(letters, 18)}", f"x AKIA{rand('ABCDEFGH', 16)} AKIAABC AKIAAKIA{rand('Z9', 12)}", rand(hexes, 23) + " " + rand(hexes, 24), "api_key='short' apikey = longer7", "secret  ==  x=y=z=w", prose * 2000 + f"token:{rand(letters, 20)}"]
    novel = [f"Authorization bearer {rand(letters, 40)}", f"private signature \n key {rand(letters, 32)} {prose}", f"client credential {rand(letters, 24)}", f"session cookie: {rand(letters, 48)}"]
    clean = [f"the session key internationalcommunication {prose}", f"auth module restored-before-the-evening {prose}", f"signature of northernnorthernnorthern {prose}", f"no such word here {rand(letters, 40)}", f"key on the line before\n{rand(letters, 40)}", "token of the evening", "key northern-line/station-master", f"signature 2nd-{'northern-line-northern-line-' * 2}"]
    return texts, novel, clean


def test_secrets(spark):
    texts, novel, clean = secret_texts()
    prose = "the station master of the northern line said that international communication would be restored before the evening"
    df = table(spark, [*texts, *novel, *clean, *[prose] * 3, texts[4], texts[4]])
    rows = novelty.find_secrets(df).collect()
    assert len(rows) == df.count()
    by_text = {r.doc_id: r for r in rows}
    for i, t in enumerate([*texts, *novel, *clean]):
        r = by_text[i]
        assert r.base == plain_base(t or ""), t
        assert [r.n_assign, r.n_access, r.n_hex] == [r.base.count(k + ":") for k in ("assign", "access", "hex")]
        assert set(filter(None, r.base.split(","))) <= set(r.spans.split(","))  # base spans stay
        starts = [int(s.split(":")[1]) for s in filter(None, r.spans.split(","))]
        assert starts == sorted(starts)
    for k, t in enumerate(novel):
        (start, end) = max((m.span() for m in re.finditer(r"[A-Za-z0-9]{24,}", t)), key=lambda s: s[1] - s[0])
        assert by_text[len(texts) + k].spans == f"novel:{start}:{end}", t
    for k, t in enumerate(clean):
        assert by_text[len(texts) + len(novel) + k].spans == by_text[len(texts) + len(novel) + k].base, t


def test_secrets_of_nothing(spark):
    assert novelty.find_secrets(table(spark, ["x"]).limit(0)).collect() == []
    odd = spark.createDataFrame([("a1", "password=abcdefgh"), (None, None)], "`my id` string, spans string")
    assert sorted((r["my id"] or "", r.spans) for r in novelty.find_secrets(odd, "my id", "spans").collect()) == [("", ""), ("a1", "assign:0:17")]


def test_novelty_of_words_and_noise():
    rng = random.Random(8)
    words = ["".join(rng.choices("aeiournstl", k=rng.randint(5, 9))) for _ in range(500)]
    measure = novelty.Novelty(" ".join(words).encode())
    around = " ".join(words[:20])
    share = lambda x: measure.cost(around, x, around) / len(x)
    known = sorted(share("_".join(rng.sample(words, 4))) for _ in range(50))
    noise = sorted(share("".join(rng.choices("ABCDEFGHIJKLMNOPqrstuvwxyz0123456789", k=30))) for _ in range(50))
    assert known[25] < novelty.NOVELTY <= noise[5]  # the median of known words; nine in ten random strings
    assert measure.cost("", "", "") == 0


# collocations


def phrases_of(texts, langs, longest=5):
    counts, total = defaultdict(Counter), Counter()
    for t, lang in zip(texts, langs, strict=True):
        lang = lang or "und"
        t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", t):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, longest + 1):
                    if i + k <= len(words):
                        counts[lang][tuple(words[i : i + k])] += 1
    return counts, total


def best_phrases(texts, langs, least=100, top=2000, percent=100):
    counts, total = phrases_of(texts, langs)
    out = []
    for lang, found in counts.items():
        often = {p: a for p, a in found.items() if a >= least}
        inner = set()
        for p, f in often.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p) and 100 * f >= percent * often[p[i:j]]:
                        inner.add(p[i:j])
        rows = []
        for p, a in often.items():
            if len(p) > 1 and p not in inner:
                score, k = min((1000 * a * total[lang] // (often[p[:k]] * often[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), often[p[:k]], often[p[k:]], score))
        out += [(lang, r + 1, x[2].decode(), -x[1], x[3], x[4], total[lang], x[5]) for r, x in enumerate(sorted(rows)[:top])]
    return sorted(out)


def phrase_texts():
    rng = random.Random(5)
    vocabulary = ["a", "b", "é", "D", "\x00e", "f g", "o'h", "日本", "i-j", "kk"]
    texts = ["".join(rng.choice(vocabulary) + rng.choice([" "] * 12 + ["\t", ", ", ".", "\n", ";", " ! ", "\r", "\x0b", "\x0c"]) for _ in range(rng.randint(1, 300))) for _ in range(60)]
    texts += ["new york city is big", "New  York\tCity is"] * 30 + ["x x x x x x x"] * 20 + [None, "", " . , ", "lone"]
    return texts, [rng.choice(["en", "fr", None]) for _ in texts]


@pytest.mark.parametrize("least", [2, 40])
def test_collocations(spark, least, monkeypatch):
    monkeypatch.setattr(collocations, "SHARD_BYTES", 2_000)  # many shards
    texts, langs = phrase_texts()
    got = collocations.collocations(table(spark, texts, langs), Scratch(spark), least=least, top=50)
    assert sorted(map(tuple, got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())) == best_phrases(texts, langs, least, 50)


def test_collocations_with_a_full_bitmap(spark, monkeypatch):
    monkeypatch.setattr(collocations, "MAX_BITS", 64)  # prunes next to nothing; the result stays
    texts, langs = phrase_texts()
    got = collocations.collocations(table(spark, texts, langs), Scratch(spark), least=30, percent=80)
    assert sorted(map(tuple, got.collect())) == best_phrases(texts, langs, 30, percent=80)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(table(spark, [None, ""]), Scratch(spark)).collect() == []
    assert collocations.collocations(table(spark, ["x"]).limit(0), Scratch(spark)).collect() == []


def test_scores_pass_64_bits(spark):
    rows = [("en", 0, "", 9 * 10**17), ("en", 1, "a", 3 * 10**12), ("en", 1, "b", 7 * 10**12 + 1), ("en", 2, "a b", 2 * 10**12)]
    (r,) = collocations.weakest_cuts(spark.createDataFrame(rows, "lang string, size int, phrase string, count long")).collect()
    assert (r.l, r.r, r.score) == (3 * 10**12, 7 * 10**12 + 1, 1000 * 2 * 10**12 * 9 * 10**17 // (3 * 10**12 * (7 * 10**12 + 1)))


def test_suffix_order_of_runs():
    rng = np.random.default_rng(2)
    for _ in range(50):
        ids = rng.integers(0, 4, 60)
        joined = np.r_[rng.random(59) < 0.8, False]
        ends = [next(j for j in range(i, 60) if not joined[j]) for i in range(60)]
        room = np.array([e - i + 1 for i, e in enumerate(ends)])
        order = collocations.suffix_order(ids, room, 5)
        cut = [tuple(ids[i : min(ends[i] + 1, i + 5)]) for i in order]
        assert cut == sorted(cut)
        shared = collocations.common_prefixes(ids, room, order, 5)
        for (a, b), n in zip(pairwise(cut), shared[1:], strict=True):
            assert n == next((k for k in range(5) if k >= min(len(a), len(b)) or a[k] != b[k]), 5)


def test_collocations_query_and_sql(spark):
    sf = "/root/testdata/sf0.01"
    duck = duckdb.connect()
    duck.sql(f"create view documents as from '{sf}/documents.parquet'")
    want = duck.sql(f"select lang, rank, phrase, a, l, r, n, score from ({collocations.ORACLE_SQL['op13_collocations']})").fetchall()
    assert len(want) > 20
    assert sorted(map(tuple, collocations.op13_collocations(spark, sf).collect())) == sorted(want)
