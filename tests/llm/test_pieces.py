"""The parts of the training-data operators against brute force."""

import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest

from textmill.llm import bpe, decontam, langcode, neardup, packed, quality, suffixdedup, unigram, urlrules, warc, words


@pytest.fixture(scope="module")
def encoder():
    return bpe.ByteBPE(bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), P.PATTERN)


def test_bpe_is_as_the_library(encoder):
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})
    rng = random.Random(1)
    for alphabet, longest in (("ab  \n\t'sS1é\u00a0\x1c\u2028。,.!", 14), ("thequickbrownaeioust", 200)):
        for _ in range(1500):
            t = "".join(rng.choices(alphabet, k=rng.randint(0, longest)))
            ids = encoder.encode(t)
            assert ids == library.encode_ordinary(t)
            assert encoder.decode(ids).decode() == t
    long = "a" * 20_000 + "xy" * 5_000
    assert encoder.encode(long) == library.encode_ordinary(long)


def test_lower_rank_that_comes_up_goes_first():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 600, b"abc": 500, b"cd": 550, b"xx": 700, b"xxxx": 650}
    for text in (b"abcd", b"abab", b"xxxxxx", b"abcabcd"):
        parts = [text[i : i + 1] for i in range(len(text))]
        while True:
            pairs = [(ranks.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]  # noqa: B905
            if not pairs or min(pairs)[0] == 1 << 30:
                break
            i = min(pairs)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert text in ranks or bpe.merge(text, ranks) == [ranks[p] for p in parts]


def test_simple8b_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 4095, 4096, 4097, 20_000):
        for high in (1, 2, 50_257, 1 << 31, 1 << 63):
            ids = rng.integers(0, high, n, dtype=np.uint64)
            if n > 50:
                ids[10 : n // 2] = 0
                ids[rng.integers(0, n, 3)] = 2**62 + 7  # escapes
            escapes = []
            coded, first = packed.pack(ids, escapes)
            assert (packed.unpack(coded, first, n, np.array(escapes, np.uint64)) == ids).all()


def test_loser_tree():
    rng = random.Random(2)
    for _ in range(300):
        runs = [sorted((rng.randint(0, 9), i) for i in range(rng.randint(0, 8))) for _ in range(rng.randint(0, 9))]
        assert list(warc.merge_runs(runs)) == sorted(x for r in runs for x in r)


def test_repeats_in_texts():
    rng = random.Random(3)
    for _ in range(100):
        docs = [[bytes([97 + rng.randint(0, k)]) for _ in range(rng.randint(0, 50))] for k in rng.choices([1, 2, 5], k=rng.randint(0, 5))]
        covered, longest = quality.repeat_figures(docs)
        for d, c, l in zip(docs, covered.tolist(), longest.tolist(), strict=True):
            seen = Counter(tuple(d[i : i + 8]) for i in range(len(d) - 7))
            spots = {j for i in range(len(d) - 7) if seen[tuple(d[i : i + 8])] > 1 for j in range(i, i + 8)}
            best = 0
            for n in range(len(d), 7, -1):
                if max(Counter(tuple(d[i : i + n]) for i in range(len(d) - n + 1)).values(), default=0) > 1:
                    best = n
                    break
            assert (c, l) == (len(spots), best)


def test_windows_of_items():
    rng = random.Random(5)
    for _ in range(200):
        vocabulary = ["a", "B", "cé", "d1", "日"][: rng.choice([2, 3, 5])]
        items = [(str(i), " ".join(rng.choices(vocabulary, k=rng.randint(0, 9)))) for i in range(5)]
        texts = [rng.choice([" ", ", ", "-"]).join(rng.choices(vocabulary, k=rng.randint(0, 40))) for _ in range(4)] + [None, ""]
        index = decontam.Index([(i, decontam.item_words(t)) for i, t in items], {}, 4)
        n_words, n_hit, _, found = decontam._slice_hits(index, texts)
        for k, t in enumerate(texts):
            w, spots, names = decontam.item_words(t), set(), set()
            for name, item in items:
                iw = decontam.item_words(item)
                for x in [iw[a : a + 4] for a in range(max(1, len(iw) - 3))] if iw else []:
                    for s in range(len(w) - len(x) + 1):
                        if w[s : s + len(x)] == x:
                            spots.update(range(s, s + len(x)))
                            names.add(name)
            assert (n_words[k], n_hit[k], {index.names[j] for j in found[k]}) == (len(w), len(spots), names)


def test_best_spellings(encoder):
    scores = unigram.rank_scores(encoder.ranks)
    rng = random.Random(6)
    words_ = {bytes(rng.choices(b"thequickaeio s", k=rng.randint(1, 14))) for _ in range(200)} | {b"a", "é日".encode()}
    got = unigram.Unigram(scores).counts(words_)
    for w in words_:
        best = [(0.0, 0)]
        for e in range(1, len(w) + 1):
            best.append(max((best[s][0] + scores[w[s:e]], best[s][1] - 1) for s in range(e) if w[s:e] in scores))
        assert got[w] == -best[-1][1]


def test_shingles():
    texts = ["A b c d e f", "a B  c\td e F", "one two", None, "", " \n", "x x x x x x x"]
    values, counts = words.shingles(texts, 5)
    assert counts.tolist() == [2, 2, 1, 0, 0, 0, 1]
    assert (values[:2] == values[2:4]).all()
    assert len(set(values.tolist())) == 4


def test_columns_against_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(60):
        n, width, length, columns = 12, 14, 5, 9
        table = rng.integers(1, 3, (n, width)).astype(np.uint16)
        for row in table:
            row[: rng.integers(0, 4)] = 0
            row[width - rng.integers(0, 4) :] = 0
        group = np.sort(rng.integers(0, 3, n))
        got = suffixdedup.columns_repeat(group, table, length, columns)
        for i in range(n):
            for c in range(columns):
                w = table[i, c : c + length]
                again = any(j != i and group[j] == group[i] and (table[j, c : c + length] == w).all() for j in range(n))
                assert got[i, c] == (w.min() > 0 and again)


def test_codewords():
    for n in (1, 2, 4, 6, 20):
        code = langcode.codewords(n)
        assert code.shape[0] == n
        assert n == 1 or len({tuple(r) for r in code.tolist()}) == n
    assert langcode.codewords(4).shape[1] == 7


def test_url_rules():
    index = urlrules.RuleIndex(urlrules.DEFAULT_PATTERNS, urlrules.QUERY_HOST_RULES, {})
    judge = lambda u: index.judge(u)[2:]
    assert judge("http://a.EXAMPLE.net/en/x") == ("example.net/en/", "allow")
    assert judge("http://example.net/de") == ("net/", "block")
    assert judge("http://notexample.com/de/") == (None, "allow")
    assert judge("http://x.org/fr/?q") == ("org/fr/", "allow")
    assert judge("http://my-casino.com/") == (None, "block")
    assert judge("http://casinos.com/") == (None, "allow")
    assert judge("http://net") == (None, "allow")
    assert index.judge(None) == index.judge("") == ("", "", None, "allow")
    assert index.judge("no scheme casino")[:3] == ("", "", None)


def test_literal_tokens():
    for expr, want in {
        r"(?<![a-z0-9])casino(?![a-z0-9])": ("casino",), r"(?<![a-z0-9])cheap\-pills(?![a-z0-9])": ("cheap", "pills"), r"\.exe\Z": ("exe",), r"casino": (), r"/ads?/": (), r"/ads/x*y/": ("ads",),
        r"\A(?:a|b)\.foo-": ("foo",), r"[-/.]track[-/]": ("track",), r"(?<![a-z0-9])foo": (), r"foo(?![a-z0-9])bar-": (), r"-foo.bar-": (), r"(?<![a-z])foo-": (), r"/(foo)/bar/": ("bar",), r"^foo$": (), r"\Afoo\Z": ("foo",),
    }.items():
        assert urlrules.literal_tokens(expr) == want, expr


def test_patterns_by_brute_force():
    """Rules fetched by their rarest token decide as all rules would."""
    rng = random.Random(12)
    rules = [*urlrules.DEFAULT_PATTERNS, urlrules.Pattern(r"/ads/[0-9]+", "block"), urlrules.Pattern(r"[?&]ref=spam(?![a-z0-9])", "block"), urlrules.Pattern(r"(?<![a-z0-9])edu(?![a-z0-9])", "allow", "host"), urlrules.Pattern(r"x{3}", "block", "path")]
    index = urlrules.RuleIndex(rules, (), {"casino": 5, "cheap": 9})
    import re

    words = ["casino", "edu", "a.EXE", "cheap-pills", "cheap", "ads/12", "xxx", "?ref=spam", "&ref=spammy", "news", ".zip", "com", "#x"]
    for _ in range(3000):
        url = "".join(rng.choice(words) + rng.choice(["/", ".", "-", "", "?", "://"]) for _ in range(rng.randint(0, 6)))
        host, path = urlrules.split_url(url)
        parts = {"host": host, "path": path.lower(), "url": url.lower()}
        verdicts = {p.verdict for p in rules if re.search(p.expr, parts[p.part])}
        assert index.judge(url) == (host, path, None, "block" if verdicts == {"block"} else "allow")
    assert index.judge("https://news.example.org/read?next=http://casino.com/")[3] == "allow"


def test_layout():
    """The tables at 85 per cent, and the bounds at others."""
    assert neardup.layout(85) == neardup.Layout(2, 8, 16)
    for percent in (50, 60, 70, 80, 85, 90, 95, 100):
        plan, s = neardup.layout(percent), percent / 100
        assert 1 - (1 - (1 - s**plan.width) ** plan.groups) ** 2 <= 1e-4
        rng = np.random.default_rng(percent)
        assert (rng.random((20_000, plan.minhashes)) < s).sum(axis=1).min() >= plan.agree


def test_prefixes_of_similar_sets():
    """Sets that are similar enough share a prefix token at places that allow it, in any order of the tokens."""
    rng = np.random.default_rng(8)
    for _ in range(300):
        n, percent = int(rng.integers(1, 60)), int(rng.choice([50, 80, 85, 100]))
        base = rng.integers(0, 1 << 62, 70, dtype=np.uint64) << np.uint64(2)
        counts = rng.integers(0, 4, neardup.SLOTS).astype(np.uint32)
        x = np.unique(base[:n])
        y = np.unique(np.r_[base[int(rng.integers(0, 3)) : n], base[n : n + int(rng.integers(0, 5))]])
        both = len(np.intersect1d(x, y))
        a, b = neardup.prefix(x, counts, percent), neardup.prefix(y, counts, percent)
        spots = [(i, j) for i, t in enumerate(a.tolist()) for j, o in enumerate(b.tolist()) if t == o]
        if both and 100 * both >= percent * (len(x) + len(y) - both):
            assert any(neardup._fits(len(x), len(y), i, j, percent, min, max) for i, j in spots)
