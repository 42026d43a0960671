"""Alignment against a quadratic common subsequence and a plain rewriting of its rows; cuts of long streams; reports."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from textmill.operators import align as A
from textmill.operators import compare as C


def quadratic(x, y):
    best = [[0] * (len(y) + 1)]
    for a in x:
        row = [0]
        for j, b in enumerate(y):
            row.append(best[-1][j] + 1 if a == b else max(row[-1], best[-1][j + 1]))
        best.append(row)
    return best[-1][-1]


@pytest.mark.parametrize("bits", [A.BITS, 50])
def test_longest_common_subsequence(bits):
    rng = random.Random(1)
    for _ in range(300):
        x, y = (rng.choices("abcd"[: rng.randint(1, 4)], k=rng.randint(0, 40)) for _ in range(2))
        pairs = A.lcs(x, y, bits)
        assert all(x[i] == y[j] for i, j in pairs)
        assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:]))
        assert len(pairs) == quadratic(x, y)


def test_chain():
    rng = random.Random(2)
    for _ in range(100):
        js = rng.sample(range(50), rng.randint(0, 12))
        pairs = list(enumerate(js))
        best = 0
        for mask in range(1 << len(pairs)):
            picked = [j for k, (_, j) in enumerate(pairs) if mask >> k & 1]
            best = max(best, len(picked)) if picked == sorted(picked) else best
        got = A.chain(pairs)
        assert len(got) == best and [j for _, j in got] == sorted(j for _, j in got) and set(got) <= set(pairs)


def stream(rng, n, vocabulary=400):
    return [(f"w{int(rng.paretovariate(0.6)) % vocabulary}", rng.choice("NVA")) for _ in range(n)]


def edited(rng, tokens, rate=0.05):
    out = []
    for w, t in tokens:
        r = rng.random()
        if r < rate:
            out += rng.choice([[], [(w, t + "~")], [(w + "a", t), (w + "b", t)], [(w, t), ("new", "X")]])
        else:
            out.append((w, t))
    return out


def frame(spark, streams, order=None):
    rows = [(k, p, w, t, "c", 1) for k, s in streams.items() for p, (w, t) in enumerate(s)]
    (order or random.Random(0)).shuffle(rows)
    return spark.createDataFrame(rows, "`my doc` string, pos int, word string, tag string, code string, segment int").repartition(5)


def plain_rows(x, y, pairs):
    """The rows by the rule, from the places that agree."""
    out, a, b = [], 0, 0
    for i, j in [*pairs, (len(x), len(y))]:
        p, q = x[a:i], y[b:j]
        front, back = [], []
        while p and q and p[0][0] == q[0][0]:
            front.append(("C", p.pop(0), q.pop(0)))
        while p and q and p[-1][0] == q[-1][0]:
            back.insert(0, ("C", p.pop(), q.pop()))
        out += front + ([("I", p, q)] if p or q else []) + back
        if i < len(x):
            out.append(("S", x[i], y[j]))
        a, b = i + 1, j + 1
    return out


def written(row):
    code, p, q = row
    if code != "I":
        return (code, *p, *q)
    text = lambda part: " ".join(f"{w} {t}" for w, t in part) if part else None
    return (code, text(p), None, text(q), None)


def test_documents(spark):
    """Documents of one side, of none in common, with a null id, equal ones; each is a whole when it is short."""
    rng = random.Random(3)
    left = {f"d{k}": stream(rng, rng.randint(1, 80), 9) for k in range(12)} | {None: stream(rng, 30), "only left": stream(rng, 3), "equal": stream(rng, 5)}
    right = {k: edited(rng, s, 0.3) for k, s in left.items() if k != "only left"} | {"only right": stream(rng, 4), "equal": left["equal"]}
    rows = A.align(frame(spark, left), frame(spark, right), "my doc").collect()
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.segment, r.seq)):
        got[r["my doc"]].append(r)
    assert set(got) == set(left) | set(right)
    for k, rs in got.items():
        x, y = left.get(k, []), right.get(k, [])
        pairs = A.lcs(x, y)
        assert len(pairs) == quadratic(x, y)
        assert [(r.code, r.left, r.left_tag, r.right, r.right_tag) for r in rs] == [written(w) for w in plain_rows(list(x), list(y), pairs)]
        assert (sum(r.n_left for r in rs), sum(r.n_right for r in rs)) == (len(x), len(y))
        assert sum(r.error for r in rs) == len(re.findall("010|020", A.edit_codes(len(x), len(y), pairs)))


def test_a_long_document_is_cut_and_stays_minimal(spark):
    rng = random.Random(4)
    x = stream(rng, 30_000)
    y = edited(rng, x)
    y[9000:9000], y[20000:20040] = y[15000:15400], []  # a passage that is there twice, and one that is gone
    rows = A.align(frame(spark, {"a": x, "b": x[:50]}), frame(spark, {"a": y, "b": y[:40]}), "my doc", cut=1000)
    assert rows.filter(F.col("`my doc`") == "a").select("segment").distinct().count() > 15
    got = rows.groupBy("`my doc`").agg(F.count_if(F.col("code") == "S").alias("s"), F.sum("n_left").alias("l"), F.sum("n_right").alias("r"), F.count_if("error").alias("e")).collect()
    pairs = A.lcs(x, y)
    errors = len(re.findall("010|020", A.edit_codes(len(x), len(y), pairs)))
    whole = {r["my doc"]: (r.s, r.l, r.r) for r in got}
    assert whole == {"a": (len(pairs), len(x), len(y)), "b": (len(A.lcs(x[:50], y[:40])), 50, 40)}
    assert abs(next(r.e for r in got if r["my doc"] == "a") - errors) <= errors // 50  # of equal length, another alignment can be found
    words = [t.split(" ")[::2] if c == "I" else [t] for c, t in [(r.code, r.left) for r in rows.filter(F.col("`my doc`") == "a").orderBy("segment", "seq").collect()] if t]
    assert [w for part in words for w in part] == [w for w, _ in x]  # in order, none lost


def test_nothing(spark):
    some, none = frame(spark, {"a": stream(random.Random(5), 4)}), frame(spark, {"a": [("x", "y")]}).limit(0)
    assert A.align(none, none, "my doc").collect() == []
    assert [(r.code, r.n_left, r.n_right) for r in A.align(some, none, "my doc").collect()] == [("I", 4, 0)]
    assert [(r.code, r.n_left, r.n_right) for r in A.align(none, some, "my doc").collect()] == [("I", 0, 4)]


def test_reports(spark):
    x = {"a": [("the", "D"), ("cat", "N"), ("sat", "V"), ("on", "P"), ("mats", "N"), (".", "X")]}
    y = {"a": [("the", "D"), ("cat", "V"), ("sat", "V"), ("up", "A"), ("on", "P"), ("ma", "N"), ("ts", "N"), (".", "X")]}
    rows = A.align(frame(spark, x), frame(spark, y), "my doc")
    s = A.summary(rows).first()
    assert (s.compared, s.same, s.different, s.ignored, s.alone, s.errors, s.same_pct) == (5, 4, 1, 1, 1, 1, 80.0)
    assert [tuple(r) for r in A.differences(rows).collect()] == [("cat", "N", "V", 1, 100.0, 20.0)]
    assert [tuple(r) for r in A.difference_pairs(A.differences(rows)).collect()] == [("N", "V", 1, 100.0, 20.0)]
    assert [tuple(r) for r in A.ignored(rows).collect()] == [("mats N", "ma N ts N", 1, 100.0)]
    assert [(r.left, r.right) for r in A.error_rows(rows, "my doc").collect()] == [(None, "up A")]
    text = A.report({"second": rows}, C.tag_counts({"first": frame(spark, x), "second": frame(spark, y)}), "my doc")
    assert "| second | 5 | 4 | 1 | 1 | 1 | 1 | 80.00 | 20.00 |" in text and "| mats N | ma N ts N | 1 | 100.00 |" in text and "| N | 2 | 2 |" in text


def test_columns_are_the_rows_of_each_pair(monkeypatch):
    """All pairs of streams at once give what one pair at a time gives; streams that both sides share in one order need no rows of bits."""
    import numpy as np
    import pyarrow as pa

    rng = random.Random(6)
    some = lambda: [(rng.choice(["a", "b", "c", None, ""]), rng.choice(["N", "V", None])) for _ in range(rng.choice((0, 1, 2, 6, 25)))]
    pairs = [(some(), some()) for _ in range(400)] + [(s, edited(rng, s, 0.3)) for s in ([(f"{w}#{k}", t) for k, (w, t) in enumerate(stream(rng, n))] for n in (0, 1, 7, 90))]

    def side(streams):
        flat = [t for s in streams for t in s]
        return A.Side(np.cumsum([0, *map(len, streams)]), pa.array([w for w, _ in flat], pa.string()), pa.array([t for _, t in flat], pa.string()))

    def rows(pairs, columns, codes="SCI"):
        of, cells = A.aligned_columns(side([x for x, _ in pairs]), side([y for _, y in pairs]), columns, codes)
        return list(zip(of.tolist(), *(c.to_pylist() for c in cells), strict=True))

    want = [(k, n, *r) for k, (x, y) in enumerate(pairs) for n, r in enumerate(A.segment_rows(x, y, True))]
    columns = ("seq", "code", "error", *A.ROW)
    assert rows(pairs, columns) == want and sum(r[3] for r in want) > 20
    assert rows(pairs, columns, "I") == [r for r in want if r[2] == "I"]
    assert rows(pairs, ("code", "right_tag"), "SC") == [(r[0], r[2], r[8]) for r in want if r[2] != "I"]
    assert rows([], columns) == rows([([], [])], columns) == []
    monkeypatch.setattr(A, "lcs", None)
    assert rows(pairs[400:], columns) == [(k - 400, *r) for k, *r in want if k >= 400]


def test_long_rows_among_short_ones(spark):
    rng = random.Random(7)
    streams = [stream(rng, n, 30) for n in (40, 3, 0, 41, 40, 90, 5)]
    token = "array<struct<word:string,tag:string>>"
    df = spark.createDataFrame([(k, s, edited(rng, s, 0.2)) for k, s in enumerate(streams)], f"k long, left {token}, right {token}").coalesce(1)
    got = A.align_rows(df, "k", cut=60).groupBy("k").agg(F.sum("n_left"), F.sum("n_right")).collect()
    assert sorted(map(tuple, got)) == [(r.k, len(r.left), len(r.right)) for r in df.orderBy("k").collect() if r.left or r.right]


@pytest.mark.parametrize("name", ["align_pairs", "align_ignored"])
def test_streams_are_aligned_once(spark, name):
    import __spark_entry__ as entry

    df = entry.queries()[name](spark, "/root/testdata/sf0.001")
    assert df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
