"""Alignment of two taggings of the same texts, and the reports of a comparison.

Streams are cut at anchors, so that a document of any length is many tasks' work: runs of SHINGLE tokens (word and tag) that occur
once on either side, thinned to one for each CUT tokens, of which a longest chain in both orders is kept (patience). Between
two cuts a longest common subsequence is computed exactly, by rows of bits, in linear space where the rows would be large. A
document of at most CUT tokens on both sides is never cut, so its alignment is a longest common subsequence of the whole;
a cut can only lose by it where an anchor is no part of any longest one. Tokens are numbered, dealt out and cut by ranges of
their numbers, never by document, so one document may be the whole table; only its cuts (one for each CUT tokens) meet in a task.

Defined results: a null key is a key; null words and tags are values that equal each other; a document that only one side has
has rows of that side; an empty side gives what the other one has alone; ties in `order` are told apart by their columns.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from textmill.operators.corpus import global_positions
from textmill.plans.scratch import Scratch

#: Tokens of an anchor; tokens for each cut; one anchor of so many is looked at; bits of rows that are held at once.
SHINGLE, CUT, THIN, BITS = 8, 20_000, 32, 1 << 29
#: Tokens of both sides of the rows that are aligned before theirs are given back; a row is never taken apart.
PACK = 1 << 17
#: Rows whose streams are made at once: a batch has up to 10,000, whose streams would be some hundred MB.
READ = 64
#: What each side has in a row, beside its code and error.
ROW = ("left", "left_tag", "n_left", "right", "right_tag", "n_right")
#: All columns of an alignment beside the key, and their types.
TYPES = {"segment": pa.int64(), "seq": pa.int64(), "code": pa.string(), "error": pa.bool_(), **{c: pa.int64() if c.startswith("n_") else pa.string() for c in ROW}}


def _rows(x: list, y: list) -> list[int]:
    """Row i has a 0 bit at each place of y where the common subsequence of x[:i] and y up to there grows."""
    full, masks = (1 << len(y)) - 1, {}
    for j, b in enumerate(y):
        masks[b] = masks.get(b, 0) | 1 << j
    v, out = full, [full]
    for a in x:
        u = v & masks.get(a, 0)
        v = ((v + u) | (v - u)) & full
        out.append(v)
    return out


def _last_row(x: list, y: list) -> np.ndarray:
    """The lengths of common subsequences of x and each prefix of y."""
    full, masks = (1 << len(y)) - 1, {}
    for b in set(x).intersection(y):
        masks[b] = 0
    for j, b in enumerate(y):
        if b in masks:
            masks[b] |= 1 << j
    v = full
    for a in x:
        if u := v & masks.get(a, 0):
            v = ((v + u) | (v - u)) & full
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(y) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(y)]
    return np.r_[0, np.cumsum(1 - bits.astype(np.int64))]


def lcs(x: list, y: list, bits: int = BITS) -> list[tuple[int, int]]:
    """The places of a longest common subsequence in x and in y, ascending."""
    out, todo = [], [(0, len(x), 0, len(y))]
    while todo:  # parts in any order; sorted at the end
        a, b, c, d = todo.pop()
        while a < b and c < d and x[a] == y[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and x[b - 1] == y[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        if (b - a) * (d - c) > bits and b - a > 1:
            half = (a + b) // 2
            ahead, behind = _last_row(x[a:half], y[c:d]), _last_row(x[half:b][::-1], y[c:d][::-1])[::-1]
            at = c + int(np.argmax(ahead + behind))
            todo += [(a, half, c, at), (half, b, at, d)]
            continue
        common = set(x[a:b]).intersection(y[c:d])  # what one side alone has is passed over by the way back
        p, q = [k for k in range(a, b) if x[k] in common], [k for k in range(c, d) if y[k] in common]
        rows, i, j = _rows([x[k] for k in p], [y[k] for k in q]), len(p), len(q)
        while i and j:
            if rows[i] >> (j - 1) & 1:
                j -= 1
            elif rows[i - 1] >> (j - 1) & 1:
                i, j = i - 1, j - 1
                out.append((p[i], q[j]))
            else:
                i -= 1
    return sorted(out)


def edit_codes(n: int, m: int, pairs: list[tuple[int, int]]) -> str:
    """A code for each line of a difference of n and m lines: 0 both, 1 left only, 2 right only; the left goes first."""
    out, a, b = [], 0, 0
    for i, j in [*pairs, (n, m)]:
        out.append("1" * (i - a) + "2" * (j - b) + ("0" if i < n or j < m else ""))
        a, b = i + 1, j + 1
    return "".join(out)


def segment_rows(x: list[tuple], y: list[tuple], last: bool) -> list[tuple]:
    """code, error, left, left_tag, n_left, right, right_tag and n_right of the rows of two token streams of (word, tag).

    S: word and tag agree. Where a run of the left meets a run of the right, words that agree from the front and then from the
    back are C; the rest is one I row, the tokens of each side written out with their tags. A run alone is an I row with a null side.
    error: a single token alone between tokens that agree (010 or 020 in the codes, matches apart). last: nothing follows.
    """
    codes = edit_codes(len(x), len(y), pairs := lcs(x, y))
    wrong = {m.start() + 1 for m in re.finditer("010|020", codes + ("" if last else "0"))}
    text = lambda part: " ".join(f"{w} {t}" for w, t in part) if part else None
    rows, a, b, at = [], 0, 0, 0
    for i, j in [*pairs, (len(x), len(y))]:
        p, q = x[a:i], y[b:j]
        least = min(len(p), len(q))
        front = next((k for k in range(least) if p[k][0] != q[k][0]), least)
        back = next((k for k in range(least - front) if p[-1 - k][0] != q[-1 - k][0]), least - front)
        rows += [("C", False, *v, 1, *w, 1) for v, w in zip(p[:front], q[:front], strict=True)]
        u, w = p[front : len(p) - back], q[front : len(q) - back]
        if u or w:
            rows.append(("I", at in wrong, text(u), None, len(u), text(w), None, len(w)))
        rows += [("C", False, *v, 1, *z, 1) for v, z in zip(p[len(p) - back :], q[len(q) - back :], strict=True)]
        if i < len(x):
            rows.append(("S", False, *x[i], 1, *y[j], 1))
        at += len(p) + len(q) + 1
        a, b = i + 1, j + 1
    return rows


def chain(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest part of the pairs that ascends on both sides, strictly."""
    ends, at, before = [], [], {}
    for k, (_, j) in enumerate(pairs := sorted(pairs)):
        place = bisect_left(ends, j)
        ends[place:] = [j, *ends[place + 1 :]] if place < len(ends) else [j]
        at[place:] = [k, *at[place + 1 :]] if place < len(at) else [k]
        before[k] = at[place - 1] if place else None
    out, k = [], at[-1] if at else None
    while k is not None:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def _shingles(side: DataFrame, cut: int, size: int, thin: int) -> DataFrame:
    """key, hash and at of one in `thin` of the runs of `size` tokens of a key that occur once in it."""
    near = F.when(F.col("at") % cut < size - 1, F.array(F.floor(F.col("at") / cut), F.floor(F.col("at") / cut) - 1)).otherwise(F.array(F.floor(F.col("at") / cut)))
    rows = side.select("key", "at", F.xxhash64(F.coalesce("word", F.lit("\0")), F.coalesce("tag", F.lit("\0"))).alias("h"), F.explode(near).alias("block"))
    w = W.partitionBy("block").orderBy("at")
    whole = F.lead("key", size - 1).over(w).eqNullSafe(F.col("key")) & (F.lead("at", size - 1).over(w) == F.col("at") + size - 1)
    run = rows.select("key", "at", "block", F.when(whole, F.xxhash64("h", *(F.lead("h", k).over(w) for k in range(1, size)))).alias("hash"))
    run = run.filter((F.col("block") == F.floor(F.col("at") / cut)) & (F.col("hash") % thin == 0))
    return run.groupBy("key", "hash").agg(F.min("at").alias("at"), F.count("*").alias("n")).filter("n = 1").drop("n")


def cuts(left: DataFrame, right: DataFrame, cut: int = CUT, size: int = SHINGLE, thin: int = THIN) -> DataFrame:
    """key, i and j of the places where the streams (key, at, word, tag; at: a number in the order of all rows) are cut, and each key's
    beginning and end: first_i, end_i, first_j and end_j (null where the side has no such key)."""
    ends = lambda side, n: side.groupBy("key").agg(F.min("at").alias(f"first_{n}"), (F.max("at") + 1).alias(f"end_{n}"))
    keys = ends(left, "i").withColumnRenamed("key", "k1").join(ends(right, "j").withColumnRenamed("key", "k2"), F.col("k1").eqNullSafe(F.col("k2")), "full")
    keys = keys.select(F.when(F.col("first_i").isNotNull(), F.col("k1")).otherwise(F.col("k2")).alias("key"), "first_i", "end_i", "first_j", "end_j")
    columns = ("key", "i", "j", "first_i", "end_i", "first_j", "end_j")
    starts = keys.select("key", F.col("first_i").alias("i"), F.col("first_j").alias("j"), "first_i", "end_i", "first_j", "end_j")
    long = keys.filter(F.greatest(F.col("end_i") - F.col("first_i"), F.col("end_j") - F.col("first_j")) > cut)
    if long.isEmpty():
        return starts
    both = _shingles(left, cut, size, thin).select(F.col("key").alias("k1"), F.col("hash").alias("h1"), F.col("at").alias("i"))
    both = both.join(_shingles(right, cut, size, thin).select(F.col("key").alias("k2"), F.col("hash").alias("h2"), F.col("at").alias("j")), (F.col("h1") == F.col("h2")) & F.col("k1").eqNullSafe(F.col("k2")))
    picks = both.groupBy("k1", F.floor(F.col("i") / cut).alias("block")).agg(F.min_by(F.struct("i", "j"), "i").alias("p")).select("k1", "p.i", "p.j")
    picks = picks.join(long, F.col("k1").eqNullSafe(F.col("key")))
    schema = StructType([StructField("key", left.schema["key"].dataType), *(StructField(c, LongType()) for c in columns[1:])])

    def keep(key: pd.DataFrame) -> pd.DataFrame:
        found = chain(list(zip(key["i"].tolist(), key["j"].tolist(), strict=True)))
        out = pd.DataFrame(found, columns=["i", "j"], dtype="int64")
        for c in ("key", *columns[3:]):
            out[c] = key[c].iloc[0]
        return out[list(columns)]

    inner = picks.select(*columns).groupBy("key").applyInPandas(keep, schema)
    inner = inner.filter((F.col("i") > F.col("first_i")) | (F.col("j") > F.col("first_j")))
    return starts.unionByName(inner)


def _dealt(side: DataFrame, segments: DataFrame, start: str, end: str, cut: int) -> DataFrame:
    """The side's tokens with the segment that each is in. A block of `cut` numbers is a group: its tokens, and the starts of
    the segments that reach into it, in one order."""
    spans = segments.filter(F.col(start).isNotNull() & (F.col(end) > F.col(start)))
    block = F.explode(F.sequence(F.floor(F.col(start) / cut), F.floor((F.col(end) - 1) / cut)))
    starts = spans.select("segment", "last", F.col(start).alias("begin"), block.alias("block"))
    starts = starts.select("block", F.greatest(F.col("begin"), F.col("block") * cut).alias("at"), F.struct("segment", "last").alias("s"), F.lit(None).cast(side.schema["key"].dataType).alias("key"), *(F.lit(None).cast("string").alias(c) for c in ("word", "tag")), F.lit(0).alias("kind"))
    tokens = side.select(F.floor(F.col("at") / cut).alias("block"), "at", F.lit(None).cast(starts.schema["s"].dataType).alias("s"), "key", "word", "tag", F.lit(1).alias("kind"))
    w = W.partitionBy("block").orderBy("at", "kind").rowsBetween(W.unboundedPreceding, 0)
    return starts.unionByName(tokens).withColumn("s", F.last("s", ignorenulls=True).over(w)).filter("kind = 1").select("s.segment", "s.last", "key", "at", "word", "tag")


def align(left: DataFrame, right: DataFrame, key: str = "doc_id", order: tuple[str, ...] = ("pos",), word: str = "word", tag: str = "tag", cut: int = CUT, scratch: Scratch | None = None) -> DataFrame:
    """key, segment, seq, and the columns of segment_rows; a key's rows are in the order of segment and seq."""
    scratch = scratch or Scratch(left.sparkSession)

    def numbered(df: DataFrame) -> DataFrame:
        picked = df.select(F.col(f"`{key}`").alias("key"), *(F.col(f"`{c}`").alias(f"o{k}") for k, c in enumerate(order)), F.col(f"`{word}`").cast("string").alias("word"), F.col(f"`{tag}`").cast("string").alias("tag"))
        return global_positions(picked, ["key", *(f"o{k}" for k in range(len(order)))], "at", scratch).select("key", "at", "word", "tag")

    left, right = numbered(left), numbered(right)
    found = scratch.table(cuts(left, right, cut).withColumn("segment", F.monotonically_increasing_id()), "cuts")
    by = W.partitionBy("key").orderBy("i", "j")  # one row for each `cut` tokens of a key
    found = found.withColumn("next_i", F.lead("i").over(by)).withColumn("next_j", F.lead("j").over(by)).withColumn("part", F.row_number().over(by) - 1)
    segments = scratch.table(found.select("key", "segment", "part", F.col("next_i").isNull().alias("last"), "i", F.coalesce("next_i", "end_i").alias("to_i"), "j", F.coalesce("next_j", "end_j").alias("to_j")), "segments")
    a, b = _dealt(left, segments, "i", "to_i", cut), _dealt(right, segments, "j", "to_j", cut)
    schema = StructType([StructField("segment", LongType()), StructField("seq", LongType()), StructField("code", StringType()), StructField("error", BooleanType()), *(StructField(c, LongType() if c.startswith("n_") else StringType()) for c in ROW)])

    def one(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        some = x if len(x) else y
        streams = [list(zip(s["word"].tolist(), s["tag"].tolist(), strict=True)) for s in (f.sort_values("at") if len(f) else f.assign(word=[], tag=[]) for f in (x, y))]
        rows = segment_rows(*streams, bool(some["last"].iloc[0]))
        return pd.DataFrame([(int(some["segment"].iloc[0]), k, *r) for k, r in enumerate(rows)], columns=[f.name for f in schema])

    pick = ("segment", "last", "at", "word", "tag")
    rows = a.select(*pick).groupBy("segment").cogroup(b.select(*pick).groupBy("segment")).applyInPandas(one, schema)
    named = segments.select(F.col("segment").alias("s"), F.col("key").alias(key), "part")
    rows = rows.join(named, F.col("segment") == F.col("s"))
    return rows.select(key, F.col("part").cast("long").alias("segment"), "seq", "code", "error", *ROW)


class Side(NamedTuple):
    """The streams of some rows: row k has the words and tags from ends[k] to ends[k + 1]."""

    ends: np.ndarray
    word: pa.Array
    tag: pa.Array

    def part(self, a: int, b: int) -> Side:
        first, last = int(self.ends[a]), int(self.ends[b])
        return Side(self.ends[a : b + 1] - first, self.word.slice(first, last - first), self.tag.slice(first, last - first))


def _codes(x: pa.Array, y: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """Equal numbers for equal values of both arrays (nulls too), and how many there are."""
    both = pa.concat_arrays([x, y]).dictionary_encode(null_encoding="encode")
    codes = both.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return codes[: len(x)], codes[len(x) :], len(both.dictionary)


def _places(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each run in all runs, and first + 0, 1, ... of each."""
    ends = np.cumsum(n)
    return ends - n, np.repeat(first - (ends - n), n) + np.arange(int(ends[-1]) if len(n) else 0)


def _leading(equal: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How many of each run's first values are true. No run is empty."""
    at = np.arange(len(equal)) - np.repeat(starts, n)
    return np.minimum.reduceat(np.where(equal, np.repeat(n, n), at), starts) if len(n) else n


def _matched(x: Side, y: Side) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each token of either side whether it is in the longest common subsequence of its row that `lcs` gives; and numbers of words."""
    (wx, wy, _), (tx, ty, tags) = _codes(x.word, y.word), _codes(x.tag, y.tag)
    row_x, row_y = (np.repeat(np.arange(len(s.ends) - 1), np.diff(s.ends)) for s in (x, y))
    token = np.r_[wx, wy] * tags + np.r_[tx, ty]
    most = int(token.max()) + 1 if len(token) else 1
    kinds, token = np.unique(np.r_[row_x, row_y] * most + token, return_inverse=True)  # of each row its own
    a, b = token[: len(wx)], token[len(wx) :]
    keep_x, keep_y = np.bincount(b, minlength=len(kinds))[a] > 0, np.bincount(a, minlength=len(kinds))[b] > 0
    # where what both sides have is one sequence, it is the only longest one
    p, q, n = np.flatnonzero(keep_x), np.flatnonzero(keep_y), len(x.ends) - 1
    n_x, n_y = np.bincount(row_x[p], minlength=n), np.bincount(row_y[q], minlength=n)
    unlike = n_x != n_y
    p_same, q_same = p[~unlike[row_x[p]]], q[~unlike[row_y[q]]]
    unlike[row_x[p_same[a[p_same] != b[q_same]]]] = True
    for k in np.flatnonzero(unlike):
        (i, to_i), (j, to_j) = x.ends[k : k + 2], y.ends[k : k + 2]
        pairs = np.array(lcs(a[i:to_i].tolist(), b[j:to_j].tolist()), np.int64).reshape(-1, 2)
        keep_x[i:to_i] = keep_y[j:to_j] = False
        keep_x[i + pairs[:, 0]] = keep_y[j + pairs[:, 1]] = True
    return keep_x, keep_y, wx, wy


def _texts(side: Side, first: np.ndarray, n: np.ndarray) -> pa.Array:
    """The tokens of each run written out with their tags; null for an empty run."""
    starts, at = _places(first, n)
    tokens = pc.binary_join_element_wise(*(pc.fill_null(c.take(pa.array(at)), "None") for c in (side.word, side.tag)), " ")
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.r_[starts, len(at)], pa.int32()), tokens), " ")
    return pc.if_else(pa.array(n > 0), joined, pa.scalar(None, pa.string()))


def aligned_columns(x: Side, y: Side, columns: tuple[str, ...] = tuple(TYPES), codes: str = "SCI") -> tuple[np.ndarray, list[pa.Array]]:
    """The rows that segment_rows gives each pair of streams, all at once: the place of the streams in x and y for each row, and
    the columns asked for, of rows that have one of the codes asked for."""
    keep_x, keep_y, wx, wy = _matched(x, y)
    docs = len(x.ends) - 1
    # a gap is what stands before a match or the end of a row's streams, empty or not
    pairs = np.diff(np.r_[0, np.cumsum(keep_x)][x.ends])
    doc = np.repeat(np.arange(docs), pairs + 1)
    last = np.zeros(len(doc), bool)
    last[np.cumsum(pairs + 1) - 1] = True

    def gaps(side: Side, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        end = np.empty(len(doc), np.int64)
        end[~last], end[last] = np.flatnonzero(keep), side.ends[1:]
        before = np.r_[0, end[:-1] + 1][: len(doc)]
        first = np.r_[True, last[:-1]][: len(doc)]
        before[first] = side.ends[:-1]
        return end, end - before

    (end_x, n_x), (end_y, n_y) = gaps(x, keep_x), gaps(y, keep_y)
    front, back = np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
    both = np.flatnonzero((n_x > 0) & (n_y > 0))
    least = np.minimum(n_x, n_y)
    starts, i = _places((end_x - n_x)[both], least[both])
    front[both] = _leading(wx[i] == wy[_places((end_y - n_y)[both], least[both])[1]], starts, least[both])
    both = both[least[both] > front[both]]
    rest = least[both] - front[both]
    starts, k = _places(np.zeros(len(both), np.int64), rest)
    back[both] = _leading(wx[np.repeat(end_x[both], rest) - 1 - k] == wy[np.repeat(end_y[both], rest) - 1 - k], starts, rest)
    odd_x, odd_y = n_x - front - back, n_y - front - back
    odd = ((odd_x > 0) | (odd_y > 0)).astype(np.int64)
    # a single token between two matches, and of such that share a match every other one, as an expression finds them
    alone = (n_x + n_y == 1) & ~last & ~np.r_[True, last[:-1]][: len(doc)]
    at = np.arange(len(doc))
    wrong = alone & ((at - np.maximum.accumulate(np.where(alone, -1, at))) % 2 == 1)

    size = front + odd + back + ~last
    starts, place = _places(np.zeros(len(doc), np.int64), size)
    gap = np.repeat(at, size)
    after = place - front[gap] - odd[gap]  # of C rows from the back
    kind = np.where(place < front[gap], 0, np.where(after < 0, 1, np.where(after < back[gap], 0, 2)))
    row_starts = np.r_[0, np.cumsum(size)][np.r_[0, np.cumsum(pairs + 1)]] if docs else np.zeros(1, np.int64)
    seq = np.arange(len(gap)) - np.repeat(row_starts[:-1], np.diff(row_starts))
    if codes != "SCI":
        picked = np.isin(kind, ["CIS".index(c) for c in codes])
        gap, place, after, kind, seq = (v[picked] for v in (gap, place, after, kind, seq))
    aside = kind == 1
    run = gap[aside]

    def token(end: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(place < front[gap], (end - n)[gap] + place, np.where(kind == 2, end[gap], (end - back)[gap] + after))

    def column(name: str) -> pa.Array:
        if name == "segment":
            return pa.array(np.zeros(len(gap), np.int64))
        if name == "seq":
            return pa.array(seq)
        if name == "code":
            return pa.array(["C", "I", "S"]).take(pa.array(kind))
        if name == "error":
            return pa.array(wrong[gap] & aside)
        side, end, n, others = (x, end_x, n_x, odd_x) if "left" in name else (y, end_y, n_y, odd_y)
        if name.startswith("n_"):
            return pa.array(np.where(aside, others[gap], 1))
        if name.endswith("_tag"):
            return side.tag.take(pa.array(token(end, n), mask=aside))
        places = token(end, n)
        places[aside] = len(side.word) + np.arange(len(run))
        written = _texts(side, (end - n + front)[run], others[run])
        return pa.concat_arrays([side.word, written]).take(pa.array(places))

    return doc[gap], [column(c) for c in columns]


def _schema(key: StructField, columns: tuple[str, ...]) -> StructType:
    kinds = {pa.int64(): LongType(), pa.string(): StringType(), pa.bool_(): BooleanType()}
    return StructType([StructField(key.name, key.dataType), *(StructField(c, kinds[TYPES[c]]) for c in columns)])


def align_made(docs: DataFrame, read: Callable[[pa.RecordBatch], tuple[Side, Side]], long: Column, key: str = "doc_id", columns: tuple[str, ...] = tuple(TYPES), codes: str = "SCI", cut: int = CUT, scratch: Scratch | None = None) -> DataFrame:
    """What `align` gives, of rows that have a key and what `read` makes the streams of both sides of: the key and the columns asked
    for, of rows with the codes asked for. long: a condition that all rows of more than `cut` tokens on a side meet, and few others.
    Rows of at most `cut` tokens on both sides are aligned where they are; the tokens of the others, made once, go through `align`."""
    scratch = scratch or Scratch(docs.sparkSession)
    kind = docs.schema[key]
    schema = _schema(kind, columns)
    large = lambda x, y: (np.diff(x.ends) > cut) | (np.diff(y.ends) > cut)

    def aligned(batches):
        for batch in (b.slice(at, READ) for b in batches for at in range(0, b.num_rows, READ)):
            x, y = read(batch)
            skip, sizes, a = large(x, y), x.ends + y.ends, 0
            while a < batch.num_rows:
                if skip[a]:
                    a += 1
                    continue
                b = max(a + 1, int(np.searchsorted(sizes, sizes[a] + PACK, "right")) - 1)
                b = next((k for k in range(a + 1, b) if skip[k]), b)
                of, cells = aligned_columns(x.part(a, b), y.part(a, b), columns, codes)
                keys = batch.column(key).take(pa.array(of + a))
                yield pa.RecordBatch.from_arrays([keys, *cells], names=schema.names)
                a = b

    def streams(batches):
        for batch in (b.slice(at, READ) for b in batches for at in range(0, b.num_rows, READ)):
            x, y = read(batch)
            for k in np.flatnonzero(large(x, y)).tolist():
                cells = [pa.ListArray.from_arrays(pa.array(s.ends, pa.int32()), pa.StructArray.from_arrays([s.word, s.tag], ["word", "tag"])) for s in (x.part(k, k + 1), y.part(k, k + 1))]
                yield pa.RecordBatch.from_arrays([batch.column(key).slice(k, 1), *cells], names=[key, "left", "right"])

    short = docs.mapInArrow(aligned, schema)
    token = "array<struct<word:string,tag:string>>"
    rest = docs.filter(long).mapInArrow(streams, StructType([kind, *(StructField(c, StructType.fromDDL(f"t {token}")["t"].dataType) for c in ("left", "right"))]))
    rest = scratch.table(rest, "streams", "zstd")
    if rest.isEmpty():
        return short
    each = lambda c: rest.select(F.col(key), F.posexplode(c).alias("pos", "v")).select(key, "pos", "v.word", "v.tag")
    whole = align(each("left"), each("right"), key, cut=cut, scratch=scratch)
    return short.unionByName(whole.filter(F.col("code").isin(*codes)).select(key, *columns))


def align_rows(docs: DataFrame, key: str = "doc_id", left: str = "left", right: str = "right", cut: int = CUT, scratch: Scratch | None = None) -> DataFrame:
    """What `align` gives, of rows that have a key (written once) and both streams as arrays of structs of word and tag. Rows of at most
    `cut` tokens on both sides are aligned where they are, without a shuffle of tokens; the tokens of the others go through `align`."""
    scratch = scratch or Scratch(docs.sparkSession)
    token = "array<struct<word:string,tag:string>>"
    stream = lambda c: F.coalesce(F.transform(F.col(f"`{c}`"), lambda x: F.struct(x["word"].cast("string").alias("word"), x["tag"].cast("string").alias("tag"))), F.array().cast(token))
    picked = docs.select(F.col(f"`{key}`").alias("key"), stream(left).alias("left"), stream(right).alias("right"))
    picked = scratch.table(picked, "rows", "zstd")  # written once: filters on sizes would make the streams again, several times

    def read(batch: pa.RecordBatch) -> tuple[Side, Side]:
        sides = []
        for column in (batch.column("left"), batch.column("right")):
            tokens = column.flatten()
            sides.append(Side(_ends(column), tokens.field("word"), tokens.field("tag")))
        return tuple(sides)

    return align_made(picked, read, (F.size("left") > cut) | (F.size("right") > cut), "key", cut=cut, scratch=scratch).withColumnRenamed("key", key)


def _ends(lists: pa.Array) -> np.ndarray:
    return np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64))]


def word_streams(change: Callable[[pa.Array, pa.Array, np.ndarray, np.ndarray], tuple[pa.Array, pa.Array, np.ndarray, pa.Array, pa.Array]]) -> Callable[[pa.RecordBatch], tuple[Side, Side]]:
    """A reader for align_made of rows that have the words and tags of their sentences as arrays of arrays. change: of words, tags, sentences
    (from 0) and places (from 1) the words and tags of the left side, and of the right side the tokens that its words and tags stand for
    (ascending) and those."""

    def read(batch: pa.RecordBatch) -> tuple[Side, Side]:
        sentences = batch.column("words").flatten()
        rows, ends = _ends(batch.column("words")), _ends(sentences)
        n = np.diff(ends)
        pos = np.arange(int(ends[-1])) - np.repeat(ends[:-1], n) + 1
        sent = np.repeat(np.arange(len(n)) - np.repeat(rows[:-1], np.diff(rows)), n)
        word, tag, of, other, other_tag = change(sentences.flatten(), batch.column("tags").flatten().flatten(), sent, pos)
        ends = ends[rows]
        return Side(ends, word, tag), Side(np.searchsorted(of, ends), other, other_tag)

    return read


def _compared(aligned: DataFrame, *by: Column | str) -> tuple[DataFrame, DataFrame]:
    """n of tokens whose tags differ, and one row of total and diffs. Both come from one count, so streams are aligned once: a filter by
    the code itself would go below the count, and make it another."""
    differs = F.col("code") == "C"
    names = [f"b{k}" for k in range(len(by))]
    n = aligned.filter(F.col("code").isin("S", "C")).groupBy("code", *(F.when(differs, c).alias(b) for b, c in zip(names, by, strict=True))).agg(F.count("*").alias("n"), F.max(differs).alias("differs"))
    total = n.agg(F.sum("n").alias("total"), F.coalesce(F.sum(F.when(F.col("differs"), F.col("n"))), F.lit(0)).alias("diffs"))
    return n.filter("differs"), total


def differences(aligned: DataFrame) -> DataFrame:
    """word, left_tag, right_tag, n, diff_pct and total_pct of tokens whose tags differ: shares of all such tokens and of all compared."""
    n, total = _compared(aligned, F.col("left"), F.col("left_tag"), F.col("right_tag"))
    return n.join(F.broadcast(total)).select(F.col("b0").alias("word"), F.col("b1").alias("left_tag"), F.col("b2").alias("right_tag"), "n", (100 * F.col("n") / F.col("diffs")).alias("diff_pct"), (100 * F.col("n") / F.col("total")).alias("total_pct"))  # one row


def difference_pairs(differences_: DataFrame) -> DataFrame:
    """The differences by pair of tags."""
    return differences_.groupBy("left_tag", "right_tag").agg(*(F.sum(c).alias(c) for c in ("n", "diff_pct", "total_pct")))


def tag_pairs(aligned: DataFrame) -> DataFrame:
    """What difference_pairs gives of the differences, counted by pair at once, so no word is shuffled."""
    n, total = _compared(aligned, F.col("left_tag"), F.col("right_tag"))
    return n.join(F.broadcast(total)).select(F.col("b0").alias("left_tag"), F.col("b1").alias("right_tag"), "n", (100 * F.col("n") / F.col("diffs")).alias("diff_pct"), (100 * F.col("n") / F.col("total")).alias("total_pct"))  # one row


def ignored(aligned: DataFrame) -> DataFrame:
    """left, right, n and ignored_pct of sequences that both sides have and that were not compared; shares of all of them."""
    n = aligned.filter("code = 'I' AND left IS NOT NULL AND right IS NOT NULL").groupBy("left", "right").agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("total"))  # of the same counts, so streams are aligned once
    return n.join(F.broadcast(total)).select("left", "right", "n", (100 * F.col("n") / F.col("total")).alias("ignored_pct"))  # one row


def summary(aligned: DataFrame, by: list[Column | str] | None = None) -> DataFrame:
    """compared, same, different, ignored (sequences of both sides), alone (sequences of one side), errors, and shares of what was compared."""
    code, both = F.col("code"), (F.col("n_left") > 0) & (F.col("n_right") > 0)
    t = aligned.groupBy(*(by or [])).agg(
        F.count_if(code.isin("S", "C")).alias("compared"), F.count_if(code == "S").alias("same"), F.count_if(code == "C").alias("different"),
        F.count_if((code == "I") & both).alias("ignored"), F.count_if((code == "I") & ~both).alias("alone"), F.count_if("error").alias("errors"))
    share = lambda c: F.when(F.col("compared") > 0, 100 * F.col(c) / F.col("compared"))
    return t.withColumn("same_pct", share("same")).withColumn("diff_pct", share("different"))


def error_rows(aligned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Where a single token stands alone between tokens that agree."""
    return aligned.filter("error").select(key, "segment", "seq", "left", "right")


def report(aligned: dict[str, DataFrame], tags: DataFrame, key: str = "doc_id", most: int = 25, seed: int = 0) -> str:
    """A Markdown report of comparisons by name with one reference: summary, tags, and the `most` frequent differences, pairs and
    ignored sequences of each, with `most` errors that a seeded hash picks. tags: what tag_counts gives."""

    def table(df: DataFrame) -> str:
        rows = df.collect()  # some dozens: what `most`, the tagset or the names bound
        cells = lambda r: "| " + " | ".join("" if v is None else f"{v:.2f}" if isinstance(v, float) else str(v).replace("|", "\\|") for v in r) + " |"
        return "\n".join([cells(df.columns), "|" + "-|" * len(df.columns), *map(cells, rows)])

    first = lambda df: df.orderBy(F.desc("n"), *(c for c in df.columns if c != "n")).limit(most)
    parts = ["# Comparison of taggings", "## Summary", table(reduce(DataFrame.unionByName, (summary(a).select(F.lit(n).alias("name"), "*") for n, a in aligned.items())).orderBy("name")), "## Tags", table(tags.orderBy("tag"))]
    for name, a in aligned.items():
        d = differences(a)
        errors = error_rows(a, key)
        errors = errors.orderBy(F.xxhash64(F.lit(seed), *errors.columns), *errors.columns).limit(most)
        for title, df in (("Pairs of tags", first(difference_pairs(d))), ("Differences", first(d)), ("Ignored sequences", first(ignored(a))), ("Alignment errors", errors)):
            parts += [f"## {title}: {name}", table(df)]
    return "\n\n".join(parts) + "\n"
