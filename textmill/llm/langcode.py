"""Language identification by error-correcting output codes.

Each learned language has a codeword; one binary classifier over hashed byte n-grams (one to three bytes, ASCII folded)
learns each bit. A text's n-grams give a margin for each bit; decoding sums, for each codeword, the logistic loss of the
margins against its bits, each bit weighted by how well its classifier does on that language, and takes the codeword of least loss.
A text whose best two codewords lie close together is flagged as ambiguous.

Codes: for up to EXHAUSTIVE languages all different splits of them, else seeded random columns.

Training uses a sample of at most `sample` labelled rows (default SAMPLE), dealt evenly over the languages and picked by
a hash of the key, so its size does not grow with the table; every row is predicted from its whole text.

Defined results: a null text, or one without a letter, is `und` with score 0; with no labelled row every text is `und`;
with one language every text with letters has it, score 1; of more languages than `sample` the most frequent `sample` are
learned; a letter is a character of the Unicode categories L*, so `\u00bd\u00b2` is `und`; a row with a null key is judged like any
other (op1_langid counts it as held out, so nothing is learned from it); repeated rows get equal results; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm.common import columns_of, keyed, map_arrow, text_slices

FEATURES = 8192
SAMPLE = 2400
EXHAUSTIVE = 6
#: Below this score a result is ambiguous.
SURE = 0.6
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def _grams(texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray]:
    """Feature numbers of the 1-, 2- and 3-grams at each byte, and where each text starts. Two spaces surround each."""
    raw = [b"  " + (x or "").encode().translate(_FOLD) + b"  " for x in texts]
    every = np.frombuffer(b"".join([*raw, b"  "]), np.uint8).astype(np.uint32)
    starts = np.cumsum([0, *map(len, raw)])[:-1]
    a, b, c = every[:-2], every[1:-1], every[2:]
    shift = np.uint32(32 - FEATURES.bit_length() + 1)
    pair = a | b << np.uint32(8)
    return [a, (pair + np.uint32(0x10000)) * np.uint32(2654435761) >> shift, (pair | c << np.uint32(16)) * np.uint32(2246822519) + np.uint32(97) >> shift], starts


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """A matrix of +1 and -1, a row for each of n languages; no two rows and no two columns are equal."""
    if n < 2:
        return np.zeros((n, 0), np.float32)
    if n <= EXHAUSTIVE:
        bits = [c for c in itertools.product((1, -1), repeat=n) if c[0] == 1 and len(set(c)) > 1]
        return np.array(bits, np.float32).T.reshape(n, -1)
    rng, width, best = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n))), None
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], np.float32), (n, width))
        apart = (code @ code.T - 2 * width * np.eye(n)).max()  # smallest distance: largest product
        if best is None or apart < best[0]:
            best = apart, code
    return best[1]


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # language x bit
    weights: np.ndarray  # bit x feature
    bias: np.ndarray  # bit
    trust: np.ndarray  # language x bit, rows sum to 1

    def margins(self, texts: list[str | None]) -> np.ndarray:
        grams, starts = _grams(texts)
        sizes = np.diff([*starts, len(grams[0])])
        out = np.empty((len(texts), len(self.bias)))
        for k, row in enumerate(self.weights):
            out[:, k] = sum(np.add.reduceat(row[g], starts) for g in grams) / (3 * sizes) + self.bias[k]
        return out

    def decode(self, margins: np.ndarray) -> np.ndarray:
        """The probability of each language: of least loss, most."""
        loss = (np.logaddexp(0, -margins[:, None, :] * self.code) * self.trust).sum(axis=2)
        odds = np.exp(4 * (loss.min(axis=1, keepdims=True) - loss))
        return odds / odds.sum(axis=1, keepdims=True)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        lettered = np.array([bool(x) and any(map(str.isalpha, x)) for x in texts], bool)
        if not self.languages or not len(texts):
            return ["und"] * len(texts), np.zeros(len(texts))
        odds = self.decode(self.margins(texts)) if len(self.languages) > 1 else np.ones((len(texts), 1))
        best = odds.argmax(axis=1)
        return [self.languages[i] if ok else "und" for i, ok in zip(best.tolist(), lettered.tolist(), strict=True)], np.where(lettered, odds.max(axis=1), 0.0)


def fit(x: np.ndarray, y: np.ndarray, languages: list[str], steps: int = 300) -> Model:
    """Logistic regression of each bit on relative n-gram frequencies (rows of x), y: language numbers."""
    code = codewords(len(languages))
    if len(languages) < 2:
        return Model(languages, code, np.zeros((0, FEATURES), np.float32), np.zeros(0), code)
    scale = x.std(axis=0) + 1e-4
    z = (x - x.mean(axis=0)) / scale / np.sqrt(FEATURES)
    target = code[y]  # rows x bits
    share = 1 / np.bincount(y, minlength=len(languages))[y][:, None]  # languages count alike
    share /= share.sum()
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(steps):
        slope = (-target / (1 + np.exp(np.clip(target * (z @ w + b), -30, 30))) * share).astype(np.float32)
        vw, vb = 0.9 * vw - 20 * (z.T @ slope + 1e-5 * w), 0.9 * vb - 2 * slope.sum(axis=0)
        w, b = w + vw, b + vb
    right = (np.sign(z @ w + b) == target).astype(np.float64)
    trust = np.stack([right[y == k].mean(axis=0) + 1e-3 for k in range(len(languages))])
    weights = (w / np.sqrt(FEATURES)).T / scale
    return Model(languages, code, weights.astype(np.float32), b - weights @ x.mean(axis=0), trust / trust.sum(axis=1, keepdims=True))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Language, and the n-gram frequencies of the text: feature numbers and shares."""
    for batch in text_slices(batches):
        at, share = [], []
        for x in batch.column(1).to_pylist():
            total = sum(np.bincount(g, minlength=FEATURES) for g in _grams([x])[0])
            at.append((found := np.flatnonzero(total)).astype(np.int16))
            share.append((total[found] / total.sum()).astype(np.float32))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at, pa.list_(pa.int16())), pa.array(share, pa.list_(pa.float32()))], ["lang", "at", "share"])


def train(labelled: DataFrame, sample: int = SAMPLE, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model:
    """Learn from at most `sample` rows with a text and a language."""
    rows = columns_of(labelled, key, lang, text).toDF("key", "lang", "text").filter("lang is not null and text is not null")
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row for each language
    languages = sorted(sorted(counts, key=lambda x: (-counts[x], x))[:sample])
    if not languages:
        return fit(np.zeros((0, FEATURES)), np.zeros(0, int), languages)
    each = sample // len(languages)
    order = F.pmod(F.xxhash64("key"), F.lit(1_000_000)) / 1_000_000
    picked: Column = F.lit(False)
    for name in languages:
        picked = picked | ((F.col("lang") == name) & (order <= 0.9 * each / counts[name]))
    got = rows.filter(picked).select("lang", "text").mapInArrow(_frequencies, "lang string, at array<smallint>, share array<float>").limit(sample).toArrow()
    number = {name: k for k, name in enumerate(languages)}
    x, y = np.zeros((got.num_rows, FEATURES), np.float32), np.empty(got.num_rows, int)
    for i, (name, at, share) in enumerate(zip(got["lang"], got["at"], got["share"], strict=True)):
        x[i, at.values.to_numpy()] = share.values.to_numpy()
        y[i] = number[name.as_py()]
    present = np.unique(y)
    return fit(x, np.searchsorted(present, y), [languages[k] for k in present])


def identify(df: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, lang_pred, score and ambiguous of every row; no shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # bits x FEATURES floats

    def make():
        known = shared.value

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            names, scores = known.predict(batch.column(1).to_pylist())
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores), pa.array(scores < SURE)], [key, "lang_pred", "score", "ambiguous"])

        return work

    return map_arrow(columns_of(df, key, text), make, keyed(df, key, "lang_pred string, score double, ambiguous boolean"), text)


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))
    model = train(docs.filter(~held_out))
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")
