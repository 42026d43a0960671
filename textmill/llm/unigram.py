"""Token counts under a unigram vocabulary by dynamic programming that a trie shares.

The distinct pre-tokens of a slice are inserted in a trie; its nodes are visited depth first, so the stack of forward
scores along the current path serves every pre-token that begins with it. A node's forward score is the best sum of
piece scores that spells its prefix: one look at each piece that can end there. Where a pre-token ends, the number of
pieces of its best spelling is stored, and texts only add up stored counts.

Scores are log-probabilities. `rank_scores` gives those of a Zipf law over the ranks of a public byte-level vocabulary,
which has every single byte, so each pre-token can be spelt. Equal sums are decided for fewer pieces.

Defined results: null and empty texts have no pre-tokens and no tokens; repeated rows get equal counts; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from textmill.llm.bpe import read_ranks, splitter
from textmill.llm.common import Cache, columns_of, keyed, map_arrow, shared, word_chunks


def rank_scores(ranks: dict[bytes, int]) -> dict[bytes, float]:
    """Log-probabilities in inverse proportion to rank + 2.7."""
    norm = math.log(sum(1 / (r + 2.7) for r in ranks.values()))
    return {piece: -math.log(r + 2.7) - norm for piece, r in ranks.items()}


class Unigram:
    """Piece scores, filed by a piece's last two bytes for the look back from a node."""

    def __init__(self, scores: dict[bytes, float]):
        self.scores = scores
        lengths: dict[bytes, set[int]] = {}
        for piece in scores:
            lengths.setdefault(piece[-2:], set()).add(len(piece))
        self.lengths = {end: tuple(sorted(x)) for end, x in lengths.items()}

    def counts(self, words: set[bytes]) -> dict[bytes, int]:
        """Pieces in the best spelling of each word."""
        scores, lengths, found = self.scores, self.lengths, {}
        best: list[tuple[float, int]] = [(0.0, 0)]  # along the path from the root: forward score, minus the pieces
        path = b""
        for word in sorted(words):
            shared, limit = 0, min(len(path), len(word))
            while shared < limit and path[shared] == word[shared]:
                shared += 1
            del best[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                top = None
                for n in (*lengths.get(word[end - 1 : end], ()), *(lengths.get(word[end - 2 : end], ()) if end > 1 else ())):
                    if n > end:
                        break
                    if (score := scores.get(word[end - n : end])) is not None:
                        before = best[end - n]
                        here = (before[0] + score, before[1] - 1)
                        if top is None or here > top:
                            top = here
                if top is None:
                    raise ValueError(f"byte {word[end - 1]} is in no piece")
                best.append(top)
            path = word
            found[word] = -best[len(word)][1]
        return found


class Counter:
    """Counts of texts, with a bounded cache of chunk counts."""

    def __init__(self, scores: dict[bytes, float], pattern: str):
        self.model, self.split = Unigram(scores), splitter(pattern)
        self.chunks, self.pieces = Cache(), Cache()

    def _new(self, chunks: list[str]) -> dict[str, tuple[int, int]]:
        """(pre-tokens, tokens) of each chunk."""
        parts = {c: self.split(c) for c in chunks}
        new = self.pieces.missing({p for ps in parts.values() for p in ps})
        got = self.model.counts({p.encode() for p in new})
        get = self.pieces.lookup({p: got[p.encode()] for p in new})
        return {c: (len(ps), sum(map(get, ps))) for c, ps in parts.items()}

    def count(self, texts: list[str | None]) -> list[tuple[int, int]]:
        parts = [word_chunks(x) if x else [""] for x in texts]
        new = self.chunks.missing({c for p in parts for c in p[1:]})
        got = self._new([*(f" {c}" for c in new), *{p[0] for p in parts}])
        get = self.chunks.lookup({c: got[f" {c}"] for c in new})
        rows = []
        for p in parts:
            found = [got[p[0]], *map(get, p[1:])]
            rows.append((sum([a for a, _ in found]), sum([b for _, b in found])))
        return rows


def shared_counter(path: str, pattern: str) -> Counter:
    return shared(("unigram", path, pattern), lambda: Counter(rank_scores(read_ranks(path)), pattern))


def token_counts(df: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_pretokens and n_tokens of every row; one pass, no shuffle."""

    def make():
        counter = shared_counter(path, pattern)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = counter.count(batch.column(1).to_pylist())
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array([a for a, _ in rows], pa.int64()), pa.array([b for _, b in rows], pa.int64())], [key, "n_pretokens", "n_tokens"])

        return work

    return map_arrow(columns_of(df, key, text), make, keyed(df, key, "n_pretokens long, n_tokens long"), text, keeps=True)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
