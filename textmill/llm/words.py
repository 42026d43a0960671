"""64-bit hashes of words and of runs of words, for whole slices of texts at once."""

from __future__ import annotations

import numpy as np

#: White space becomes a space, A-Z lower case.
_FOLD = bytes(32 if b in b" \t\n\r\x0b\x0c" else b + 32 if 65 <= b <= 90 else b for b in range(256))
_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(texts: list[str | bytes | None], fold: bytes = _FOLD) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word of all texts, and how many words each text has. fold turns what parts words into spaces."""
    raw = [(x if isinstance(x, bytes) else (x or "").encode()).translate(fold) for x in texts]
    data = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)
    inside = data != 32
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    firsts = 1 + np.cumsum([0, *(len(x) + 1 for x in raw)])
    counts = np.diff(np.searchsorted(starts, firsts))
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    lengths = ends - starts
    letters = data[inside].astype(np.uint64)  # the letters of all words, one after another
    at = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(at, lengths)
    sums = np.add.reduceat((letters + np.uint64(1)) * _powers(int(lengths.max()))[place], at)
    return mix(sums + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), counts


def shingles(texts: list[str | bytes | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each text's runs of `size` words, ascending, and how many each text has.

    A text of fewer words, but not none, has one: its whole sequence.
    """
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    doc = np.repeat(np.arange(len(texts)), counts)
    n = len(words)
    place = np.arange(n)
    left = ends[doc] - place  # words from here to the text's end
    total, length = np.zeros(n, np.uint64), np.minimum(left, size)
    for k in range(size):
        here = words[np.minimum(place + k, max(n - 1, 0))] * np.uint64(2 * k + 3) + np.uint64(k + 1)
        total += np.where(k < left, mix(here), np.uint64(0))
    total = mix(total + length.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    keep = (left >= size) | (place == (ends - counts)[doc])
    total, doc = total[keep], doc[keep]
    order = np.lexsort((total, doc))
    total, doc = total[order], doc[order]
    new = np.r_[True, (total[1:] != total[:-1]) | (doc[1:] != doc[:-1])][: len(total)]
    return total[new], np.bincount(doc[new], minlength=len(texts))
