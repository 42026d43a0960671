"""Which chunks reach the tokenizers library, and that their ids are its own."""

import random

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from textmill.llm import packed
from textmill.llm.common import LONGEST_CACHED, Cache


@pytest.fixture
def encoder():
    return packed.CachedTokenizer(P.path("byte_bpe_50k.json"), True)


def test_words_before_runs_of_marks_are_shared(encoder):
    asked, inner = [], encoder._chunks
    encoder._chunks = lambda chunks: asked.extend(chunks) or inner(chunks)
    encoder.encode(["a wordy wordy. wordy.%%% wordy!! wordy***"])
    assert asked == ["wordy"]
    encoder.encode(["b wordy,$$$ Äö&&&"])
    assert asked == ["wordy", "Äö"]


def test_ids_are_the_librarys(encoder):
    r = random.Random(12)
    pieces = ["word", "Äö", "don't", "ß", "日本", "12", " ", "  ", "\n", ".", ",", "%%%", "*****", "$#&!?;:", "'s", " ", "́", "_", "x" * 70]
    texts = ["", None, *(" ".join("".join(r.choices(pieces, k=r.randint(1, 4))) for _ in range(r.choice((1, 30, 700)))) for _ in range(60))]
    want = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want.encode_special_tokens = True
    for _ in range(2):  # from the cache too
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            assert ids.tolist() == want.encode(text or "", add_special_tokens=False).ids


def test_cache_fills_gaps():
    cache, asked = Cache(4), []
    lists = [["first", "a", "b", "a"], ["a"], ["", "b", "y" * (LONGEST_CACHED + 1), "c"]]
    for _ in range(3):
        found = cache.resolve(lists, lambda new: asked.append(sorted(new)) or {k: f"<{k}>" for k in new})
        assert [x[1:] for x in found] == [[f"<{k}>" for k in keys[1:]] for keys in lists]
    assert asked[0] == ["a", "b", "c", "y" * (LONGEST_CACHED + 1)] and asked[1] == ["y" * (LONGEST_CACHED + 1)]
