import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import bpe, encoding

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load(PATH)


def test_pattern_is_the_published_one():
    assert bpe.PATTERN == public_tokenizers.PATTERN


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list("abet hnéß'sll \n\t\x1c\x85  1%<|>")), st.characters(exclude_categories=["Cs"])), max_size=80))
def test_equals_the_library(text):
    assert encoding.encode_text(text, PATH) == bpe.load(PATH).library.encode_ordinary(text)


@pytest.mark.parametrize("leaf", [1, 2, 7, 64])
def test_tree_of_halves_equals_the_merges(vocabulary, leaf):
    draw = random.Random(leaf)
    for _ in range(60):
        word = "".join(draw.choice(["th", "e", "ing", "ou", "tion", "x", "é", "aa", "日", "ß"]) for _ in range(draw.randint(1, 400))).encode()
        assert vocabulary.tree(word, leaf) == vocabulary.merged(word)


def test_join_grows_its_window_until_it_is_stable(vocabulary):
    for word in (b"a" * 999, b"ab" * 500, b"internationalisation" * 40):
        for cut in (1, 3, len(word) // 2, len(word) - 1):
            assert vocabulary.join(vocabulary.merged(word[:cut]), vocabulary.merged(word[cut:])) == vocabulary.merged(word)


def test_cuts_rejoin_and_do_not_change_the_ids(vocabulary):
    for text in ("a b  c\n d \t e", " lead", "trail ", "x  y", "\x1c z", "", "one"):
        assert "".join(bpe.cuts(text)) == text
        assert [i for c in bpe.cuts(text) for i in vocabulary.library.encode_ordinary(c)] == vocabulary.library.encode_ordinary(text)


def test_rows(spark, odd_docs, no_docs, rows, vocabulary):
    got = rows(encoding.round_trip(odd_docs, PATH))
    want = []
    for i, text in rows(odd_docs, "doc_id", "text"):
        ids = vocabulary.library.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert encoding.round_trip(no_docs, PATH).count() == 0


def test_decode_is_the_inverse(odd_docs, rows):
    decoded = encoding.decode(encoding.encode(odd_docs, PATH), PATH)
    assert rows(decoded) == sorted([(i, (t or "").encode()) for i, t in rows(odd_docs, "doc_id", "text")], key=lambda r: tuple((v is None, str(v)) for v in r))
