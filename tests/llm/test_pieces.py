import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = st.one_of(st.sampled_from(list("abet hng \n\t▁▁\x00\x85\xa0 <0x41>s") + ["the ", "  ", " ▁", "�", "́"]),
                     st.characters(exclude_categories=["Cs"]))


@pytest.fixture(scope="module")
def model():
    return pieces.load(PATH)


@settings(max_examples=400, deadline=None)
@given(st.lists(ALPHABET, max_size=60).map("".join))
def test_equals_the_library(text):
    model = pieces.load(PATH)
    found = pieces.ChunkTable(model, lambda many: list(zip(many, model.library.decode(many)))).values(text)
    ids = model.library.encode(text)
    assert [i for part, _ in found for i in part] == ids
    assert " ".join(d for _, d in found) == model.library.decode(ids)


def test_no_piece_of_the_model_crosses_a_marker(model):
    assert model.splits


def test_chunks_rejoin(model):
    for text in ("a b  c", " lead", "trail ", "  ", " ", "one", "▁x ▁"):
        assert "".join(pieces.MARK + c for c in model.chunks(text)) == pieces.MARK + text.replace(" ", pieces.MARK)
    assert model.chunks("") == model.chunks(None) == []


def test_each_distinct_chunk_is_segmented_once(model, monkeypatch):
    table, asked = pieces.ChunkTable(model, lambda many: many), []
    monkeypatch.setattr(model, "segment", lambda chunks: asked.extend(chunks) or [[1]] * len(chunks))
    for text in ("the cat the dog", "the dog  the", "cat"):
        table.values(text)
    assert sorted(asked) == sorted({"the", "cat", "dog", "▁the"})


def test_table_stays_bounded_and_right(model, monkeypatch):
    monkeypatch.setattr(pieces, "TABLE_ENTRIES", 5)
    monkeypatch.setattr(pieces, "KEPT_CHARS", 10)
    table = pieces.ChunkTable(model, lambda many: many)
    for text in ("a b c d e f g h", "a internationalisation a", "a b", "h g f a internationalisation"):
        assert [i for part in table.values(text) for i in part] == model.library.encode(text)
        assert all(len(c) <= 10 for c in table.entries)


def test_rows(spark, odd_docs, no_docs, rows, model):
    want = []
    for i, text in rows(odd_docs, "doc_id", "text"):
        ids = model.library.encode(text or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(model.library.decode(ids).encode()).hexdigest()))
    assert sorted(rows(pieces.round_trip(odd_docs, PATH)), key=str) == sorted(want, key=str)
    assert pieces.round_trip(no_docs, PATH).count() == 0


def test_encode_then_decode(spark, odd_docs, rows, model):
    encoded = pieces.encode(odd_docs, PATH)
    texts = rows(odd_docs, "doc_id", "text")
    assert sorted(rows(encoded), key=str) == sorted([(i, model.library.encode(t or "")) for i, t in texts], key=str)
    assert sorted(rows(pieces.decode(encoded, PATH)), key=str) == sorted([(i, model.library.decode(model.library.encode(t or ""))) for i, t in texts], key=str)
    assert pieces.decode(spark.createDataFrame([(1, None), (2, [])], "doc_id bigint, ids array<int>"), PATH).orderBy("doc_id").collect() == [(1, None), (2, "")]


def test_given_table_equals_the_library(spark, rows, model):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r.doc_id: model.library.encode(r.text or "") for r in docs.collect()}
    assert dict(rows(pieces.encode(docs, PATH))) == want
