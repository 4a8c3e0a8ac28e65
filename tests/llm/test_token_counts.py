import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = st.lists(st.sampled_from(["a", "b", "the", " ", "  ", "\n", "'ve", "'", "s", "l", "ll", "<|endoftext|>", "<|end", "é", "9", "!!", "日本", " ", "꟒",
                                  "\t", " ", "ing", "tion"]), max_size=25).map("".join)


def library(text):
    return len(token_counts.load(PATH).library.encode(text, add_special_tokens=False).ids)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_total_equals_the_library(text):
    assert token_counts.count_text(text, PATH) == library(text)


@settings(max_examples=120, deadline=None)
@given(TEXTS)
def test_every_prefix_equals_the_library(text):
    assert token_counts.load(PATH).prefixes(text) == [library(text[:i]) for i in range(len(text) + 1)]


def test_any_character():
    for c in range(1, 0x3000, 7):
        text = f"a{chr(c)}1{chr(c)}!{chr(c)}{chr(c)}b {chr(c)}"
        assert token_counts.count_text(text, PATH) == library(text), hex(c)


def test_long_piece():
    for text in ("x" * 3000, "ab" * 900, "é" * 700):
        assert token_counts.count_text(text, PATH) == library(text)


def test_rows(odd_docs, no_docs, rows):
    want = [(i, len((t or "").encode()), library(t or ""), library(t or "") > 512) for i, t in rows(odd_docs, "doc_id", "text")]
    assert sorted(rows(token_counts.count_tokens(odd_docs, PATH)), key=str) == sorted(want, key=str)
    assert token_counts.count_tokens(no_docs, PATH).count() == 0


def test_prefixes_and_budgets(spark, rows):
    docs = spark.createDataFrame([(1, "the cat's <|endoftext|> tion  x"), (2, ""), (3, None)], "doc_id bigint, text string")
    text = "the cat's <|endoftext|> tion  x"
    assert rows(token_counts.prefix_counts(docs, PATH))[0] == (1, [library(text[:i]) for i in range(len(text) + 1)])
    cut = {r[0]: r for r in rows(token_counts.truncate(docs, PATH, 4))}
    best = max(i for i in range(len(text) + 1) if library(text[:i]) <= 4)
    assert cut[1] == (1, text[:best], library(text[:best])) and cut[2] == (2, "", 0) and cut[3] == (3, "", 0)
