import pytest


@pytest.fixture(autouse=True)
def shipped(spark):
    from tidemark.llm.common import ship

    ship(spark)


@pytest.fixture
def odd_docs(spark):
    """NULLs in any column, empty and very long texts, repeated rows, and columns named like internal ones."""
    rows = [(1, "the quick brown fox", 7.0), (None, "the quick brown fox", None), (2, None, 1.0), (2, None, 1.0), (None, None, None), (3, "", 2.0),
            (4, " \n\t ", 2.0), (5, "ab " * 60_000, 3.0), (6, "x" * 200_000, 3.0), (1, "the quick brown fox", 7.0), (7, "日本語 für élève \U0001f600", 0.0)]
    cols = "fp row_key n_tokens score ids label held digest component n_hit __found __found_n __lines __row spans key".split()
    return spark.createDataFrame([(i, t, *[x] * len(cols)) for i, t, x in rows],
                                 "doc_id bigint, text string, " + ", ".join(f"`{c}` double" for c in cols)).repartition(3)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
