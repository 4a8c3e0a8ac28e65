"""A training-data pipeline over ``documents``: five stages, each written as Parquet and read again by the next.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the columns of
``documents``.
"""

import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, encoding, line_dedup, simhash, toxicity
from tidemark.llm.common import ship, table
from tidemark.session import settle


def drop_toxic(spark, docs, sf_dir):
    """Rows predicted toxic go, by a model learnt from the labelled rows that may be learnt from."""
    ship(spark)
    return toxicity.keep_ordinary(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_repeated_passages(spark, docs, sf_dir):
    """Passages that stand in an earlier document go from the text; every row stays, ``n_chars`` follows its text."""
    ship(spark)
    kept, own = line_dedup.dedup(docs)
    shorter = F.when(F.col(f"{own}_gone") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", shorter).select(*docs.columns)


def drop_near_duplicates(spark, docs, sf_dir):
    """One row of each group of near duplicates stays, the one with the smallest id."""
    ship(spark)
    return simhash.one_of_each(docs)


def drop_contaminated(spark, docs, sf_dir):
    """Rows of which a twentieth of the words or more lie in benchmark passages go."""
    ship(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark, docs, sf_dir):
    """Token ids of every row, and digests of the ids and of what they decode to."""
    ship(spark)
    return encoding.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), with_ids=True)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_passages), ("simhash", drop_near_duplicates),
          ("decontamination", drop_contaminated), ("bpe", encode)]

#: SQL cannot express compression lengths, XXH64 or the token merges; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
