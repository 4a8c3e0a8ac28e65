"""The corpus operators as queries over the given tables, with their SQL where SQL can express them."""

import public_tokenizers

from pyspark.sql import functions as F

from . import centroids, conversations, decontaminate, embeddings, encoding, html_text, line_dedup, oracles, pieces, secrets, simhash, token_counts, toxicity, urls
from .common import table


def op1_html_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


def op2_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_secrets(spark, sf_dir):
    return secrets.digest(table(spark, sf_dir, "documents"))


def op4_embeddings(spark, sf_dir):
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op6_bpe(spark, sf_dir):
    return encoding.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op7_line_dedup(spark, sf_dir):
    docs, own = line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "text", F.col(f"{own}_n").alias("n_lines"), F.col(f"{own}_gone").alias("n_removed"))


def op8_urls(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages"))


def op9_decontamination(spark, sf_dir):
    return decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_prefix_trie(spark, sf_dir):
    return conversations.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_centroids(spark, sf_dir):
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op13_pieces(spark, sf_dir):
    return pieces.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_html_text, op2_simhash, op3_secrets, op4_embeddings, op5_toxicity, op6_bpe, op7_line_dedup, op8_urls,
                                   op9_decontamination, op10_token_counts, op11_prefix_trie, op12_centroids, op13_pieces)}
ORACLES = {"op11_prefix_trie": oracles.prefix_trie(), "op12_centroids": oracles.clustering()}
