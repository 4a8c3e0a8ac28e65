import corpus_pipeline
import pytest

import __spark_entry__

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.settle(stage(spark, before, folder), name)
        assert after.columns == docs.columns and after.schema == before.schema, name
        assert 0.7 * before.count() < after.count() <= before.count(), name
        assert (after.count() == before.count()) == (name == "line_dedup"), name
        before = after
    assert before.where("n_chars <> length(text)").isEmpty()
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(r["doc_id"] for r in whole.collect()) == sorted(r["doc_id"] for r in before.collect())
    assert whole.where("n_tokens <> size(ids)").isEmpty()


def test_stages_take_odd_rows(spark, odd_docs, no_docs):
    cols = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    odd = spark.createDataFrame([(r["doc_id"], r["text"], None, "s", None) for r in odd_docs.collect()], cols)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, SMALL).count() > 0
        assert stage(spark, no_docs, SMALL).count() == 0


@pytest.mark.parametrize("name", sorted(n for n in __spark_entry__.queries() if n.startswith("op") and n[2].isdigit()))
def test_registered(spark, name):
    first = {"1": "page_id url text n_chars", "2": "doc_id fingerprint component_id", "3": "doc_id n_assign n_access n_hex base_sha256 spans",
             "4": "vec_id n_links component_id kept", "5": "doc_id held_out score predicted", "6": "doc_id n_tokens ids_sha256 decoded_sha256",
             "7": "doc_id text", "8": "page_id host path rule verdict", "9": "doc_id n_words n_hit n_items items_sha256 contaminated",
             "10": "doc_id n_bytes n_tokens over_limit",
             "11": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
             "12": "vec_id cluster distance cluster_inertia inertia centroid_sha256", "13": "doc_id n_tokens ids_sha256 decoded_sha256"}[name[2:].split("_")[0]].split()
    got = __spark_entry__.queries()[name](spark, SMALL)
    assert got.columns[:len(first)] == first
    if name.startswith("op11_"):  # one row for each node; the root's members are all conversations
        assert got.where("depth = 0").first()["n_convs"] == spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id").distinct().count()
        return
    of = {"12": "embeddings", "1": "pages", "8": "pages", "4": "embeddings"}.get(name[2:].split("_")[0], "documents")
    assert got.count() == spark.read.parquet(f"{SMALL}/{of}.parquet").count()
