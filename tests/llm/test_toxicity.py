import random
import zlib

from tidemark.llm import toxicity

MARKS = ["idiot", "moron", "scum", "loser", "clown", "stupid", "worthless", "disgusting", "pathetic", "trash"]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).where("held_out").join(labels, "doc_id").join(docs, "doc_id").collect()
    # labels are noisy both ways: marked words say for sure, rows without them are labelled at random
    marked = [r for r in scored if r["toxic"] == 1 and any(f" {w}" in r["text"].lower() for w in MARKS)]
    clean = [r for r in scored if r["toxic"] == 0]
    assert len(marked) > 30 and sum(r["predicted"] for r in marked) >= 0.8 * len(marked)
    assert sum(r["predicted"] for r in clean) <= 0.03 * len(clean)


def test_whole_texts_are_scored():
    draw = random.Random(1)
    pool = ["".join(draw.choice(["ka", "lo", "mi", "ren", "so", "tu", "vel"]) for _ in range(draw.randint(1, 4))) for _ in range(500)]
    plain = [" ".join(draw.choice(pool) for _ in range(60)) for _ in range(240)]
    model = toxicity.fit_texts([t + " what a worthless idiot" for t in plain[::2]], plain[1::2])
    assert model.score(plain[0] + " worthless idiot") > 0.5 > model.score(plain[0])
    assert model.score(" ".join(plain) + " worthless idiot") > model.score(" ".join(plain))
    assert toxicity.windows("a " * 100_000)[-1] == b" a a a a a a a a "


def test_rows(spark, odd_docs, no_docs, rows):
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(40)] + [(None, 1, 1), (3, None, None)], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(odd_docs, labels)
    got = rows(toxicity.score(odd_docs, model))
    assert len(got) == odd_docs.count() and all(0 <= r[2] <= 1 and r[3] == (r[2] >= 0.5) for r in got)
    assert all(r[1] == (r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0) for r in got)
    assert toxicity.score(no_docs, toxicity.fit(no_docs, labels)).count() == 0
    kept = toxicity.keep_ordinary(odd_docs, model)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r[3] == 0 for r in got)


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs = spark.createDataFrame([(k, f"text {k} " + "word " * 20) for k in range(60)], "doc_id bigint, text string")
    held = [k for k in range(60) if zlib.crc32(str(k).encode()) % 5 == 0]
    one = spark.createDataFrame([(k, int(k < 30)) for k in range(60)], "doc_id bigint, toxic int")
    other = spark.createDataFrame([(k, int(k < 30) if k not in held else 1 - int(k < 30)) for k in range(60)], "doc_id bigint, toxic int")
    assert toxicity.fit(docs, one) == toxicity.fit(docs, other)
