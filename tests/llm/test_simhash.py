import itertools
import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import graph, simhash


def brute_print(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c == " " or "\t" <= c <= "\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, links):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {p: find(p) for p in prints}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "é", "\x0b", " ", "\t", "\n", "\x1c", "word", " ", "Ö", "  "]), max_size=30).map("".join))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_print(text)


def test_fingerprint_agrees_with_sparks_hash(spark):
    row = spark.sql("select xxhash64('one shingle only') as h").first()
    assert simhash._signed(simhash.fingerprint("one shingle ONLY")) == row["h"]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1000), min_size=3, max_size=3), min_size=3, max_size=5))
def test_allocation_is_the_cheapest(cost):
    got = simhash.allocate(cost, 3)
    options = [t for t in itertools.product(range(-1, 3), repeat=len(cost)) if sum(x + 1 for x in t) == 3]
    price = lambda t: sum(c[x] for c, x in zip(cost, t) if x >= 0)
    assert sum(x + 1 for x in got) == 3 and price(got) == min(map(price, options))


def clustered():
    draw = random.Random(11)
    prints = {0, (1 << 64) - 1, 1 << 63}
    for size in (3, 40, 400):
        centre = draw.getrandbits(64)
        for _ in range(size):
            x = centre
            for _ in range(draw.randint(0, 4)):
                x ^= 1 << draw.randrange(12 if size == 400 else 64)
            prints.add(x)
    return sorted(simhash._signed(p) for p in prints)


@pytest.mark.parametrize("thresholds", [None, (0, 0, 0), (1, 0, -1), (-1, -1, 2), (0, 1, -1)])
def test_links_connect_what_all_pairs_connect(spark, thresholds, monkeypatch):
    prints = clustered()
    wide = [(a, b) for a, b in itertools.combinations(prints, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2]
    if thresholds:
        whole = simhash.plan
        monkeypatch.setattr(simhash, "plan", lambda *a: (whole(*a)[0], thresholds))
    links = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp bigint"))
    got = [(r["a"], r["b"]) for r in links.collect()]
    # a link over a common neighbour is a link too, so every one given is within the distance
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in got)
    assert brute_components(prints, got) == brute_components(prints, wide)


def test_bits_that_go_together_share_a_group(spark):
    draw = np.random.default_rng(3)
    bits = draw.integers(0, 2, (3000, 64))
    bits[:, 40] = bits[:, 3]
    bits[:, 50] = 1 - bits[:, 3]
    fps = [simhash._signed(int(sum(int(v) << k for k, v in enumerate(r)))) for r in bits]
    n, both = simhash.bit_counts(spark.createDataFrame([(f,) for f in fps], "fp bigint"))
    assert n == 3000 and both[3, 40] == int((bits[:, 3] & bits[:, 40]).sum())
    groups = simhash.group_bits(n, both, 3)
    assert sorted(b for g in groups for b in g) == list(range(64)) and any({3, 40, 50} <= set(g) for g in groups)


def test_components_against_union_find(spark, rows):
    draw = random.Random(2)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(80)] + [(5000, 5000)]
    nodes = sorted({x for e in edges for x in e})
    got = dict(rows(graph.components(spark.createDataFrame(edges, "a bigint, b bigint"))))
    assert got == brute_components(nodes, edges)
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_documents_against_all_pairs(spark, tables):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    data = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    prints = {i: brute_print(t) for i, t in data}
    near = [(a, b) for a, b in itertools.combinations(sorted(prints), 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    want = brute_components(sorted(prints), near)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: (f"{p:016x}", want[i]) for i, p in prints.items()}
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_odd_rows(odd_docs, no_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    blank = {(r["doc_id"], r["component_id"]) for r in got if r["fingerprint"] == "0" * 16}
    assert blank == {(2, 2), (3, 2), (4, 2), (None, 2)}
    kept = simhash.one_of_each(odd_docs)
    ids = sorted(r["doc_id"] for r in kept.collect())
    assert kept.columns == odd_docs.columns and ids == [1, 2, 5, 6, 7]
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.one_of_each(no_docs).count() == 0


def test_every_null_id_gets_no_component(spark):
    docs = spark.createDataFrame([(None, "a b c d")] * 2, "doc_id bigint, text string")
    assert [r["component_id"] for r in simhash.near_duplicates(docs).collect()] == [None, None]
    assert simhash.one_of_each(docs).count() == 1
    assert simhash.near_duplicates(docs.withColumn("doc_id", F.lit(3).cast("bigint"))).where("component_id = 3").count() == 2
