import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string, n bigint, path string, stem string, ids string"


def brute(data):
    """Every prefix of every rebuilt conversation in a dictionary."""
    own = defaultdict(list)
    for c, turn, role, text in data:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    seqs = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        seqs[c] = tuple(own.get(c - c % 5, [])[:h] + ts[h:])
    members = defaultdict(list)
    for c in sorted(seqs):
        for d in range(len(seqs[c]) + 1):
            members[seqs[c][:d]].append(c)
    children = defaultdict(int)
    for key in members:
        if key:
            children[key[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for key, cs in members.items():
        for d in range(len(key) + 1):
            leaves[key[:d]] += children[key] == 0
            saved[key[:d]] += (len(cs) - 1) * len(key[-1][1].encode()) if key else 0
    return {(cs[0], len(key), members[key[:-1]][0] if key else None, len(cs), children[key], leaves[key], saved[key],
             hashlib.sha256(",".join(str(c) for c in cs if len(seqs[c]) == len(key)).encode()).hexdigest()) for key, cs in members.items()}


def frame(spark, data):
    return spark.createDataFrame([(*r, 5, "p", "s", "i") for r in data], SCHEMA).repartition(4)


def drawn(seed, convs=150, texts=4, longest=14):
    draw = random.Random(seed)
    data = []
    for c in draw.sample(range(convs * 2), convs):
        data += [(c, t, draw.choice(["user", "assistant"]), draw.choice(["a", "bb", "é日", "dddd"][:texts])) for t in range(draw.randint(1, longest))]
    return data


@pytest.mark.parametrize("seed, block, range_ids", [(0, 256, 400_000), (1, 256, 40), (2, 5, 60), (4, 7, 7)])
def test_equals_all_prefixes(spark, monkeypatch, seed, block, range_ids):
    monkeypatch.setattr(conversations, "RANGE_IDS", range_ids)
    data = drawn(seed)
    got = conversations.prefix_trie(frame(spark, data), block=block).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == brute(data)


def test_equal_conversations_spread_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(conversations, "RANGE_IDS", 50)
    data = [(c, t, "user", f"turn {t}") for c in range(120) for t in range(12)] + drawn(5, 30)
    data = [(c + (1000 if k >= 1440 else 0), *r) for k, (c, *r) in enumerate(data)]
    got = conversations.prefix_trie(frame(spark, data), block=5).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == brute(data)


def test_nulls_empty_texts_repeats_and_absent_bases(spark):
    data = [(1, None, "user", "x"), (1, 3, None, None), (1, 2, "", ""), (2, 1, "user", "y"), (2, 1, "user", "y"), (None, 1, "user", "z"), (7, None, None, None),
            (5, 1, "user", "x"), (5, 2, "user", "x"), (9, 4, "user", "x" * 100_000), (9, 5, "user", "日" * 1000)]
    assert {tuple(r) for r in conversations.prefix_trie(frame(spark, data)).collect()} == brute(data)
    assert conversations.prefix_trie(frame(spark, [])).collect() == []
    assert conversations.prefix_trie(frame(spark, [(None, 1, "a", "b")])).collect() == []


def test_medians_fill_a_balanced_tree():
    for n in (0, 1, 2, 7, 100):
        order = list(conversations.medians(n))
        assert sorted(order) == list(range(n))
    trees = conversations.Trees()
    for k in conversations.medians(1023):
        trees.insert((0, k), (0, 1), 1, k)
    depth, at = 0, [trees.below[trees.top]]
    while at:
        depth, at = depth + 1, [c for a in at for c in (trees.small[a], trees.large[a]) if c >= 0]
    assert depth == 10 and trees.n[trees.top] == 1023 and len(trees.walk()) == 1024
