import hashlib
import random
import re

from tidemark.llm import decontaminate

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    grams = {}
    for i, text in items:
        w = words(text)
        for k in range(max(1, len(w) - 12) if w and i is not None else 0):
            grams.setdefault(tuple(w[k:k + 13]), set()).add(str(i))
    out = []
    for i, text in docs:
        w, hit, of = words(text), set(), set()
        for g, own in grams.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k:k + len(g)]) == g:
                    hit.update(range(k, k + len(g)))
                    of |= own
        out.append((i, len(w), len(hit), len(of), hashlib.sha256(",".join(sorted(of)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def drawn(spark):
    draw = random.Random(5)
    pool = ["alpha", "Beta", "gämma", "delta", "x1", "É", "zeta", "a-b", "o'k"]
    items = [(k, " ".join(draw.choice(pool) for _ in range(draw.choice([0, 1, 3, 12, 13, 14, 30])))) for k in range(25)]
    items += [(7, items[7][1]), (100, items[3][1]), (None, "alpha beta delta zeta"), (101, None), (102, "  ... ")]
    docs = []
    for k in range(60):
        text = " ".join(draw.choice(pool) for _ in range(draw.randint(0, 80)))
        if k % 2:
            text = text[:20] + ", " + (draw.choice(items)[1] or "").upper().replace(" ", " -\n") + "; " + text
        docs.append((k, text))
    docs += [(None, items[8][1]), (60, None), (61, ""), (5, docs[5][1])]
    return docs, items


def frames(spark):
    docs, items = drawn(spark)
    return (docs, items, spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id bigint, text string, __found_n string").repartition(3),
            spark.createDataFrame([(i, t, 0) for i, t in items], "item_id bigint, text string, doc_id int"))


def test_against_brute_force(spark, rows):
    docs, items, d, b = frames(spark)
    want = brute(docs, [(i, t) for i, t in items])
    assert sorted(rows(decontaminate.scan(d, b)), key=str) == want
    # the same in several passes
    assert sorted(rows(decontaminate.scan(d, b, block_bytes=500)), key=str) == want


def test_pieces_of_long_items_and_few_rows_held(spark, rows, monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE", 2)
    monkeypatch.setattr(decontaminate, "HELD_BYTES", 400)
    docs, items, d, b = frames(spark)
    assert sorted(rows(decontaminate.scan(d.repartition(2), b, block_bytes=700)), key=str) == brute(docs, items)


def test_clean_keeps_the_rest_as_it_is(spark, rows):
    docs, items, d, b = frames(spark)
    want = sorted([i for i, *_, bad in brute(docs, items) if not bad], key=str)
    kept = decontaminate.clean(d, b)
    assert kept.columns == d.columns and sorted([r[0] for r in rows(kept)], key=str) == want


def test_passages_point_into_the_original(spark, rows):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    text = "Ünd: ONE, two-three four five six seven eight nine ten eleven twelve\nthirteen FOURTEEN! end"
    d = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    b = spark.createDataFrame([(9, item)], "item_id bigint, text string")
    assert rows(decontaminate.passages(d, b)) == [(1, text.index("ONE"), text.index("!"), ["9"])]


def test_empty_sides_and_odd_rows(spark, odd_docs, no_docs, rows):
    none = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "quick brown")], "item_id bigint, text string")
    assert all(r[2] == 0 and not r[5] for r in rows(decontaminate.scan(odd_docs, none)))
    assert decontaminate.scan(no_docs, some).count() == 0 and decontaminate.clean(no_docs, some).count() == 0
    assert sorted(r[2] for r in rows(decontaminate.scan(odd_docs, some)))[-3:] == [2, 2, 2]
    assert decontaminate.clean(odd_docs, some).count() == odd_docs.count() - 3
