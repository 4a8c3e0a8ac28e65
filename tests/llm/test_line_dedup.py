import random

from pyspark.sql import functions as F

from tidemark.llm import line_dedup


def passage(draw, words, lines):
    own = ["w%d" % draw.randrange(10**6) for _ in range(words)]
    size = -(-words // lines)
    return [" ".join(own[i:i + size]) for i in range(0, words, size)]


def corpus():
    draw = random.Random(4)
    shared = [passage(draw, 60, 1), passage(draw, 66, 6), passage(draw, 72, 18), passage(draw, 30, 2)]
    docs = []
    for k in range(120):
        lines = [x for _ in range(draw.randint(1, 6)) for x in passage(draw, draw.randint(3, 40), draw.randint(1, 4))]
        if k % 3 == 0:
            at = draw.randrange(len(lines) + 1)
            lines[at:at] = shared[k // 3 % 4]
        docs.append((k, "\n".join(lines)))
    return docs, shared


def brute(docs, least=50):
    """Kept text of each document by the rule, stretch by stretch, with none of the library's functions.

    A stretch of neighbouring filled lines with 50 words or more is repeated if an earlier place holds the same lines, not counting places that
    overlap it through equal stretches. Its first place stays with all its lines; lines of other repeated stretches go.
    """
    filled, words = [], []
    for _, text in docs:
        own = [(i, x) for i, x in enumerate((text or "").split("\n")) if x.split()]
        filled.append(own)
        words.append([len(x.split()) for _, x in own])
    places = {}
    for k in sorted(range(len(docs)), key=lambda k: (docs[k][0] is None, docs[k][0] or 0)):
        for a in range(len(filled[k])):
            for b in range(a, len(filled[k])):
                total = sum(words[k][a:b + 1])
                if total >= least and min(total - words[k][a], total - words[k][b]) < least:
                    places.setdefault(tuple(x for _, x in filled[k][a:b + 1]), []).append((k, a, b))
                if total - words[k][a] >= least:
                    break  # longer stretches are made up of shorter ones
    keep, gone = [set() for _ in docs], [set() for _ in docs]
    for found in places.values():
        chains = []
        for k, a, b in found:
            if chains and chains[-1][0] == k and a <= chains[-1][2]:
                chains[-1][2] = b
            else:
                chains.append([k, a, b])
        if len(chains) > 1:
            for n, (k, a, b) in enumerate(chains):
                (gone if n else keep)[k].update(range(a, b + 1))
    out = {}
    for k, (_, text) in enumerate(docs):
        lines, cut = (text or "").split("\n"), set()
        numbers = sorted(gone[k] - keep[k])
        for n in numbers:
            cut.add(filled[k][n][0])
            if n + 1 in numbers:  # blank lines between lines that go
                cut.update(range(filled[k][n][0], filled[k][n + 1][0]))
        out[k] = "\n".join(x for i, x in enumerate(lines) if i not in cut)
    return out


def test_against_brute_force(spark):
    docs, shared = corpus()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    kept, own = line_dedup.dedup(frame)
    got = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert got == brute(docs)
    for k, lines in enumerate(shared):  # whole passages stay in one document; a short one is no passage
        holders = [i for i, t in got.items() if all(x in t.split("\n") for x in lines)]
        assert len(holders) == (1 if k < 3 else 10)
    touched = {r["doc_id"] for r in kept.where(F.col(f"{own}_gone") > 0).collect()}
    assert all(got[i] == t for i, t in docs if i not in touched) and touched <= {i for i, _ in docs if i % 3 == 0}


def test_boundaries_resist_shifts():
    draw = random.Random(9)
    lines = passage(draw, 400, 80)
    whole = {c for *_, c in line_dedup.chunks("\n".join(lines))}
    shifted = {c for *_, c in line_dedup.chunks("\n".join(["a new line", *lines[:30], "", "one more", *lines[30:]]))}
    assert len(whole & shifted) >= len(whole) - 4


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    data = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(docs)[0].collect()}
    assert got == {data[k][0]: t for k, t in brute(data).items()}


def test_odd_rows(odd_docs, no_docs, spark):
    kept, own = line_dedup.dedup(odd_docs)
    assert kept.columns[:-2] == odd_docs.columns and kept.count() == odd_docs.count()
    assert kept.where("text is null").count() == 3 and kept.where("text = ''").count() == 1
    same = spark.createDataFrame([(1, "x " * 80), (1, "x " * 80), (None, "x " * 80), (2, "x " * 80)], "doc_id bigint, text string")
    assert sorted((r["doc_id"] or 0, r["text"]) for r in line_dedup.dedup(same)[0].collect()) == [(0, ""), (1, "x " * 80), (1, "x " * 80), (2, "")]
    assert line_dedup.dedup(no_docs)[0].count() == 0


def test_short_lines_at_the_ends_of_a_passage_go_with_it(spark):
    draw = random.Random(12)
    middle = [x for n in (3, 1, 10, 37) for x in passage(draw, n, 1)]
    docs = []
    for k in range(24):  # other lines before and behind, long ones, short ones or none
        before, after = ([x for n in draw.choice([(), (20,), (2, 1, 4), (30, 2)]) for x in passage(draw, n, 1)] for _ in range(2))
        docs.append((k, "\n".join([*before, *middle, *after]), "\n".join([*before, *after])))
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(spark.createDataFrame([d[:2] for d in docs], "doc_id bigint, text string").repartition(3))[0].collect()}
    assert got == {k: whole if k == 0 else rest for k, whole, rest in docs}


def test_the_copy_that_stays_is_not_cut(spark):
    draw = random.Random(31)
    a, b, c, d, z = (passage(draw, 25, 1)[0] for _ in range(5))
    docs = [(0, f"{b}\n{c}"), (1, f"{a}\n{b}\n{c}\n{d}"), (2, f"{a}\n{b}\n{z}")]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(spark.createDataFrame(docs, "doc_id bigint, text string"))[0].collect()}
    assert got == brute(docs) == {0: f"{b}\n{c}", 1: f"{a}\n{b}\n{d}", 2: z}


def test_a_passage_is_no_repeat_of_itself(spark):
    line = "one two three four five six seven eight nine ten"
    docs = [(0, "\n".join([line] * 40)), (1, "new\n" + "\n".join([line] * 60)), (2, "\n".join([line] * 4))]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(spark.createDataFrame(docs, "doc_id bigint, text string"))[0].collect()}
    assert got == brute(docs) == {0: docs[0][1], 1: "new", 2: docs[2][1]}


def test_drawn_overlaps_against_brute_force(spark):
    draw = random.Random(8)
    pool = [" ".join(f"p{k}w{i}" for i in range(draw.randint(8, 30))) for k in range(12)]
    docs = []
    for k in range(60):
        at = draw.randrange(8)
        lines = pool[at:at + draw.randint(1, 6)] + ([pool[0]] * draw.randint(0, 8) if draw.random() < 0.3 else []) + [f"own{k} " * draw.randint(1, 20)]
        docs.append((k, "\n".join(lines + [""] * draw.randint(0, 1) + draw.sample(pool, draw.randint(0, 2)))))
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3))[0].collect()}
    assert got == brute(docs)


def test_windows_against_all_stretches():
    draw = random.Random(2)
    for _ in range(60):
        own = [(n, n, n + 1, draw.randint(1, 30), "") for n in range(draw.randint(0, 14))]
        enough = {(a, b) for a in range(len(own)) for b in range(a, len(own)) if sum(c[3] for c in own[a:b + 1]) >= 50}
        got = set(line_dedup.windows(own, 50))
        assert got <= enough
        for a, b in enough:
            assert {n for x, y in got if a <= x and y <= b for n in range(x, y + 1)} == set(range(a, b + 1))


def test_lines_that_repeat_in_different_documents_are_no_passage(spark):
    draw = random.Random(21)
    lines = passage(draw, 120, 12)
    docs = [(k, "\n".join([*passage(draw, 20, 2), lines[k], *passage(draw, 20, 2)])) for k in range(12)]
    docs += [(20, "\n".join(lines)), (21, "\n".join(["new words here", *lines[:5], "", *lines[5:9], lines[10], "and more"]))]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3))[0].collect()}
    # document 20 is put together from lines of twelve others; document 21 repeats nine neighbouring ones of it, past a blank line, and one more
    assert got == dict(docs) | {21: "\n".join(["new words here", lines[10], "and more"])}


def test_rolling_hash_is_that_of_the_lines_alone():
    draw = random.Random(6)
    lines = [str(draw.randrange(5)) for _ in range(300)]
    whole = line_dedup.rolling(lines)
    for _ in range(300):
        a = draw.randrange(300)
        b = draw.randrange(a, min(300, a + 12))
        assert whole(a, b) == line_dedup.rolling(lines[a:b + 1])(0, b - a) != line_dedup.rolling(lines, key=1)(a, b)
    seen = {}
    for a in range(300):
        for b in range(a, min(300, a + 9)):
            assert seen.setdefault(whole(a, b), lines[a:b + 1]) == lines[a:b + 1]
    assert len(seen) == len({tuple(x) for x in seen.values()})


def test_passages_under_one_hash_are_told_apart_by_their_bytes(spark, monkeypatch):
    docs, _ = corpus()
    keys, count = [], line_dedup.repeated_ranges

    def counted(docs, words, key):
        keys.append(key)
        return count(docs, words, key)

    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)

    def passages(docs, words, key, own=line_dedup._passages):
        return own(docs, words, key) if key else own(docs, words, key).withColumn("digest", F.sha1(F.lit("one")).cast("binary"))

    monkeypatch.setattr(line_dedup, "repeated_ranges", counted)
    monkeypatch.setattr(line_dedup, "_passages", passages)
    assert {r["doc_id"]: r["text"] for r in line_dedup.dedup(frame)[0].collect()} == brute(docs)
    assert keys == [0, 1]


def test_stretches_of_a_text_that_only_share_a_hash_stay_apart(monkeypatch):
    own = line_dedup.chunks("a b\nc d\ne f\na b")
    monkeypatch.setattr(line_dedup, "_number", lambda data, key: 0)
    assert [o[1:] for o in line_dedup.occurrences(own, 4)] == [[0, 1, 2], [1, 2, 2], [2, 3, 2]]
    same = line_dedup.chunks("a b\na b\na b\na b")
    assert [o[1:] for o in line_dedup.occurrences(same, 4)] == [[0, 3, 2]]
