import numpy as np

from tidemark.llm import embeddings


def drawn():
    draw = np.random.default_rng(7)
    rows, vectors = [], []
    for label in (0, 1):
        for _ in range(60):
            centre = draw.normal(size=16)
            for _ in range(draw.integers(1, 6)):
                vectors.append((label, centre + draw.normal(size=16) * draw.choice([0.0, 0.05, 0.12, 0.2])))
    hot = draw.normal(size=16)
    vectors += [(1, hot + draw.normal(size=16) * 0.05) for _ in range(300)]
    for k, (label, v) in enumerate(vectors):
        rows.append((k, v.astype(np.float32).tolist(), label))
    n = len(rows)
    rows += [(n, rows[0][1], 0), (n + 1, rows[0][1], 1), (n + 2, rows[0][1], None), (n + 3, None, 0), (n + 4, [0.0] * 16, 0), (n + 5, [float("nan")] * 16, 0),
             (n + 6, [None] + [1.0] * 15, 0), (n + 7, [], 0), (n + 8, [float("inf")] * 16, 0), (n + 9, rows[0][1][:8], 0), (n + 10, rows[0][1][:8], 0), (n + 11, [1.0], 0)]
    return rows


def brute(rows, least=0.93):
    ok = [v is not None and len(v) > 0 and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, label in rows]
    links = {k: set() for k in range(len(rows))}
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if o else None for (_, v, _), o in zip(rows, ok)]
    for a in range(len(rows)):
        for b in range(a):
            if ok[a] and ok[b] and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least:
                links[a].add(b)
                links[b].add(a)
    return links


def reach(links, rows):
    out = {}
    for k in links:
        seen, todo = {k}, [k]
        while todo:
            for x in links[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        out[k] = min(rows[x][0] for x in seen)
    return out


def check(spark, rows, least_recall):
    frame = spark.createDataFrame([(i, v, label, "x") for i, v, label in rows], "vec_id bigint, embedding array<float>, label int, key string").repartition(5)
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(frame).collect()}
    links, total = brute(rows), 0
    assert len(got) == len(rows)
    for k in links:
        assert got[k]["n_links"] <= len(links[k])
        total += got[k]["n_links"]
    assert total >= least_recall * sum(map(len, links.values()))
    return got, links


def test_recall_and_counts(spark):
    rows = drawn()
    got, links = check(spark, rows, 0.97)
    if all(got[k]["n_links"] == len(links[k]) for k in links):
        assert {k: got[k]["component_id"] for k in links} == reach(links, rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_blocks_of_a_large_cell_count_each_pair_once(spark, monkeypatch):
    rows = drawn()
    whole, _ = check(spark, rows, 0.97)
    monkeypatch.setattr(embeddings, "BLOCK", 37)
    assert {k: (r["n_links"], r["component_id"]) for k, r in check(spark, rows, 0.97)[0].items()} == {
        k: (r["n_links"], r["component_id"]) for k, r in whole.items()}


def test_given_table_recall(spark):
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    check(spark, rows, 0.95)


def test_traversal_is_in_order_and_complete():
    draw = np.random.default_rng(1)
    a, b = draw.random(9), draw.random(7)
    cells = embeddings.traverse(a, b, 0.6)
    sums = [a[i] + b[j] for i, j in cells]
    assert sums == sorted(sums) and set(cells) == {(i, j) for i in range(9) for j in range(7) if a[i] + b[j] <= a.min() + b.min() + 0.6}


def test_ids(spark):
    rows = [(None, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (5, [1.0, 0.001], 1), (4, [0.0, 1.0], 1), (4, [0.0, 1.0], 1)]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got), key=str) == sorted(
        [(None, 2, 5, False), (5, 2, 5, True), (5, 2, 5, True), (4, 1, 4, True), (4, 1, 4, True)], key=str)
    none = embeddings.near_duplicates(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int"))
    assert none.count() == 0
    assert embeddings.near_duplicates(spark.createDataFrame([(1, None, 3)], "vec_id bigint, embedding array<float>, label int")).first()["kept"]


def test_rare_planted_links_are_all_found(spark):
    draw = np.random.default_rng(3)
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in given]
    planted = {}
    for n, cosine in enumerate([0.931, 0.935, 0.94, 0.945, 0.95, 0.96]):
        x = np.array(rows[331 * n][1], float)
        x /= np.linalg.norm(x)
        side = draw.normal(size=len(x))
        side -= (side @ x) * x
        planted[10**6 + n] = rows[331 * n][0]
        rows.append((10**6 + n, (cosine * x + (1 - cosine * cosine) ** 0.5 * side / np.linalg.norm(side)).tolist(), rows[331 * n][2]))
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(4)).collect()}
    assert [k for k, other in planted.items() if (got[k]["n_links"], got[k]["component_id"]) != (1, other)] == []


def planted_rows(given, cosines, seed=11):
    """The given rows, and a neighbour of drawn ones at each cosine; every second one leans to a vector of its own label."""
    draw = np.random.default_rng(seed)
    rows = [(k, list(r["embedding"]), r["label"]) for k, r in enumerate(given)]
    chosen = draw.permutation(len(given))[:len(cosines)]
    for n, (at, cosine) in enumerate(zip(chosen, cosines)):
        x = np.array(rows[at][1], float)
        x /= np.linalg.norm(x)
        side = draw.normal(size=len(x)) if n % 2 else np.array(next(r[1] for r in rows[n:] if r[2] == rows[at][2] and r[0] != rows[at][0]), float)
        side -= (side @ x) * x
        rows.append((len(rows), (cosine * x + (1 - cosine * cosine) ** 0.5 * side / np.linalg.norm(side)).tolist(), rows[at][2]))
    return rows


def all_links(rows, least=0.93):
    """Whether two rows link, for all pairs."""
    x, labels = np.array([v for _, v, _ in rows]), np.array([label for *_, label in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return (x @ x.T >= least) & (labels[:, None] == labels[None]) & ~np.eye(len(x), dtype=bool)


def test_hard_neighbours_among_the_given_vectors(spark):
    rows = planted_rows(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect(), np.linspace(0.9302, 0.96, 600))
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(5)
    got = {r["vec_id"]: r["n_links"] for r in embeddings.near_duplicates(frame).collect()}
    truth = all_links(rows).sum(axis=1)
    assert truth.sum() >= 1200 and len(got) == len(rows) and all(got[k] <= n for k, n in enumerate(truth)) and sum(got.values()) >= 0.99 * truth.sum()


def reps_of(spark, rows):
    return spark.createDataFrame([(str(i), v, label, 1) for i, v, label in rows], "key string, embedding array<double>, label bigint, weight bigint")


def test_walk_is_short_and_meets_drawn_links(spark):
    rows = planted_rows(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect(), np.linspace(0.9302, 0.96, 600))
    reps = reps_of(spark, rows)
    indexes = embeddings.fit(reps)
    index, x = indexes[64], embeddings.unit([v for _, v, _ in rows])
    first, second = index.distances(x)
    assert np.mean([len(index.visited(a, b)) for a, b in zip(first, second)]) < 0.1 * index.cells
    found = embeddings.measured(reps, indexes, queries=400, seed=2)
    links, met = (sum(f[k] for f in found.values()) for k in (0, 1))
    assert links > 100 and met >= 0.99 * links
    truth = all_links(rows).sum(axis=1)
    assert all(f[0] == truth[int(key)] for (_, key), f in found.items())


def test_planted_neighbours_have_the_cosines_asked_for():
    x = embeddings.unit(np.random.default_rng(4).normal(size=(200, 10)))
    index = embeddings.Index(x, 16)
    for own, near in embeddings.planted(index, x, 0.93):
        cosines = (own * near).sum(axis=1)
        assert len(own) == 200 and cosines.min() >= 0.93 - 1e-9 and cosines.max() <= 0.94 + 1e-9
    one = embeddings.unit([[1.0], [-1.0]])  # no direction is left beside a vector of one component
    assert [len(own) for own, _ in embeddings.planted(embeddings.Index(one, 1), one, 0.93)] == [0, 0]


def test_wider_links_than_planted_ones_widen_the_walk(spark):
    draw = np.random.default_rng(8)
    rows = [(k, draw.normal(size=16).tolist(), 0) for k in range(300)]
    reps = reps_of(spark, rows)
    indexes = embeddings.fit(reps)
    before = indexes[16].excess
    embeddings._widen(indexes, {(16, "a"): (1, 0, before + 1), (16, "b"): (1, 1, 0.0), (9, "c"): (1, 0, 5.0)}, 0.999)
    assert indexes[16].excess == before + 1 and set(indexes) == {16}


def test_a_length_the_sample_missed_is_searched_in_full(spark):
    rows = drawn()
    short = [(10**5 + k, v, 0) for k, v in enumerate([[1.0, 0.0, 0.0], [1.0, 0.01, 0.0], [0.0, 1.0, 0.0]])]
    frame = spark.createDataFrame(rows + short, "vec_id bigint, embedding array<double>, label int")
    got = {r["vec_id"]: r["n_links"] for r in embeddings.near_duplicates(frame, sample=20).collect()}
    assert [got[10**5 + k] for k in range(3)] == [1, 1, 0]
