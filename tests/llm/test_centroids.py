import hashlib
import math
import random

import numpy as np
import pytest

from tidemark.llm import centroids


def brute(rows, k, rounds, dims):
    """Full comparison of every vector with every centroid, in Python integers."""
    kept = [(i, [math.floor(float(x) * 1024) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    places = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), j) for j, c in enumerate(places))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for j in range(len(places)):
            mine = [v for (_, v), c in zip(kept, own) if c == j]
            if mine:
                places[j] = [sum(x) // len(mine) for x in zip(*mine)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = {j: sum(d for _, d, c in found if c == j) for j in range(len(places))}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in places]
    return [(i, c, d, inertia[c], sum(inertia.values()), digests[c]) for i, d, c in found]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<float>, cluster string").repartition(3)


@pytest.mark.parametrize("seed", [0, 1])
def test_equals_full_comparison(spark, rows, seed):
    draw = random.Random(seed)
    middles = [[draw.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    data = [(n, [float(np.float32(m + draw.gauss(0, 0.5))) for m in draw.choice(middles)]) for n in range(400)]
    data += [(n, data[0][1]) for n in range(400, 500)] + [(7, data[3][1]), (None, data[4][1])]
    data += [(900, None), (901, [1.0] * 5), (902, [1.0] * 5 + [None]), (903, [math.nan] * 6), (904, [math.inf] + [0.0] * 5), (905, []), (906, [0.0] * 6)]
    got = centroids.cluster(frame(spark, data), rounds=5, dims=6)
    assert rows(got) == sorted(brute(data, 8, 5, 6), key=lambda r: tuple((v is None, str(v)) for v in r))


def test_few_rows_ties_and_empty_clusters(spark, rows):
    data = [(n, [1.0, 2.0]) for n in range(5)] + [(9, [-1.0, 0.0])]
    assert rows(centroids.cluster(frame(spark, data), rounds=3, dims=2)) == sorted(brute(data, 8, 3, 2), key=lambda r: tuple((v is None, str(v)) for v in r))
    assert centroids.cluster(frame(spark, data), dims=3).collect() == []
    assert centroids.cluster(frame(spark, []), dims=2).collect() == []
    assert [r[1:3] for r in rows(centroids.cluster(frame(spark, [(1, [3e38, -3e38])]), dims=2))] == [(0, 0)]


def test_loosening_is_a_bound_and_below_the_drift(spark):
    draw = np.random.default_rng(5)
    below = 0
    for _ in range(300):
        centre, old = draw.normal(size=4) * 10, draw.normal(size=4) * 10
        new, radius = old + draw.normal(size=4) * draw.choice([0.1, 1, 5]), draw.uniform(0, 6)
        bound, drift = centroids.loosening(centre, radius, old, new), np.linalg.norm(new - old)
        points = draw.normal(size=(500, 4))
        points = centre + points / np.linalg.norm(points, axis=1)[:, None] * radius * draw.uniform(0, 1, (500, 1)) ** 0.1
        fall = np.linalg.norm(points - old, axis=1) - np.linalg.norm(points - new, axis=1)
        assert fall.max() <= bound <= drift
        below += bound < 0.9 * drift
    assert below > 100


def test_bounds_spare_most_comparisons(spark):
    draw = random.Random(2)
    data = [(n, [float(10 * (n % 8)) + draw.gauss(0, 0.1), draw.gauss(0, 0.1)]) for n in range(800)]
    places, state, scans = centroids.fit(centroids.scaled(frame(spark, data), dims=2), 8, 10, 3, 2)
    assert len(places) == 8 and state.count() == 800
    assert scans[0] == 800 and sum(scans[1:]) < 0.3 * 800 * 10


def test_large_components_are_exact():
    v, c = np.array([[1 << 27, -(1 << 27)]]), np.array([[-(1 << 27), 1 << 27], [1, 0]])
    assert centroids.squared(v, c).tolist() == [[1 << 57, (2**27 - 1) ** 2 + 2**54]]
