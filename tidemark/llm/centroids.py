"""Centroid clustering in exact integers, with distance bounds that are loosened by the geometry of each centroid's move."""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..session import scratch_path, settle
from .common import bare

#: Components are held within this bound, so that every squared distance is an exact 64-bit integer.
COMPONENT_BOUND = 1 << 27
#: Pieces into which a centroid's move is cut when its effect on a sphere of vectors is bounded.
STEPS = 16
#: Slack of comparisons between bounds, far above what floating point loses in a round.
SLACK = 1e-6

STATE = pa.schema([("vec_id", pa.int64()), ("v", pa.list_(pa.int32())), ("cluster", pa.int32()), ("upper", pa.float64()), ("lower", pa.float64()),
                   ("part", pa.int32()), ("sums", pa.list_(pa.int64())), ("n", pa.int64()), ("radius", pa.float64()), ("scanned", pa.int64())])
STATE_DDL = ("vec_id bigint, v array<int>, cluster int, upper double, lower double, "
             "part int, sums array<bigint>, n bigint, radius double, scanned bigint")


def scaled(vectors, dims=64, scale=1024, id_col="vec_id", vector_col="embedding"):
    """``vec_id, v``: vectors of exactly ``dims`` finite components, each as the integer floor(scale * x).

    Vectors that are NULL, of another length, or hold a NULL or non-finite component are left out. Integers are held within
    2**27, so a component beyond that counts as the bound.
    """
    rows = bare(vectors, vec_id=id_col, embedding=vector_col)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    bound = float(COMPONENT_BOUND)
    whole = F.transform("embedding", lambda x: F.floor(F.greatest(F.lit(-bound), F.least(F.lit(bound), x.cast("double") * scale))).cast("int"))
    return rows.where((F.size("embedding") == dims) & finite).select(F.col("vec_id").cast("bigint").alias("vec_id"), whole.alias("v"))


def first_centroids(rows, k, seed):
    """The ``k`` vectors with the smallest sha256 of ``seed:vec_id``, in that order; equal hashes by vector, NULL ids last."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = rows.orderBy(digest.asc_nulls_last(), "v").limit(k).collect()
    return [list(r["v"]) for r in chosen]


def squared(vectors, centroids):
    """Exact squared distances, rows by centroids."""
    reach = max((int(np.abs(a).max()) for a in (vectors, centroids) if a.size), default=0)
    if reach < 1 << 22:  # every term and sum is a whole number below 2**53, so floating point is exact
        x, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]).astype(np.int64)
    out = np.empty((len(vectors), len(centroids)), np.int64)
    for j, c in enumerate(centroids):
        d = vectors - c
        out[:, j] = (d * d).sum(1)
    return out


def loosening(centre, radius, old, new):
    """Most by which the distance from a point within ``radius`` of ``centre`` to a centroid can fall when it moves from ``old`` to ``new``.

    While the centroid moves, a point's distance falls at the speed times the cosine of the angle between the move and the direction to
    the point. In the plane through ``centre`` and the move, the sphere's points lie within asin(radius / distance) of the direction to its centre,
    so that angle is at least the centre's angle less that half-angle. The centre's angle only grows along the move; the half-angle of
    a piece of the move is taken at the piece's nearest place. The sum over the pieces is never above the length of the move, and
    below zero where the centroid moves away from the whole sphere.
    """
    move = new - old
    length = float(np.linalg.norm(move))
    if length == 0.0:
        return 0.0
    along = move / length
    ahead = float((centre - old) @ along)                       # planar coordinates of the centre, seen from the old place
    beside = math.sqrt(max(0.0, float((centre - old) @ (centre - old)) - ahead * ahead))
    total = 0.0
    for s in range(STEPS):
        begin, end = length * s / STEPS, length * (s + 1) / STEPS
        nearest = math.hypot(max(ahead - end, begin - ahead, 0.0), beside)
        if nearest <= radius * (1 + SLACK) + SLACK:
            total += length / STEPS
        else:
            angle = math.atan2(beside, ahead - begin) - math.asin(min(1.0, radius / nearest))
            total += length / STEPS * math.cos(max(0.0, angle))
    return min(length, total + SLACK * (1 + length))


def moves(old, new, radii):
    """For each cluster, how far its own centroid moved and the most by which any other centroid came nearer to its members."""
    old, new = np.asarray(old, np.float64), np.asarray(new, np.float64)
    own = np.linalg.norm(new - old, axis=1)
    nearer = [max((loosening(old[i], radii[i], old[j], new[j]) for j in range(len(old)) if j != i), default=-math.inf) for i in range(len(old))]
    return own, np.asarray(nearer)


def assign(vectors, centroids, cluster=None, upper=None, lower=None):
    """Nearest centroids, ties to the smaller number: cluster, upper bound of the distance to it, lower bound of that to every other, rows scanned.

    With bounds of the round before (already loosened), rows whose upper bound is below the lower one keep their cluster; the rest
    first get their exact own distance, and those still ambiguous are compared with every centroid.
    """
    n = len(vectors)
    if cluster is None:
        cluster, upper, lower = np.zeros(n, np.int32), np.full(n, math.inf), np.full(n, -math.inf)
        doubt = np.arange(n)
    else:
        doubt = np.flatnonzero(upper * (1 + SLACK) + SLACK >= lower)
        if doubt.size:
            own = np.empty(doubt.size, np.float64)
            for c in np.unique(cluster[doubt]):
                mine = cluster[doubt] == c
                own[mine] = np.sqrt(squared(vectors[doubt[mine]], centroids[c:c + 1])[:, 0])
            upper[doubt] = own
            doubt = doubt[own * (1 + SLACK) + SLACK >= lower[doubt]]
    if doubt.size:
        exact = squared(vectors[doubt], centroids)
        best = exact.argmin(1)
        at = np.arange(doubt.size)
        cluster[doubt], upper[doubt] = best, np.sqrt(exact[at, best])
        exact[at, best] = np.iinfo(np.int64).max
        lower[doubt] = np.sqrt(exact.min(1)) if centroids.shape[0] > 1 else math.inf
    return cluster, upper, lower, doubt.size


def _round(table, centroids, dims, drift=None):
    """One pass over the state: new assignments and bounds, and for each task one row of sums for each cluster, flagged by ``part``."""
    k = len(centroids)

    def run(batches):
        places = np.asarray(centroids, np.int64)
        sums, counts, radii, scanned = np.zeros((k, dims), np.int64), np.zeros(k, np.int64), np.zeros(k), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch["v"].flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)
            bounds = ()
            if drift:
                cluster = batch["cluster"].to_numpy(zero_copy_only=False).astype(np.int32)
                bounds = (cluster, batch["upper"].to_numpy(zero_copy_only=False) + drift[0][cluster], batch["lower"].to_numpy(zero_copy_only=False) - drift[1][cluster])
            cluster, upper, lower, n = assign(vectors, places, *bounds)
            scanned += n
            for c in np.unique(cluster):
                mine = cluster == c
                sums[c] += vectors[mine].sum(0)
                counts[c] += mine.sum()
                radii[c] = max(radii[c], upper[mine].max())
            values = {"vec_id": batch["vec_id"], "v": batch["v"], "cluster": pa.array(cluster, pa.int32()), "upper": pa.array(upper),
                      "lower": pa.array(lower), "part": pa.array(np.full(len(vectors), -1, np.int32))}
            yield pa.RecordBatch.from_arrays([values[f.name] if f.name in values else pa.nulls(len(vectors), f.type) for f in STATE], schema=STATE)
        filled = [c for c in range(k) if counts[c]]
        values = {"part": filled, "sums": [sums[c].tolist() for c in filled], "n": [int(counts[c]) for c in filled],
                  "radius": [float(radii[c]) for c in filled], "scanned": [scanned if c == filled[0] else 0 for c in filled]}
        yield pa.RecordBatch.from_arrays([pa.array(values.get(f.name, [None] * len(filled)), f.type) for f in STATE], schema=STATE)

    return table.mapInArrow(run, STATE_DDL)


def _totals(state, k, dims):
    """Exact component sums, counts and radii of the clusters, and the number of scanned rows, from the tasks' rows of sums."""
    parts = state.where("part >= 0")
    heads = {r["part"]: r for r in parts.groupBy("part").agg(F.sum("n").alias("n"), F.max("radius").alias("radius"), F.sum("scanned").alias("scanned")).collect()}
    sums = {(r["part"], r["pos"]): int(r["s"]) for r in parts.select("part", F.posexplode("sums").alias("pos", "x"))
            .groupBy("part", "pos").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("s")).collect()}
    counts = [heads[c]["n"] if c in heads else 0 for c in range(k)]
    radii = [heads[c]["radius"] if c in heads else 0.0 for c in range(k)]
    return [[sums.get((c, p), 0) for p in range(dims)] for c in range(k)], counts, radii, sum(r["scanned"] for r in heads.values())


def _forget(spark, path):
    """Remove a round's table once the next one is written, so that the disk holds two of them at most."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def fit(rows, k=8, rounds=10, seed=3, dims=64):
    """Centroids after ``rounds`` rounds over ``vec_id, v``, the table of last assignments, and for each pass how many rows were scanned.

    The table has ``vec_id, v, cluster, distance``. An empty input gives no centroid and None. With fewer than ``k`` rows there are as many centroids
    as rows. A centroid without members stays where it is.

    Each pass reads the state of the last one (vector, cluster, an upper and a lower bound) and writes the next; its tasks add one row of
    sums for each cluster, which Spark adds up. Only those sums (``k`` rows of ``dims`` numbers) and the centroids reach the driver. State tables lie in the
    shared folder, so a lost executor costs a re-read; one is removed when the one after the next is complete.
    """
    spark = rows.sparkSession
    centroids = first_centroids(rows, k, seed)
    if not centroids:
        return [], None, []
    k, state, drift, last, scans = len(centroids), rows, None, [], []
    for turn in range(rounds + 1):
        path = scratch_path(spark, "clusters")
        _round(state, centroids, dims, drift).write.parquet(path)
        state = spark.read.schema(STATE_DDL).parquet(path)
        if len(last) > 1:
            _forget(spark, last.pop(0))
        last.append(path)
        sums, counts, radii, scanned = _totals(state, k, dims)
        scans.append(scanned)
        state = state.where("part < 0").select("vec_id", "v", "cluster", "upper", "lower")
        if turn < rounds:
            new = [[s // n for s in row] if n else old for row, n, old in zip(sums, counts, centroids)]
            drift, centroids = moves(centroids, new, radii), new
    own = F.element_at(F.lit([[int(x) for x in c] for c in centroids]), F.col("cluster") + 1)
    distance = F.aggregate(F.zip_with("v", own, lambda x, c: (x.cast("bigint") - c) * (x.cast("bigint") - c)), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return centroids, state.select("vec_id", "v", "cluster", distance.alias("distance")), scans


def cluster(vectors, k=8, rounds=10, seed=3, dims=64, scale=1024, id_col="vec_id", vector_col="embedding"):
    """One row for each kept vector: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    Method: exact k-means over integers floor(scale * x). Every vector keeps an upper bound of the distance to its centroid and a lower bound
    of that to every other one. After centroids have moved, the lower bounds of a cluster are loosened by what the moves can do to a point of
    its sphere (``loosening``), which is never more than the longest move and often less than nothing. Vectors whose bounds still tell the
    centroids apart are not compared; ambiguous ones are scanned exactly. Assignments are those of a full comparison, ties to the smaller number.

    Which vectors are kept is said at ``scaled``. A NULL id is an id that is never chosen as a first centroid before others; repeated ids
    and rows stay and count each time. Equal first centroids are allowed: the later ones stay empty. An empty table, or one without a kept
    vector, gives no row. Sums beyond a long count as the largest long. Extra columns are left out.
    """
    spark = vectors.sparkSession
    centroids, state, _ = fit(scaled(vectors, dims, scale, id_col, vector_col), k, rounds, seed, dims)
    out = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not centroids:
        return spark.createDataFrame([], out)
    state = settle(state.select("vec_id", "cluster", "distance"), "clustered")
    sums = {r["cluster"]: int(r["s"]) for r in state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    longest = (1 << 63) - 1
    total = min(longest, sum(sums.values()))
    about = [(c, min(longest, sums.get(c, 0)), total, hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(centroids)]
    heads = spark.createDataFrame(about, "c int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # One row for each centroid: its size is ``k``.
    return state.join(F.broadcast(heads), F.col("cluster") == F.col("c")).drop("c")
