"""Embedding near-duplicates over an inverted multi-index: two codebooks on vector halves, a product grid of cells."""

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import functions as F

from ..session import settle
from .common import bare, flushed
from .graph import components

MIN_COSINE = 0.93
#: Share of the hardest planted neighbours, and of the links of drawn queries, that the traversal must reach.
TARGET_RECALL = 0.999
#: Most vectors that codebooks are fitted on and neighbours are planted for, and queries compared with all rows; in hash order. Every vector is indexed.
SAMPLE, QUERIES = 20_000, 256
#: Cells of the grid for each root of the number of vectors, and vectors of one side in one comparison of a large cell.
CELLS, BLOCK = 2, 1024


def unit(vectors):
    x = np.asarray(vectors, np.float64)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def squared(x, centres):
    """Squared distances of rows to centres; each row's figures do not depend on the rows beside it."""
    out = np.empty((len(x), len(centres)))
    for at in range(0, len(x), 64):
        out[at:at + 64] = ((x[at:at + 64, None, :] - centres[None]) ** 2).sum(axis=-1)
    return out


def kmeans(x, k, rounds=12, seed=42):
    """Centres of Lloyd's algorithm from a seeded draw; a centre without points stays where it is."""
    centres = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        own = (((x * x).sum(1)[:, None] - 2 * x @ centres.T) + (centres * centres).sum(1)).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        counts = np.bincount(own, minlength=len(centres))
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


class Index:
    """Codebooks of one dimension, distances of vectors to the grid's rows and columns, and the excess up to which cells are visited."""

    def __init__(self, sample, cells):
        self.half, self.excess = sample.shape[1] // 2, 0.0
        k = max(1, min(len(sample) // 8, math.ceil(math.sqrt(cells))))
        self.books = [kmeans(sample[:, :self.half], k), kmeans(sample[:, self.half:], k)]

    @property
    def cells(self):
        return len(self.books[0]) * len(self.books[1])

    def distances(self, x):
        return squared(x[:, :self.half], self.books[0]), squared(x[:, self.half:], self.books[1])

    def cell(self, first, second):
        """Row and column of the nearest cell, and the distance to it."""
        i, j = first.argmin(axis=1), second.argmin(axis=1)
        rows = np.arange(len(first))
        return i, j, first[rows, i] + second[rows, j]

    def needs(self, first, second, others, q, m):
        """Excess at which the pairs (q, m) of rows with distances ``first, second`` and ``others`` are met from the better of their two ends."""
        mine, theirs = self.cell(first, second), self.cell(*others)
        there = first[q, theirs[0][m]] + second[q, theirs[1][m]] - mine[2][q]
        back = others[0][m, mine[0][q]] + others[1][m, mine[1][q]] - theirs[2][m]
        return np.minimum(there, back)

    def visited(self, first, second):
        """Cells (row, column) that one vector visits, nearest first."""
        return traverse(first, second, self.excess)


def traverse(first, second, excess):
    """Cells (row, column) of one vector from the nearest outwards, until the distance exceeds the nearest one's by ``excess``.

    The multi-sequence walk: a heap holds the border of the region that was visited in the two sorted lists.
    """
    rows, columns = first.argsort(kind="stable"), second.argsort(kind="stable")
    limit = first[rows[0]] + second[columns[0]] + excess
    heap, out = [(first[rows[0]] + second[columns[0]], 0, 0)], []
    while heap and heap[0][0] <= limit:
        _, a, b = heapq.heappop(heap)
        out.append((int(rows[a]), int(columns[b])))
        if b + 1 < len(columns):
            heapq.heappush(heap, (first[rows[a]] + second[columns[b + 1]], a, b + 1))
        if b == 0 and a + 1 < len(rows):
            heapq.heappush(heap, (first[rows[a + 1]] + second[columns[0]], a + 1, 0))
    return out


def _matrix(column):
    """List column of equally long vectors as a matrix in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _sample(reps, sample):
    """Unit vectors of each dimension that occurs, from a bounded sample."""
    column = reps.orderBy(F.xxhash64("key"), "key").limit(sample).select("embedding").toArrow().column("embedding").combine_chunks()
    sizes = np.array(pa.compute.list_value_length(column))
    return {int(d): unit(_matrix(column.filter(pa.array(sizes == d)))) for d in np.unique(sizes)}


def planted(index, x, min_cosine, seed=42):
    """Pairs of (matrix, matrix): the sample, and a neighbour of each of its vectors at the hardest cosines, from ``min_cosine`` up to a seventh of the way to 1.

    Neighbours lie in two kinds of direction: the residual of another vector of the same cell, which is how vectors of the
    table differ, and a drawn one.
    """
    draw = np.random.default_rng(seed)
    i, j, _ = index.cell(*index.distances(x))
    residual = x - np.concatenate([index.books[0][i], index.books[1][j]], axis=1)
    order = np.lexsort((draw.random(len(x)), j, i))
    other = np.empty_like(x)
    other[order] = np.roll(residual[order], 1, axis=0)
    for side in (other, draw.normal(size=x.shape)):
        side = side - (side * x).sum(axis=1, keepdims=True) * x
        length = np.sqrt((side * side).sum(axis=1))
        there = length > 1e-9
        cosine = draw.uniform(min_cosine, min_cosine + (1 - min_cosine) / 7, len(x))[there, None]
        yield x[there], cosine * x[there] + np.sqrt(1 - cosine * cosine) * side[there] / length[there, None]


def fit(reps, sample=SAMPLE, min_cosine=MIN_COSINE, target=TARGET_RECALL):
    """``dimension -> Index`` from a bounded sample, each with the excess at which ``target`` of its planted neighbours are met."""
    indexes, cells = {}, CELLS * math.sqrt(reps.count())
    for d, x in _sample(reps, sample).items():
        index = indexes[d] = Index(x, cells)
        for own, near in planted(index, x, min_cosine):
            if len(own):
                rows = np.arange(len(own))
                needs = index.needs(*index.distances(own), index.distances(near), rows, rows)
                index.excess = max(index.excess, float(np.quantile(needs, target, method="higher")))
    return indexes


def _index(indexes, d):
    """The index of a dimension; one that the sample missed has a single cell, so it is searched in full."""
    return indexes[d] if d in indexes else indexes.setdefault(d, Index(np.zeros((1, d)), 1))


def measured(reps, indexes, min_cosine=MIN_COSINE, queries=QUERIES, seed=1):
    """``query -> (links, links that the traversal meets, excess that would meet all)`` of drawn queries, by brute force over all rows.

    Queries are at most ``queries`` rows in hash order; each task compares them with its own rows and keeps one row for each query.
    """
    chosen = reps.orderBy(F.xxhash64("key", F.lit(seed)), "key").select("key", F.xxhash64("key").alias("code"), "label", "embedding").limit(queries).collect()
    asked = {}
    for d in sorted({len(r["embedding"]) for r in chosen}):
        own = np.array([n for n, r in enumerate(chosen) if len(r["embedding"]) == d])
        x = unit([chosen[n]["embedding"] for n in own])
        asked[d] = own, np.array([chosen[n]["label"] for n in own]), np.array([chosen[n]["code"] for n in own]), x, *_index(indexes, d).distances(x)
    schema = pa.schema([("query", pa.int32()), ("links", pa.int64()), ("met", pa.int64()), ("need", pa.float64())])

    def run(batches):
        links, met, need = np.zeros(len(chosen), int), np.zeros(len(chosen), int), np.zeros(len(chosen))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                column = part.schema.get_field_index
                dims = np.array(pa.compute.list_value_length(part.column(column("embedding"))))
                for d in {int(d) for d in np.unique(dims)} & set(asked):
                    number, labels, codes, x, first, second = asked[d]
                    index, picked = _index(indexes, d), part.filter(pa.array(dims == d))
                    y = unit(_matrix(picked.column(column("embedding"))))
                    q, m = (x @ y.T >= min_cosine).nonzero()
                    linked = (labels[q] == picked.column(column("label")).to_numpy()[m]) & (codes[q] != picked.column(column("code")).to_numpy()[m])
                    q, m = q[linked], m[linked]
                    if len(q):
                        needs = index.needs(first, second, index.distances(y), q, m)
                        np.add.at(links, number[q], 1)
                        np.add.at(met, number[q], needs <= index.excess)
                        np.maximum.at(need, number[q], needs)
        yield from flushed([(int(n), int(links[n]), int(met[n]), float(need[n])) for n in links.nonzero()[0]], schema)

    found = reps.select(F.xxhash64("key").alias("code"), "label", "embedding").mapInArrow(run, "query int, links bigint, met bigint, need double")
    rows = found.groupBy("query").agg(F.sum("links").alias("links"), F.sum("met").alias("met"), F.max("need").alias("need")).collect()
    return {(len(chosen[r["query"]]["embedding"]), chosen[r["query"]]["key"]): (r["links"], r["met"], r["need"]) for r in rows}


def _widen(indexes, found, target):
    """Make every index as wide as ``target`` of the queries with links need to meet all of theirs, if that is wider than planted neighbours need."""
    for d in indexes:
        needs = [need for (dim, _), (_, _, need) in found.items() if dim == d]
        if needs:
            indexes[d].excess = max(indexes[d].excess, float(np.quantile(needs, target, method="higher")))


def _lists(x):
    """A matrix as a list column."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.int32()), pa.array(x.ravel()))


def _visits(reps, indexes):
    """Each vector once in the cell it is stored in and once in each cell it visits."""
    schema = pa.schema([("key", pa.string()), ("label", pa.int64()), ("embedding", pa.list_(pa.float64())), ("weight", pa.int64()),
                        ("dim", pa.int32()), ("row", pa.int32()), ("col", pa.int32()), ("stored", pa.bool_()), ("own_row", pa.int32()), ("own_col", pa.int32())])

    def placed(part, d):
        index, column = _index(indexes, d), part.schema.get_field_index
        x = unit(_matrix(part.column(column("embedding"))))
        first, second = index.distances(x)
        home = index.cell(first, second)
        cells = [[(int(home[0][n]), int(home[1][n])), *index.visited(first[n], second[n])] for n in range(len(x))]
        take = np.repeat(np.arange(len(x)), [len(c) for c in cells])
        stored = np.append(True, take[1:] != take[:-1])
        place = np.array([c for own in cells for c in own], np.int32)
        for at in range(0, len(take), 4096):
            own, picked = slice(at, at + 4096), pa.array(take[at:at + 4096])
            yield pa.RecordBatch.from_arrays([
                part.column(column("key")).take(picked), part.column(column("label")).take(picked), _lists(x[take[own]]),
                part.column(column("weight")).take(picked), pa.array(np.full(len(picked), d, np.int32)), pa.array(place[own, 0].copy()), pa.array(place[own, 1].copy()),
                pa.array(stored[own]), pa.array(home[0][take[own]].astype(np.int32)), pa.array(home[1][take[own]].astype(np.int32))], schema=schema)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                dims = np.array(pa.compute.list_value_length(part.column(part.schema.get_field_index("embedding"))))
                for d in np.unique(dims):
                    yield from placed(part.filter(pa.array(dims == d)), int(d))

    return reps.select("key", "label", "embedding", "weight").mapInArrow(
        run, "key string, label bigint, embedding array<double>, weight bigint, dim int, row int, col int, stored boolean, own_row int, own_col int")


def _compare(indexes, min_cosine):
    """Comparison of one block of stored vectors with one block of visitors: links of each vector, and its root in the block."""
    schema = pa.schema([("key", pa.string()), ("links", pa.int64()), ("root", pa.string())])

    def run(table):
        stored = np.array(table["stored"].to_pylist(), bool)
        keys, weights = np.array(table["key"].to_pylist(), object), table["weight"].to_numpy()
        x, d = _matrix(table["embedding"]), table["dim"][0].as_py()
        q, m = (~stored).nonzero()[0], stored.nonzero()[0]
        if not len(q) or not len(m):
            return schema.empty_table()
        a, b = (x[q] @ x[m].T >= min_cosine).nonzero()
        other = keys[q[a]] != keys[m[b]]
        a, b = a[other], b[other]
        if not len(a):
            return schema.empty_table()
        # the same pair turns up in the visitor's own cell if the stored vector comes by there: count it at one place
        index = _index(indexes, d)
        first, second = index.distances(x[m])
        i, j = table["own_row"].to_numpy()[q], table["own_col"].to_numpy()[q]
        twice = first[b, i[a]] + second[b, j[a]] <= first.min(axis=1)[b] + second.min(axis=1)[b] + index.excess
        counted = ~twice | (keys[q][a] < keys[m][b])
        links = np.zeros(len(keys), np.int64)
        np.add.at(links, q[a[counted]], weights[m[b[counted]]])
        np.add.at(links, m[b[counted]], weights[q[a[counted]]])
        names, place = np.unique(keys.astype(str), return_inverse=True)
        root, ends = np.arange(len(names)), (place[q[a]], place[m[b]])
        while True:
            least = root.copy()
            np.minimum.at(least, ends[0], root[ends[1]])
            np.minimum.at(least, ends[1], root[ends[0]])
            least = least[least]
            if (least == root).all():
                break
            root = least
        total = np.bincount(place, weights=links, minlength=len(names)).astype(np.int64)
        touched = np.unique(np.concatenate(ends))
        return pa.table([pa.array(names[touched].tolist(), pa.string()), pa.array(total[touched]), pa.array(names[root[touched]].tolist(), pa.string())], schema=schema)

    return run


def links(reps, min_cosine=MIN_COSINE, target_recall=TARGET_RECALL, sample=SAMPLE, queries=QUERIES):
    """``key, links, root`` rows: links counted in a block, and a neighbour towards which the block's links lead.

    Every vector walks the cells in multi-sequence order as far as neighbours planted at the hardest cosines ask, and farther if
    the links of drawn queries need it. Cells with many vectors are compared block against block, so no task holds more than two blocks.
    """
    indexes = fit(reps, sample, min_cosine, target_recall)
    _widen(indexes, measured(reps, indexes, min_cosine, queries), target_recall)
    placed = settle(_visits(reps, indexes), "visits")
    cell = ["label", "dim", "row", "col"]
    sizes = settle(placed.groupBy(*cell).agg(*[F.ceil(F.count_if(side) / BLOCK).cast("int").alias(name) for name, side in (
        ("stored_blocks", F.col("stored")), ("visit_blocks", ~F.col("stored")))]), "cells")  # so that a hot cell can be split
    mine = F.pmod(F.xxhash64("key"), F.when(F.col("stored"), F.col("stored_blocks")).otherwise(F.col("visit_blocks"))).cast("int")
    every = F.sequence(F.lit(0), F.when(F.col("stored"), F.col("visit_blocks")).otherwise(F.col("stored_blocks")) - 1)
    dealt = placed.join(sizes.where("stored_blocks > 0 and visit_blocks > 0"), cell).withColumn("other", F.explode(every)).withColumn(
        "of_stored", F.when(F.col("stored"), mine).otherwise(F.col("other"))).withColumn(
        "of_visits", F.when(F.col("stored"), F.col("other")).otherwise(mine))
    return dealt.groupBy(*cell, "of_stored", "of_visits").applyInArrow(
        _compare(indexes, min_cosine), "key string, links bigint, root string")


def near_duplicates(vectors, min_cosine=MIN_COSINE, target_recall=TARGET_RECALL, sample=SAMPLE, queries=QUERIES,
                    id_col="vec_id", vector_col="embedding", label_col="label"):
    """``vec_id, n_links, component_id, kept`` for every row.

    Only vectors of one label and length are compared. A vector that is NULL, empty or zero, that holds a NULL or a
    non-finite component, or that has no label links with nothing: no links, its own component. Equal vectors of a label
    are indexed once and count as often as they occur. Links are verified by the cosine in double precision;
    candidates come from the cells that the traversal visits. A NULL id stays, with its component's smallest id, and is
    never kept; rows of one id are counted each. Extra columns are left out; an empty table gives an empty table.
    """
    named = bare(vectors, vec_id=id_col, embedding=vector_col, label=label_col).withColumn("label", F.col("label").cast("bigint"))
    fit = F.col("label").isNotNull() & (F.size("embedding") > 0) & F.exists("embedding", lambda v: v != 0) & F.forall(
        "embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    key = F.when(F.coalesce(fit, F.lit(False)), F.sha2(F.concat(F.col("label").cast("string"), F.lit("|"), F.col("embedding").cast("string")), 256))
    keyed = settle(named.withColumn("key", key), "vectors")
    counts = keyed.where("key is not null").groupBy("key").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"))
    reps = settle(keyed.where("key is not null").dropDuplicates(["key"]).select("key", "label", "embedding").join(counts, "key"), "distinct")
    found = settle(links(reps, min_cosine, target_recall, sample, queries), "links")
    groups = components(found.select("key", "root"), "key", "root")
    # both sides are written before they meet, so that a hot component can be split
    ranked = settle(reps.select("key", "weight", "least").join(groups.withColumnRenamed("node", "key"), "key", "left").join(
        found.groupBy("key").agg(F.sum("links").alias("links")), "key", "left").withColumn("component", F.coalesce("component", "key")), "ranked")
    smallest = settle(ranked.groupBy("component").agg(F.min("least").alias("component_id")), "smallest")
    judged = ranked.join(smallest, "component").select("key", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    out = keyed.select("vec_id", "key").join(judged, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
