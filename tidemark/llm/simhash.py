"""SimHash near-duplicates by generalised pigeonhole search over groups of correlated bits."""

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import settle
from .common import bare, flushed, row_key, rows_of, unused
from .graph import components

#: Words of a shingle, and the most bits in which linked fingerprints differ.
SHINGLE, MAX_BITS = 3, 2
#: Fingerprints of a bucket that are compared in pairs; larger buckets meet over common neighbours instead.
PAIRED_BUCKET = 64

#: Fixed value: A-Z to a-z; every other byte stays.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Fixed value: the separators of words, as bytes; no byte of a longer UTF-8 sequence is among them.
_SPACES = b"\t\n\x0b\x0c\r"
_TO_SPACE = bytes(32 if b in _SPACES else b for b in range(256))


def fingerprint(text, size=SHINGLE):
    """Unsigned 64-bit fingerprint of a text: bits set in over half of its shingles' hashes; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).translate(_TO_SPACE).split(b" ") if text else []
    words = [w for w in words if w]
    if not words:
        return 0
    joined, lengths = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    past = np.cumsum(lengths + 1) - 1
    starts = (past - lengths).tolist()
    n = max(1, len(words) - size + 1)
    past = past[min(size, len(words)) - 1:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[at:at + (1 << 15)], past[at:at + (1 << 15)])), "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs, size=SHINGLE, id_col="doc_id", text_col="text"):
    """``doc_id, fp, row_key`` of every whole text; ``fp`` is the fingerprint's bits as a signed long."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("row_key", pa.binary())])

    def run(batches):
        for batch in batches:
            yield from flushed(((i, _signed(fingerprint(t, size)), k) for i, t, k in rows_of(batch, "doc_id", "text", "row_key")), schema)

    keyed = bare(docs, doc_id=id_col, text=text_col).withColumn("row_key", row_key(F.col("doc_id"), F.col("text")))
    return keyed.mapInArrow(run, "doc_id bigint, fp bigint, row_key binary")


def bit_counts(fps):
    """Number of fingerprints, and the 64 x 64 numbers of those that have both bits set; one small row for each task."""
    schema = pa.schema([("n", pa.int64()), ("both", pa.list_(pa.int64()))])

    def run(batches):
        n, both = 0, np.zeros((64, 64), np.int64)
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            for at in range(0, len(values), 4096):
                bits = np.unpackbits(values[at:at + 4096].copy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
                both += (bits.T @ bits).astype(np.int64)
            n += len(values)
        yield from flushed([(n, both.ravel().tolist())], schema)

    counts = fps.select("fp").mapInArrow(run, "n bigint, both array<bigint>")
    rows = counts.select(F.posexplode(F.concat("both", F.array("n"))).alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(64 * 64 + 1)
    for r in rows:
        flat[r["at"]] = r["v"] or 0
    return int(flat[-1]), flat[:-1].reshape(64, 64)


def group_bits(n, both, parts):
    """Bits in ``parts`` groups, correlated bits together, so that the groups are as independent as may be."""
    p = both.diagonal() / max(n, 1)
    spread = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
    strength = np.divide(np.abs(both / max(n, 1) - np.outer(p, p)), spread, out=np.zeros((64, 64)), where=spread > 0)
    left, groups = set(range(64)), []
    for k in range(parts):
        want = len(left) // (parts - k)
        group = [max(left, key=lambda b: (strength[b, list(left)].sum(), -b))]
        left.discard(group[0])
        while len(group) < want:
            best = max(left, key=lambda b: (strength[b, group].sum(), -b))
            group.append(best)
            left.discard(best)
        groups.append(sorted(group))
    return groups


def allocate(cost, budget):
    """Thresholds, one for each group, -1 for a group that is not probed, of least total cost.

    If groups' thresholds plus one add up to ``budget`` = most differing bits + 1, two fingerprints that link lie within
    the threshold in at least one group. ``cost[i][t]`` estimates the candidates of group i at threshold t. Dynamic
    programming over groups and the budget left.
    """
    best = {0: (0.0, [])}
    for own in cost:
        following = {}
        for used, (total, chosen) in best.items():
            for t in range(-1, budget - used):
                option = (total + (own[t] if t >= 0 else 0.0), [*chosen, t])
                if used + t + 1 not in following or option < following[used + t + 1]:
                    following[used + t + 1] = option
        best = following
    return best[budget][1]


def _within(differ, most):
    """Probability that at most 0, 1, ... ``most`` of independent bits differ."""
    chance = np.zeros(most + 1)
    chance[0] = 1.0
    for q in differ:
        chance[1:] = chance[1:] * (1 - q) + chance[:-1] * q
        chance[0] *= 1 - q
    return np.cumsum(chance)


def plan(fps, max_bits=MAX_BITS, parts=None):
    """Bit groups and thresholds for ``fps``: pair counts of equal group values are measured over all fingerprints; wider
    thresholds are estimated from them and the bits' own frequencies."""
    n, both = bit_counts(fps)
    groups = group_bits(n, both, parts or max_bits + 1)
    p = both.diagonal() / max(n, 1)
    sums = []
    for group in groups:
        counts = fps.groupBy(_masked(group).alias("v")).count()
        sums.append(counts.agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2).alias("pairs")))
    cost = []
    for group, pairs in zip(groups, sums):
        equal = pairs.first()["pairs"] or 0.0
        within = _within(2 * p[group] * (1 - p[group]), max_bits)
        rows = [len(list(itertools.combinations(group, t))) * n for t in range(max_bits + 1)]
        cost.append([rows[t] + equal * within[t] / max(within[0], 1e-300) for t in range(max_bits + 1)])
    return groups, allocate(cost, max_bits + 1)


def _signed(value):
    return value - (1 << 64) if value >> 63 else value


def _masked(bits):
    return F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in bits))))


def probes(fps, groups, thresholds):
    """``probe, value, fp``: fingerprints that lie within a group's threshold there share a value, namely
    the group's bits without some threshold bits."""
    keys, k = [], 0
    for group, t in zip(groups, thresholds):
        for left_out in itertools.combinations(group, t) if t >= 0 else ():
            keys.append(F.struct(F.lit(k).alias("probe"), _masked(set(group) - set(left_out)).alias("value")))
            k += 1
    return fps.select(F.explode(F.array(*keys)).alias("k"), "fp").select("k.probe", "k.value", "fp")


def _neighbours(max_bits):
    """Column of all values within half of ``max_bits`` of ``fp``."""
    flips = [_signed(sum(1 << b for b in c)) for r in range(max_bits // 2 + 1) for c in itertools.combinations(range(64), r)]
    return F.transform(F.array(*[F.lit(x) for x in flips]), lambda x: F.col("fp").bitwiseXOR(x))


def links(fps, max_bits=MAX_BITS, parts=None):
    """``a, b``: links between distinct fingerprints that connect exactly what pairs within ``max_bits`` bits connect.

    Candidates share a probe value. In buckets of up to ``PAIRED_BUCKET`` fingerprints each pair is verified by its
    differing bits. Members of larger buckets are listed under every value within half the distance: two fingerprints
    are within the distance exactly if they share such a value, and no value can have more members than it has
    neighbours, so a hot bucket costs a constant number of rows for each of its members. One
    member of a value stands for it, so links form stars.
    """
    if max_bits % 2:
        raise ValueError("max_bits must be even")
    probed = settle(probes(fps, *plan(fps, max_bits, parts)), "probes")
    sizes = settle(probed.groupBy("probe", "value").agg(F.count("*").alias("size")).where("size > 1"), "sizes")  # so that a hot value can be split
    crowded = settle(probed.join(sizes, ["probe", "value"]), "buckets")
    small = crowded.where(F.col("size") <= PAIRED_BUCKET).select("probe", "value", "fp")
    other = small.withColumnRenamed("fp", "b")
    pairs = small.withColumnRenamed("fp", "a").join(other, ["probe", "value"]).where(
        (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)).select("a", "b")
    dense = crowded.where(F.col("size") > PAIRED_BUCKET).select("fp").distinct()
    met = dense.select(F.explode(_neighbours(max_bits)).alias("at"), "fp").groupBy("at").agg(F.collect_list("fp").alias("members"))
    stars = met.where(F.size("members") > 1).select(F.array_min("members").alias("a"), F.explode("members").alias("b")).where("a <> b")
    return pairs.union(stars)


def groups_of(marked, max_bits=MAX_BITS, parts=None):
    """``fp, component``: distinct fingerprints with the smallest fingerprint that links reach."""
    distinct = settle(marked.select("fp").distinct(), "distinct")
    found = components(links(distinct, max_bits, parts))
    return distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs, size=SHINGLE, max_bits=MAX_BITS, parts=None, id_col="doc_id", text_col="text"):
    """``doc_id, fingerprint, component_id`` for every row.

    ``fingerprint`` has 16 lower-case hex digits; ``component_id`` is the smallest id that links of ``max_bits`` bits or
    fewer reach. Copies share a fingerprint and count once in the search. NULL, empty and blank texts have
    fingerprint zero and link like any other; a text of fewer words than ``size`` is one shingle. A row with a NULL id
    stays and gets its component's smallest id, NULL if there is none. Repeated rows stay. Extra columns are
    left out; an empty table gives an empty table.
    """
    marked = settle(fingerprints(docs, size, id_col, text_col), "fingerprints")
    found = groups_of(marked, max_bits, parts)
    firsts = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    smallest = found.join(firsts, "fp").groupBy("component").agg(F.min("first").alias("component_id"))
    named = found.join(smallest, "component").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs, size=SHINGLE, max_bits=MAX_BITS, parts=None, id_col="doc_id", text_col="text"):
    """The rows of ``docs`` without near duplicates: of each component the row with the smallest id stays, all columns as they were.

    Rows of one id are told apart by their text; a row repeated with id and text stays once. A NULL id counts
    as the largest.
    """
    marked = settle(fingerprints(docs, size, id_col, text_col), "fingerprints")
    found = groups_of(marked, max_bits, parts)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")
    firsts = marked.groupBy("fp").agg(F.min(order).alias("least"))
    own = unused(docs.columns, "__row")
    kept = found.join(firsts, "fp").groupBy("component").agg(F.min("least").alias("least")).select(F.col("least.row_key").alias(own))
    keyed = docs.withColumn(own, row_key(docs[f"`{id_col}`"], docs[f"`{text_col}`"]))
    once = keyed.join(kept, own, "left_semi").withColumn(f"{own}_n", F.row_number().over(Window.partitionBy(own).orderBy(F.lit(0))))
    return once.where(F.col(f"{own}_n") == 1).select(*[f"`{c}`" for c in docs.columns])
