"""Prefix trie of conversations: ternary search trees for each range of turn sequences, joined at the nodes that ranges share."""

import hashlib
from math import ceil

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from ..operators.windows import RANGE_ROWS, rank_rows
from ..session import settle
from .common import bare, flushed, rows_of

#: Turns of a conversation that stand in one row; longer conversations go on in a trie one level below.
BLOCK = 256
#: Turn ids, about, of one range, which bounds the tree that a task holds.
RANGE_IDS = 400_000

NODES = ("kind int, range int, ref int, depth int, conv bigint, parent bigint, n bigint, children bigint, leaves bigint, saved bigint, "
         "size bigint, ends string, path array<bigint>")
_NODES = pa.schema([("kind", pa.int32()), ("range", pa.int32()), ("ref", pa.int32()), ("depth", pa.int32()), ("conv", pa.int64()), ("parent", pa.int64()),
                    ("n", pa.int64()), ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("size", pa.int64()),
                    ("ends", pa.string()), ("path", pa.list_(pa.int64()))])


def coded_turns(conversations, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text"):
    """``conv, pos, id, size``: turns by a dictionary of distinct (role, text), their place in the conversation from 1 on, and UTF-8 bytes of the text.

    Only a digest of role and text is moved, not the text. Ids follow the digests' order. Turns of one conversation that share their number
    stand by id, NULL numbers first. Rows without a conversation id are left out. A conversation of any length is numbered in ranges.
    """
    rows = bare(conversations, conv=conv_col, turn=turn_col, role=role_col, text=text_col).where("conv IS NOT NULL")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    slim = settle(rows.select(F.col("conv").cast("bigint").alias("conv"), "turn", F.unhex(F.sha2(whole, 256)).alias("digest"),
                              F.octet_length(text).cast("bigint").alias("size")), "turns")
    dictionary = settle(slim.select("digest").distinct().orderBy("digest").select("digest", F.monotonically_increasing_id().alias("id")), "dictionary")
    coded = slim.join(dictionary, "digest").select("conv", "turn", "id", "size")
    ranges = ceil(slim.count() / RANGE_ROWS) + 1
    return settle(rank_rows(coded, ["conv"], ["turn"], tiebreak=["id"], split=ranges, pos="row_number").drop("turn"), "coded")


def rebuilt(coded, every=5, heads=9):
    """``conv, pos, id, size`` of conversations that begin with the first h turns of conversation c - c % every and go on with their own
    turns after the first h, where h = crc32(decimal c) % heads; and ``conv, total``, their lengths, 0 included.

    A head is shared by ``every`` conversations, so no row is multiplied beyond that.
    """
    lengths = settle(coded.groupBy("conv").agg(F.max("pos").alias("own")), "lengths")
    h = F.crc32(F.col("conv").cast("string")) % heads
    base = lengths.select(F.col("conv").alias("base"), F.col("own").alias("base_own"))
    plan = lengths.select("*", h.alias("h"), (F.col("conv") - F.col("conv") % every).alias("base")).join(base, "base", "left")
    plan = settle(plan.select("conv", "base", "h", F.least("h", F.coalesce("base_own", F.lit(0))).alias("lead"), "own")
                  .select("*", (F.col("lead") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("total")), "plan")
    after = coded.join(plan.where("own > h").select("conv", "h", "lead"), "conv").where("pos > h")
    after = after.select("conv", (F.col("pos") - F.col("h") + F.col("lead")).alias("pos"), "id", "size")
    first = coded.where((F.col("pos") < heads) & (F.col("conv") % every == 0)).withColumnRenamed("conv", "base")
    head = first.join(plan.where("lead > 0").select("conv", "base", "lead"), "base").where("pos <= lead").select("conv", "pos", "id", "size")
    return head.union(after), plan.select("conv", "total")


def blocks_of(turns, totals, block):
    """``conv, level, ids, sizes, final``: turn sequences in rows of at most ``block`` turns; ``final`` marks a conversation's last row."""
    at = F.when(F.col("pos").isNotNull(), F.struct("pos", "id", "size"))
    ends = totals.select("conv", F.greatest(F.floor((F.col("total") - 1) / block), F.lit(0)).cast("int").alias("level"),
                         *[F.lit(None).cast("bigint").alias(c) for c in ("pos", "id", "size")], F.lit(True).alias("final"))
    rows = turns.select("conv", F.floor((F.col("pos") - 1) / block).cast("int").alias("level"), "pos", "id", "size", F.lit(False).alias("final"))
    got = rows.unionByName(ends).groupBy("conv", "level").agg(F.array_sort(F.collect_list(at)).alias("at"), F.max("final").alias("final"))
    return got.select("conv", "level", F.col("at.id").alias("ids"), F.col("at.size").alias("sizes"), "final")


class Trees:
    """Ternary search tree of the sequences of one range: smaller and larger siblings to both sides, the next turn below."""

    def __init__(self):
        self.key, self.small, self.below, self.large = [], [], [], []
        self.n, self.low, self.size, self.children, self.leaves, self.saved, self.ends = [], [], [], [], [], [], []
        self.top = -1

    def _node(self, key, low, size):
        for column, value in ((self.key, key), (self.small, -1), (self.below, -1), (self.large, -1), (self.n, 0), (self.low, low), (self.size, size),
                              (self.children, 0), (self.leaves, 0), (self.saved, 0), (self.ends, None)):
            column.append(value)
        return len(self.key) - 1

    def insert(self, symbols, sizes, n, low):
        """Nodes of one sequence from the top, with ``n`` members more in each."""
        path, up = [], -1
        for symbol, size in zip(symbols, sizes):
            at = self.top if up < 0 else self.below[up]
            last, side = -1, None
            while at >= 0 and self.key[at] != symbol:
                last, side = at, self.small if symbol < self.key[at] else self.large
                at = side[at]
            if at < 0:
                at = self._node(symbol, low, size)
                if last >= 0:
                    side[last] = at
                elif up < 0:
                    self.top = at
                else:
                    self.below[up] = at
            self.n[at] += n
            self.low[at] = min(self.low[at], low)
            path.append(at)
            up = at
        return path

    def walk(self):
        """(node, parent) with every node after its parent."""
        stack, out = [(self.top, -1)] if self.top >= 0 else [], []
        while stack:
            at, parent = stack.pop()
            out.append((at, parent))
            for side in (self.small, self.large):
                if side[at] >= 0:
                    stack.append((side[at], parent))
            if self.below[at] >= 0:
                stack.append((self.below[at], at))
        return out


def medians(n):
    """0 to n-1, the middle first and then the middles of both halves, so that a search tree filled in that order is balanced."""
    stack = [(0, n)] if n else []
    while stack:
        a, b = stack.pop()
        middle = (a + b) // 2
        yield middle
        if middle + 1 < b:
            stack.append((middle + 1, b))
        if a < middle:
            stack.append((a, middle))


def _sequences(batches):
    """Distinct sequences of sorted rows: symbols, sizes, members, smallest member, the ids that end there, what a lower level adds."""
    last, held = None, None
    for batch in batches:
        for stem, conv, ids, sizes, final, *carry in rows_of(batch, "stem", "conv", "ids", "sizes", "final", "c_children", "c_leaves", "c_saved"):
            key = (stem, *ids)
            if key != last:
                if held:
                    yield held
                last, held = key, [key, (0, *sizes), 0, conv, [], [0, 0, 0]]
            held[2] += 1
            if final:
                held[4].append(conv)
            held[5] = [a + (b or 0) for a, b in zip(held[5], carry)]
    if held:
        yield held


def _trie(stems_are_nodes):
    """Nodes of each range. ``kind`` 0: complete; 1: on the path of the range's first or last sequence, so perhaps in other ranges too, with
    the sums of what hangs below it in this range only, and the ends as text."""

    def run(batches):
        found = list(_sequences(batches))
        place, trees, edge = TaskContext.get().partitionId(), Trees(), {}
        for k in medians(len(found)):
            symbols, sizes, n, low, ends, carry = found[k]
            path = trees.insert(symbols, sizes, n, low)
            end = path[-1]
            trees.ends[end] = ",".join(map(str, ends))
            trees.children[end], trees.leaves[end], trees.saved[end] = (a + b for a, b in zip((trees.children[end], trees.leaves[end], trees.saved[end]), carry))
            if k in (0, len(found) - 1):
                for d, at in enumerate(path):
                    edge.setdefault(at, (len(edge), symbols[:d + 1]))
        del found
        order = trees.walk()
        depth, up = {}, dict(order)
        for at, parent in order:
            depth[at] = depth[parent] + 1 if parent >= 0 else 0
            if parent < 0 and stems_are_nodes:
                trees.low[at] = min(trees.low[at], trees.key[at])
        for at, parent in reversed(order):
            if at in edge:
                continue
            trees.leaves[at] = trees.leaves[at] or 1
            trees.saved[at] += (trees.n[at] - 1) * trees.size[at]
            if parent >= 0:
                trees.children[parent] += 1
                trees.leaves[parent] += trees.leaves[at]
                trees.saved[parent] += trees.saved[at]

        def rows():
            for at, parent in order:
                ends = trees.ends[at] or ""
                sums = trees.n[at], trees.children[at], trees.leaves[at], trees.saved[at], trees.size[at]
                if at in edge:
                    ref, path = edge[at]
                    yield (1, place, ref, depth[at], trees.low[at], None, *sums, ends, list(path))
                else:
                    known = parent >= 0 and parent not in edge
                    yield (0, place, edge[parent][0] if parent in edge else None, depth[at], trees.low[at], trees.low[parent] if known else None, *sums,
                           hashlib.sha256(ends.encode()).hexdigest(), [trees.key[at]] if parent < 0 else None)

        del up
        yield from flushed(rows(), _NODES)

    return run


def _digests(batches):
    """sha256 of the pieces of each path, which follow on each other; one piece is held at a time."""
    schema = pa.schema([("path", pa.list_(pa.int64())), ("digest", pa.string())])

    def rows():
        path, digest, any_yet = None, None, False
        for batch in batches:
            for key, piece in rows_of(batch, "path", "ends"):
                if key != path:
                    if path is not None:
                        yield path, digest.hexdigest()
                    path, digest, any_yet = key, hashlib.sha256(), False
                if piece:
                    digest.update((("," if any_yet else "") + piece).encode())
                    any_yet = True
        if path is not None:
            yield path, digest.hexdigest()

    yield from flushed(rows(), schema)


def _merge_edges(nodes, stems_are_nodes):
    """Nodes on the edges of ranges, one row each, and for each place of them in a range the smallest member.

    There are at most two paths of ``BLOCK`` nodes for each range. Totals below a node are sums over the edge nodes whose path begins with its path.
    """
    edges = nodes.where("kind = 1")
    merged = settle(edges.groupBy("path").agg(F.sum("n").alias("n"), F.min("conv").alias("conv"), F.max("size").alias("size"), F.max("depth").alias("depth"),
                                              *[F.sum(c).alias(c) for c in ("children", "leaves", "saved")]), "edges")
    up = F.slice("path", F.lit(1), F.size("path") - 1)
    kids = merged.where(F.size("path") > 1).select(up.alias("path")).groupBy("path").agg(F.count("*").alias("edge_children"))
    full = merged.join(kids, "path", "left").withColumn("children", F.col("children") + F.coalesce("edge_children", F.lit(0)))
    full = settle(full.select("path", "n", "conv", "size", "depth", "children", (F.col("leaves") + F.when(F.col("children") == 0, 1).otherwise(0)).alias("own_leaves"),
                              (F.col("saved") + (F.col("n") - 1) * F.col("size")).alias("own_saved")), "edges")
    below = (full.select(F.explode(F.sequence(F.lit(1), F.size("path"))).alias("k"), "path", "own_leaves", "own_saved")
             .groupBy(F.slice("path", F.lit(1), F.col("k")).alias("path")).agg(F.sum("own_leaves").alias("leaves"), F.sum("own_saved").alias("saved")))
    pieces = edges.select("path", "range", "ends")
    digests = pieces.repartition("path").sortWithinPartitions("path", "range").mapInArrow(_digests, "path array<bigint>, digest string")
    parents = full.select(F.col("path").alias("up"), F.col("conv").alias("parent"))
    done = settle(full.withColumn("up", up).join(below, "path").join(digests, "path").join(parents, "up", "left")
                  .select("path", "depth", "conv", "parent", "n", "children", "leaves", "saved", F.col("digest").alias("ends")), "edges")
    places = edges.select("range", "ref", "path").join(done.select("path", F.col("conv").alias("edge_conv")), "path").select("range", "ref", "edge_conv")
    return done, places


def _level(rows, stems_are_nodes):
    """Nodes of the tries under every stem: ``depth, conv, parent, n, children, leaves, saved, ends, stem``; depth 0 is the stem itself."""
    rows = settle(rows, "level")
    total = rows.agg(F.sum(F.size("ids") + 1)).collect()[0][0] or 0
    shards = ceil(total / RANGE_IDS) + 1
    nodes = settle(rows.repartitionByRange(shards, "stem", "ids", "conv").sortWithinPartitions("stem", "ids", "conv")
                   .mapInArrow(_trie(stems_are_nodes), NODES), "nodes")
    done, places = _merge_edges(nodes, stems_are_nodes)
    out = ["depth", "conv", "parent", "n", "children", "leaves", "saved", "ends"]
    inner = nodes.where("kind = 0")
    stem = F.when(F.col("depth") == 0, F.col("path")[0])
    hung = inner.where("ref IS NOT NULL").drop("parent").join(places, ["range", "ref"]).withColumnRenamed("edge_conv", "parent")
    return (inner.where("ref IS NULL").select(*out, stem.alias("stem")).union(hung.select(*out, F.lit(None).cast("bigint")))
            .union(done.select(*out, stem)))


def trie(turns, totals, block=BLOCK):
    """Nodes of the trie of turn sequences: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``turns`` are ``conv, pos, id, size``, ``totals`` are ``conv, total``. Conversations longer than ``block`` turns go on in a trie one level below, whose
    stems are the nodes at that depth; levels are built from the lowest up, so each adds its totals to the one above.
    """
    blocks = settle(blocks_of(turns, totals, block), "blocks")
    levels = [blocks.where("level = 0").withColumn("stem", F.lit(0).cast("bigint"))]
    deepest = blocks.agg(F.max("level")).collect()[0][0] or 0
    for k in range(deepest):
        full = levels[-1].where(F.size("ids") == block)
        stems = full.groupBy("stem", "ids").agg(F.min("conv").alias("next"))
        on = full.where(~F.col("final")).join(stems, ["stem", "ids"]).select("conv", F.col("next").alias("stem"))
        levels.append(settle(blocks.where(F.col("level") == k + 1).join(on, "conv"), "level"))
    carry, out = None, []
    for k in reversed(range(deepest + 1)):
        rows = levels[k].select("stem", "conv", "ids", "sizes", "final")
        if carry is None:
            rows = rows.select("*", *[F.lit(None).cast("bigint").alias(f"c_{c}") for c in ("children", "leaves", "saved")])
        else:
            rows = rows.join(carry, "conv", "left")
        nodes = settle(_level(rows, k > 0), "nodes")
        carry = nodes.where("depth = 0").select(F.col("stem").alias("conv"), *[F.col(c).alias(f"c_{c}") for c in ("children", "leaves", "saved")])
        out.append(nodes.where("depth > 0" if k else "true").withColumn("depth", F.col("depth") + k * block))
    union = out[0]
    for nodes in out[1:]:
        union = union.union(nodes)
    return union.select(F.col("conv").alias("conv_id"), F.col("depth").cast("bigint").alias("depth"), F.col("parent").alias("parent_conv_id"),
                        F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
                        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


def prefix_trie(conversations, every=5, heads=9, block=BLOCK, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text"):
    """The trie of rebuilt conversations (see ``rebuilt``), one row for each node (see ``trie``).

    Method: turns become ids of a dictionary of distinct (role, text). Sequences of ids, with the conversation last, are dealt by ranges, so a
    group of equal conversations may lie in many ranges. Each range fills a ternary search tree, middle sequence first, and walks it without
    recursion, adding members, leaves and savings upwards. Nodes on the path of a range's first or last sequence may lie in neighbouring ranges
    too: only those are merged, by path.

    NULL roles and texts count as empty, NULL turn numbers come first, turns with one number stand in the order of a digest of role and text; rows
    without a conversation id are left out, repeated rows are turns of their own. An empty table gives no node. Extra columns play no part.
    Ids that end at a node are hashed in order piece by piece, a piece for each range.
    """
    turns, totals = rebuilt(coded_turns(conversations, conv_col, turn_col, role_col, text_col), every, heads)
    return trie(turns, totals, block)
