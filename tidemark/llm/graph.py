"""Connected components as rounds of joins; every round's tables lie in the shared folder."""

from pyspark.sql import functions as F

from ..session import settle


def components(edges, a="a", b="b"):
    """``node, component`` for every node of ``edges``; the component is its smallest node. Nodes must not be NULL.

    Each round every node points to its smallest neighbour, pointers are followed to their ends, and
    the graph shrinks to one node for each end. A node that is not a local minimum disappears, so rounds grow with the
    logarithm of the longest chain. Nothing but counts reaches the driver. Hot nodes are pre-aggregated by ``min``
    and by ``distinct`` before each shuffle. An empty edge table gives an empty result.
    """
    ends = edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
    live = settle(ends.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    nodes = settle(ends.select("a").union(ends.select("b")).distinct().select(F.col("a").alias("node"), F.col("a").alias("component")), "nodes")
    while not live.isEmpty():
        both = live.union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = settle(both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("to")), "pointers")
        while True:
            end = to.select(F.col("a").alias("x"), F.col("to").alias("end"))
            to = settle(to.join(end, to["to"] == end["x"]).select("a", F.col("end").alias("to"), (F.col("to") != F.col("end")).alias("moved")),
                        "pointers")
            if to.where("moved").isEmpty():
                break
        to = to.select("a", "to")
        first, second = to.select(F.col("a").alias("a1"), F.col("to").alias("p")), to.select(F.col("a").alias("b1"), F.col("to").alias("q"))
        live = settle(live.join(first, live["a"] == first["a1"]).join(second, live["b"] == second["b1"]).where("p <> q")
                      .select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct(), "edges")
        nodes = settle(nodes.join(to, nodes["component"] == to["a"], "left")
                       .select("node", F.coalesce("to", "component").alias("component")), "nodes")
    return nodes
