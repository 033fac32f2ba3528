"""Connected components of a graph given as edges, by contraction in rounds.

In a round every node points to its smallest neighbour, if that is smaller, and
then to where that one points; edges move to the nodes pointed to, and those that
became loops or repeats vanish. The smallest node of a component points to
itself throughout, so it names the component in the end. A hub's edges are combined
before they are shuffled, and joined in splits; each round's tables are written to
the shared folder. The driver learns only whether edges are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.tables import settle


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; `component` is the smallest node reachable."""
    left, right = F.col(a).alias("_a"), F.col(b).alias("_b")
    there = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    links = settle(there.select(left, right).union(there.select(right, left)).filter("_a <> _b").distinct(), "links")
    nodes = settle(there.select(F.explode(F.array(a, b)).alias("_node")).distinct().withColumn("_label", F.col("_node")),
                   "nodes")
    while not links.isEmpty():
        first = settle(links.groupBy("_a").agg(F.least(F.col("_a"), F.min("_b")).alias("_p")), "parents")
        second = first.select(F.col("_a").alias("_q"), F.col("_p").alias("_pp"))
        parents = settle(first.join(second, F.col("_p") == F.col("_q")).select("_a", "_pp"), "grandparents")
        to = parents.select(F.col("_a").alias("_from"), F.col("_pp").alias("_to"))
        nodes = settle(nodes.join(to, F.col("_label") == F.col("_from"), "left").select(
            "_node", F.coalesce("_to", "_label").alias("_label")), "nodes")
        half = links.join(to, F.col("_a") == F.col("_from")).select(F.col("_to").alias("_a"), "_b")
        whole = settle(half.distinct(), "half-links").join(to, F.col("_b") == F.col("_from")).select(
            "_a", F.col("_to").alias("_b"))
        links = settle(whole.filter("_a <> _b").distinct(), "links")
    return nodes.select(F.col("_node").alias("node"), F.col("_label").alias("component"))
