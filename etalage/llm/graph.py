"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etalage.session import write_through


def components(links: DataFrame) -> DataFrame:
    """node and root for every node of ``links`` (u, v); the nodes of a component have one root.

    Each round every node takes the smallest of itself and its neighbours as parent, and the links
    are carried over to the parents until none is left; then the parents are followed back. Nodes
    should be hashes, so that the number of rounds grows with the logarithm of the longest path.
    Minima are taken before the shuffle, and joins on a busy node can be split.
    """
    left = write_through(links.where("u <> v").distinct(), "links")
    parents = []
    while not left.isEmpty():
        both = left.unionAll(left.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parent = write_through(
            both.groupBy(F.col("u").alias("node"))
            .agg(F.min("v").alias("p"))
            .select("node", F.least("node", "p").alias("parent")),
            "parents",
        )
        parents.append(parent)
        at_u = parent.select(F.col("node").alias("u"), F.col("parent").alias("pu"))
        at_v = parent.select(F.col("node").alias("v"), F.col("parent").alias("pv"))
        carried = left.join(at_u, "u").join(at_v, "v").where("pu <> pv")
        left = write_through(
            carried.select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct(), "links"
        )
    if not parents:
        return left.select(F.col("u").alias("node"), F.col("v").alias("root"))
    found = parents[-1].select("node", F.col("parent").alias("root"))
    for parent in reversed(parents[:-1]):
        later = found.select(F.col("node").alias("parent"), "root")
        found = parent.join(later, "parent", "left").select("node", F.coalesce("root", "parent").alias("root"))
    return found
