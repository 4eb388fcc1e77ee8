"""Connected components of a table of links, by rounds of hooking and pointer jumping.

Every step is an aggregate with partial sums or a lookup of a table with one row per node, so neither a node with very many
links nor a very large component is ever held in one task. Tables between steps are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultflow.session import stage


def _jump(parents: DataFrame) -> DataFrame:
    """(node, root) from (node, parent): each step doubles the distance that a node looks ahead."""
    while True:
        up = parents.select(F.col("node").alias("_n"), F.col("parent").alias("_p"))
        far = (parents.join(up, F.col("parent") == F.col("_n"), "left")
               .select("node", F.coalesce("_p", "parent").alias("parent"),
                       (F.col("_p") != F.col("parent")).alias("_moved")))
        parents = stage(far, "jump")
        if not parents.where("_moved").limit(1).count():
            return parents.drop("_moved")
        parents = parents.drop("_moved")


def components(links: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """(node, component) for every node that has a link; component is the smallest node that can be reached.

    Null ends and links of a node with itself are left out. An empty table gives an empty table. The number of rounds
    grows with the logarithm of the number of nodes: each round joins every component to a smaller neighbour if it has one.
    """
    edges = stage(links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
                  .where(f"`{left}` is not null and `{right}` is not null and u > v").distinct(), "links")
    known = None
    while edges.limit(1).count():
        hooks = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("parent"))
        roots = edges.select(F.col("v").alias("node")).distinct().join(hooks, "node", "left_anti")
        forest = _jump(stage(hooks.unionByName(roots.withColumn("parent", F.col("node"))), "forest"))
        seen = forest.select(F.col("node").alias("_n"), F.col("parent").alias("_r"))
        if known is None:
            known = forest
        else:
            known = stage(known.join(seen, F.col("parent") == F.col("_n"), "left")
                          .select("node", F.coalesce("_r", "parent").alias("parent")), "known")
        half = (edges.join(seen, F.col("u") == F.col("_n")).select(F.col("_r").alias("a"), "v"))
        both = (half.join(seen, F.col("v") == F.col("_n"))
                .select(F.greatest("a", "_r").alias("u"), F.least("a", "_r").alias("v")).where("u > v"))
        edges = stage(both.distinct(), "links")
    if known is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return known.select("node", F.col("parent").alias("component"))
