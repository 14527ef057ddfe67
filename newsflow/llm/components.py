"""Connected components of a table of links, as joins and partial aggregates.

Each round hooks every node to its smallest neighbour, follows those pointers to
their roots and keeps only the links that still join two roots.  A star of any
size is closed by one round, since the smallest neighbour is a partial
aggregate; a long chain takes a logarithmic number of pointer steps.  Tables
are staged, so a lost executor costs its tasks alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import release, stage


def _to_roots(parent: DataFrame) -> DataFrame:
    """Pointers (node, root) followed until each leads to a root."""
    while True:
        up = parent.select(F.col("node").alias("root"), F.col("root").alias("up")).where("root <> up")
        moved = parent.join(up, "root")
        if moved.isEmpty():
            return parent
        after = stage(parent.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "roots")
        release(parent)
        parent = after


def components(links: DataFrame) -> DataFrame:
    """(row, root) of every node on a link (a, b); root is the smallest node reachable."""
    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .where("u <> v").distinct(), "edges")
    rounds: list[DataFrame] = []
    while not rounds or not edges.isEmpty():
        ends = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ends.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("near"))
        parent = _to_roots(stage(least.select("node", F.least("node", "near").alias("root")), "parents"))
        side = {s: parent.select(F.col("node").alias(s), F.col("root").alias(f"{s}_root")) for s in "uv"}
        ahead = (edges.join(side["u"], "u").join(side["v"], "v")
                 .select(F.greatest("u_root", "v_root").alias("u"), F.least("u_root", "v_root").alias("v"))
                 .where("u <> v").distinct())
        after = stage(ahead, "edges")
        release(edges)
        edges = after
        rounds.append(parent)
    root = rounds[0]
    for later in rounds[1:]:
        root = (root.join(later.select(F.col("node").alias("root"), F.col("root").alias("up")), "root", "left")
                .select("node", F.coalesce("up", "root").alias("root")))
    return root.select(F.col("node").alias("row"), "root")
