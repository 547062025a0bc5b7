"""Connected components of a table of links, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.llm.storage import saved


def components(links: DataFrame) -> DataFrame:
    """(node, component): for each node of the links (a, b) the smallest node that it reaches.

    Each round joins every node to the smallest root among its neighbours' and follows the roots' roots. A round
    shortens every chain of roots, so few are needed; the state is written to the shared folder after each.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = saved(both)
    state = saved(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root")))
    while True:
        roots = state.select(F.col("node").alias("b"), F.col("root").alias("neighbour"))
        least = both.join(roots, "b").groupBy("a").agg(F.min("neighbour").alias("least"))
        seen = state.join(least, state["node"] == least["a"]).select("node", "root", F.least("root", "least").alias("next"))
        # a root that one of its nodes sees beyond moves too
        moved = seen.groupBy("root").agg(F.min("next").alias("to")).withColumnRenamed("root", "of")
        seen = seen.join(moved, seen["root"] == moved["of"]).select("node", "root", F.least("next", "to").alias("next"))
        hop = seen.select(F.col("node").alias("via"), F.col("next").alias("beyond"))
        new = seen.join(hop, seen["next"] == hop["via"], "left").select("node", "root", F.coalesce("beyond", "next").alias("next"))
        new = saved(new.select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("changed")))
        if new.where("changed").isEmpty():
            return new.select("node", F.col("root").alias("component"))
        state = new.drop("changed")
