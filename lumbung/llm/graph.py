"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.sources.staging import stage


def components(edges: DataFrame, a: str = "u", b: str = "v") -> DataFrame:
    """(node, label) for every node of an edge: the smallest node it is connected with.

    Each round gives a node the smallest label among its own and its neighbours', and then
    that label's label, so that stars close in a round and chains shrink fast. Every round
    is written to a table, which cuts lineage; nothing is collected but whether a label moved.
    """
    u, v = F.col(a), F.col(b)
    ways = F.array(F.struct(u.alias("node"), v.alias("other")), F.struct(v.alias("node"), u.alias("other")),
                   F.struct(u.alias("node"), u.alias("other")), F.struct(v.alias("node"), v.alias("other")))
    both = stage(edges.select(F.inline(ways)).distinct(), "edges")
    labels = both.filter("node = other").select("node", F.col("node").alias("label"))
    while True:
        seen = both.join(labels.select(F.col("node").alias("other"), "label"), "other")
        own = F.max(F.when(F.col("node") == F.col("other"), F.col("label")))
        near = stage(seen.groupBy("node").agg(F.min("label").alias("label"), (F.min("label") < own).alias("moved")), "labels")
        if not near.filter("moved").limit(1).count():
            return near.select("node", "label")
        further = near.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = stage(near.join(further, "label").select("node", F.col("next").alias("label")), "labels")
