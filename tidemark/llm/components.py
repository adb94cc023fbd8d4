"""Connected components of an edge table by hooking and pointer jumping (FastSV), all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, materialise

SMALL = 100_000  # rows of a table of three numbers that may be broadcast


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label) for every node of an edge; label is the smallest node of its component.

    Every node has a parent in its component, itself at most, and top, the parent's parent. A round takes the smallest top among a
    node's neighbours and hangs the node and its parent on it: so whole trees move at once, and not only the nodes at their edge. It
    ends when no top changes, for then a node's top is at most that of any neighbour, so they are all equal and the smallest node's.
    Nulls and loops join nothing. An empty table gives an empty one.
    """
    real = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
    both = materialise(real.union(real.select("v", "u")).distinct(), "edges")
    parents = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("parent"))
    labels = materialise(parents.withColumn("top", F.col("parent")), "labels")
    few = labels.count() <= SMALL
    unknown = F.lit(None).cast(labels.schema["node"].dataType)
    while True:
        known = F.broadcast(labels) if few else labels
        near = both.join(known, both["v"] == labels["node"]).groupBy("u").agg(F.min("top").alias("near"))
        near = near.join(known, near["u"] == labels["node"])
        hung = F.array(F.struct(F.col("parent").alias("node"), F.col("near").alias("to"), unknown.alias("was")), F.struct("node", F.least("near", "top").alias("to"), F.col("top").alias("was")))
        hooked = near.select(F.explode(hung).alias("hung")).select("hung.*").groupBy("node").agg(F.min("to").alias("parent"), F.max("was").alias("was"))
        hooked = materialise(hooked, "labels")
        above = hooked.select(F.col("node").alias("hop"), F.col("parent").alias("top"))
        stepped = hooked.join(F.broadcast(above) if few else above, hooked["parent"] == above["hop"]).select("node", "parent", "top", (F.col("top") != F.col("was")).alias("moved"))
        after = materialise(stepped, "labels")
        changed = after.where("moved").limit(1).count()
        discard(labels, hooked)
        labels = after.select("node", "parent", "top")
        if not changed:
            discard(both)
            return labels.select("node", F.col("top").alias("label"))
