"""Connected components of links, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_counted, staged

MAX_ROUNDS = 100


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for every node of links (a, b); nodes without a link aren't listed.

    Each round takes the least label among neighbours, then the label of the label, so the rounds grow with the
    logarithm of the diameter. Labels stay in tables in the shared folder; only the count of changes reaches the driver. A node with
    very many links, and a label that very many nodes bear, are joined by broadcast, so neither is a hot task.
    Links with a null end, of a node with itself and repeated ones tell nothing. An empty table gives no rows.
    """
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    both = staged(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).filter("u != v").distinct(), "cc-links")
    first = both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("component"), F.count("*").alias("degree"))
    labels = staged(first, "cc-labels")
    for _ in range(MAX_ROUNDS):
        told = labels.select(F.col("node").alias("u"), "component", "degree")
        near = join_counted(both, told, ["u"], "degree").groupBy(F.col("v").alias("node")).agg(F.min("component").alias("least"))
        moved = labels.join(near, "node").select("node", "degree", F.least("component", "least").alias("component"), F.col("component").alias("was"))
        moved = staged(moved, "cc-moved")
        borne = moved.groupBy(F.col("component").alias("node")).agg(F.count("*").alias("borne"))
        heads = staged(borne.join(labels.select("node", F.col("component").alias("jump")), "node").select(F.col("node").alias("component"), "jump", "borne"), "cc-heads")
        new = join_counted(moved, heads, ["component"], "borne", "left").select("node", "degree", F.least("component", F.coalesce("jump", "component")).alias("component"), "was")
        new = staged(new, "cc-labels")
        if new.filter("component < was").limit(1).count() == 0:
            return new.select("node", "component")
        labels = new.drop("was")
    raise RuntimeError("components did not settle")
