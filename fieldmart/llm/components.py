"""Connected components of an undirected link table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.llm.common import Scratch

SALTS = 16
"""Parts that the nodes of one label, and the links of one node, are dealt to."""


def dealt(lookup: DataFrame) -> DataFrame:
    """lookup once for each salt."""
    return lookup.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of links (a, b): label is the smallest node reachable.

    Smallest neighbour labels and pointer jumps alternate until nothing changes; each round is written to the shared
    folder, so lineage stays short. A label that many nodes have, or a node that many links have, is joined in salted
    parts. Nodes are longs; an empty table gives an empty table.
    """
    spark = links.sparkSession
    whole, last = Scratch(spark), Scratch(spark)
    both = links.select(F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(links.select(F.col("b").alias("src"), F.col("a").alias("dst"))).distinct()
    edges = whole.keep(both.withColumn("salt", F.pmod(F.xxhash64("src"), F.lit(SALTS)).cast("int")), "edges")
    labels = last.keep(edges.groupBy(F.col("src").alias("node")).agg(F.least(F.col("src"), F.min("dst")).alias("label")), "labels")
    while True:
        step, new = Scratch(spark), Scratch(spark)
        near = edges.join(dealt(labels.withColumnRenamed("node", "dst")), ["dst", "salt"]).groupBy("src").agg(F.min("label").alias("near"))
        lower = labels.join(near, labels.node == near.src).select("node", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        lower = step.keep(lower.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")), "lower")
        up = lower.select("label").distinct().join(lower.select(F.col("node").alias("label"), F.col("label").alias("up")), "label")
        jumped = lower.join(dealt(up), ["label", "salt"], "left").select("node", F.least("label", F.coalesce("up", "label")).alias("label"), "was")
        stepped = new.keep(jumped, "labels")
        done = stepped.where("label <> was").isEmpty()
        step.drop()
        last.drop()
        labels, last = stepped.select("node", "label"), new
        if done:
            whole.drop()
            return labels
