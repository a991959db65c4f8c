"""Connected components of a link table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm import common

#: Parts into which the nodes of one label are split where labels are looked up.
SALTS = 16


def of_label(nodes: DataFrame, labels: DataFrame, column: str, kind: str = "inner") -> DataFrame:
    """Join labels (``column``, after) to nodes; the nodes of a label that most have are looked up in many parts."""
    salted = labels.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return nodes.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(salted, [column, "salt"], kind).drop("salt")


def components(links: DataFrame, scratch: common.Scratch) -> DataFrame:
    """node, label of every node of the links (columns a and b): the label is the least node that it reaches.

    Each round takes the least label among a node's neighbours and then its label's label, so rounds grow with the
    logarithm of the longest path.  Every round is written to the shared folder, and the one before deleted.
    """
    both = scratch.save(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = scratch.save(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = scratch.save(labels.join(near, "node").select("node", F.least("label", "near").alias("next"), (F.col("near") < F.col("label")).alias("moved")))
        over = step.select(F.col("node").alias("next"), F.col("next").alias("after")).join(step.select("next").distinct(), "next")
        jumped = scratch.save(of_label(step, over, "next").select("node", F.col("after").alias("label"), (F.col("moved") | (F.col("after") < F.col("next"))).alias("moved")))
        scratch.drop(step, labels)
        labels = jumped
        if jumped.where("moved").isEmpty():
            scratch.drop(both)
            return jumped.select("node", "label")


def merged(labels: DataFrame, links: DataFrame, scratch: common.Scratch) -> DataFrame:
    """The labels of ``components``, brought up to date for more links; only the components that these join are searched."""
    own = labels.select(F.col("node").alias("b"), F.col("label").alias("label_b"))
    ends = links.join(labels.toDF("a", "label_a"), "a", "left").join(own, "b", "left")
    ends = scratch.save(ends.select("a", "b", F.coalesce("label_a", "a").alias("label_a"), F.coalesce("label_b", "b").alias("label_b")))
    joined = components(ends.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")).where("a <> b"), scratch)
    new = ends.select(F.col("a").alias("node"), F.col("label_a").alias("label")).union(ends.select("b", "label_b"))
    every = labels.union(new).distinct()
    after = of_label(every, joined.toDF("label", "after"), "label", "left")
    out = scratch.save(after.select("node", F.coalesce("after", "label").alias("label")))
    scratch.drop(ends)
    return out
