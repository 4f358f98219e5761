"""Connected components by smallest labels, for the crosswalk of wells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_estimates


def smallest_labels(edges: DataFrame) -> DataFrame:
    """(node, root): every node of ``edges`` (a, b) with the smallest node it is connected with.

    Each round, every node hears its neighbours' labels; a label that any of its nodes hears a smaller one
    through gives way to it for all of them, and labels jump through one another, so groups of any shape
    are done after about the logarithm of their size. Hubs and large groups are reduced on the map side.
    Null ends are ignored.
    """
    ends = edges.where("a is not null and b is not null")
    both = cut_estimates(ends.select("a", "b").unionAll(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_estimates(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")))
    while True:
        heard = both.join(labels.select(F.col("node").alias("b"), F.col("root").alias("r")), "b").groupBy(F.col("a").alias("node")).agg(F.min("r").alias("r"))
        near = cut_estimates(labels.join(heard, "node").select("node", F.col("root").alias("old"), F.least("root", "r").alias("mid")))
        # what a label gives way to: the smallest heard by a node that has it, or by the node it names
        given = near.select(F.explode(F.array("old", "node")).alias("label"), F.col("mid").alias("far")).groupBy("label").agg(F.min("far").alias("far"))
        step = cut_estimates(near.join(given, near["mid"] == given["label"], "left").select("node", "old", F.least("mid", F.coalesce("far", "mid")).alias("root")))
        labels = step.select("node", "root")
        if step.where("root <> old").isEmpty():
            return labels
