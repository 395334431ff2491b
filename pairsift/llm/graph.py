"""Connected components of a graph that is a table of links."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairsift.llm.common import kept
from pairsift.stages import discarded


def components(links: DataFrame) -> DataFrame:
    """``node, label`` of every node in ``links`` (``a, b`` bigint); one label per component.

    Each round every node joins that one of its neighbours and itself which comes first
    in an order made anew by a hash (and the one which that one joins), and links
    between what has become one node fall away, until none is left. In a random order
    a share of the nodes goes each round, whatever the ids are, so a chain takes rounds
    by the logarithm of its length. Each round's tables are stored, nothing but "any
    links left?" reaches the driver, and a node with many neighbours is summed up before
    it is shuffled. An empty table of links gives an empty result.
    """
    links = kept(links.where("a <> b").select("a", "b").distinct(), "links")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    labels = kept(nodes.withColumn("label", F.col("node")), "labels")
    for turn in count():
        if links.isEmpty():
            break

        def placed(node: str) -> Column:
            return F.struct(F.xxhash64(F.lit(turn), node).alias("order"), F.col(node).alias("near"))

        both = links.union(links.select("b", "a")).toDF("node", "near")
        nearest = both.groupBy("node").agg(F.least(F.min(placed("near")), placed("node")).alias("to"))
        nearest = kept(nearest.select("node", "to.near"), "nearest").withColumnRenamed("near", "to")
        step = nearest.select(F.col("node").alias("to"), F.col("to").alias("beyond"))
        step = kept(nearest.join(step, "to").select("node", F.col("beyond").alias("to")), "steps")
        done = [links, nearest, step, labels]
        labels = kept(
            labels.join(step.toDF("label", "to"), "label", "left").select(
                "node", F.coalesce("to", "label").alias("label")
            ),
            "labels",
        )
        links = kept(
            links.join(step.toDF("a", "to_a"), "a")
            .join(step.toDF("b", "to_b"), "b")
            .select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
            .where("a <> b")
            .distinct(),
            "links",
        )
        for table in done:
            discarded(table)
    discarded(links)
    return labels
