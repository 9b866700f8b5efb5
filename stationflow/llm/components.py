"""Connected components of a link table by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stationflow.llm.common import fixed


def connected_components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (``a, b``); the label is the component's smallest node.

    Labels are parents of a forest.  Each round a node looks at the grandparents of its neighbours: the
    smallest one becomes its own parent and, hooked from the root's side, its parent's parent if it is
    smaller than that; then every node moves up to its grandparent.  So whole trees meet in a round and
    not only the nodes at their border, and the rounds grow with the logarithm of a component, also on
    a long path in hostile order.  All steps are minimum aggregates, combined before they are shuffled,
    and each round is written to the shared folder.  Null ends and loops are ignored; repeated links
    change nothing.
    """
    a, b = F.col("a"), F.col("b")
    proper = links.where(a.isNotNull() & b.isNotNull() & (a != b))
    both = proper.select("a", "b").unionByName(proper.select(b.alias("a"), a.alias("b")))
    edges = fixed(both.distinct(), "links")
    labels = fixed(
        edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("label")),
        "labels",
    )
    while True:
        parents = labels.select(F.col("node").alias("label"), F.col("label").alias("grand"))
        known = fixed(labels.join(parents, "label").select("node", "label", "grand"), "labels")
        near = (
            edges.join(known.select(F.col("node").alias("b"), "grand"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("grand").alias("near"))
        )
        seen = known.join(near, "node")
        own = F.struct("node", F.least("label", "grand", "near").alias("label"), F.col("label").alias("old"))
        hook = F.struct(F.col("label").alias("node"), F.col("near").alias("label"), F.lit(None).cast(labels.schema["label"].dataType).alias("old"))
        offers = seen.select(F.inline(F.array(own, hook)))
        step = fixed(offers.groupBy("node").agg(F.min("label").alias("label"), F.max("old").alias("old")), "labels")
        labels = step.select("node", "label")
        if step.where(F.col("old") != F.col("label")).isEmpty():
            return labels
