"""Connected components of a table of links, by smallest label and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.storage import keep


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``links(a, b)``; label is its least node.

    Each round gives every node the least label among its own and its
    neighbours', then the label of that label. Minima are summed up before they
    are shuffled, so a node of very many links is no bottleneck. Labels are
    written to the shared folder each round; the loop ends when none changes.
    """
    both = keep(
        links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links"
    )
    labels = keep(
        both.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("node"), F.least("a", "b").alias("label")
        ),
        "labels",
    )
    while True:
        near = (
            both.join(labels.hint("merge"), both.b == labels.node)
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        hooked = labels.join(near.hint("merge"), "node").select(
            "node", F.least("label", "near").alias("label"), F.col("label").alias("old")
        )
        heads = labels.select(F.col("node").alias("label"), F.col("label").alias("head"))
        new = keep(
            hooked.join(heads.hint("merge"), "label", "left").select(
                "node", F.least("label", F.coalesce("head", "label")).alias("label"), "old"
            ),
            "labels",
        )
        changed = not new.where("label <> old").isEmpty()
        labels = new.select("node", "label")
        if not changed:
            return labels
