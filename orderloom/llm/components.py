"""Connected components of links by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.session import settle

MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(id, label) for every id in ``links`` (a, b): the smallest id it is connected to.

    Each round every node takes the smallest label among its neighbours, then the label of
    its label, so chains shorten by halves. Minima aggregate before they shuffle, whatever
    the number of a node's links. A round ends at written tables.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = settle(both.where("a <> b").distinct())
    labels = settle(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("label")))
    for _ in range(MOST_ROUNDS):
        heard = (
            both.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("label").alias("heard"))
        )
        nearer = labels.join(heard, "id", "left").select(
            "id", F.col("label").alias("old"), F.least("label", F.coalesce("heard", "label")).alias("label")
        )
        above = labels.select(F.col("id").alias("label"), F.col("label").alias("further"))
        jumped = settle(
            nearer.join(above, "label", "left").select(
                "id", "old", F.least("label", F.coalesce("further", "label")).alias("label")
            )
        )
        labels = jumped.select("id", "label")
        if jumped.where("label <> old").isEmpty():
            return labels
    raise RuntimeError(f"labels still change after {MOST_ROUNDS} rounds")
