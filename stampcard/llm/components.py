"""Connected components of a link table by least labels, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stampcard.llm.common import written


def connected_components(links: DataFrame) -> DataFrame:
    """``id, label`` for every id in ``links`` (``a, b``); ``label`` is the least
    id that can be reached.

    Each round takes the least label of the neighbours and then the label of
    the label, so long chains halve. Rounds go on until no label changes. Every
    round is written, and the joins are of written tables, so adaptive execution
    can split the rows of a hub.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(both.distinct(), "links")
    labels = written(
        edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "id"),
        "labels",
    )
    while True:
        least = (
            edges.join(labels, edges["b"] == labels["id"])
            .groupBy("a")
            .agg(F.min("label").alias("near"))
        )
        nearer = written(
            labels.join(least, labels["id"] == least["a"]).select(
                "id", "label", F.least("label", "near").alias("near")
            ),
            "labels-near",
        )
        jump = nearer.select(F.col("id").alias("j"), F.col("near").alias("far"))
        labels = written(
            nearer.join(jump, nearer["near"] == jump["j"]).select(
                "id", F.col("far").alias("label"), (F.col("far") != F.col("label")).alias("moved")
            ),
            "labels-far",
        )
        if not labels.filter("moved").head(1):
            return labels.select("id", "label")
        labels = labels.select("id", "label")
