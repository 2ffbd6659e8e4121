"""Connected components of a graph that is only ever held as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.store import keep


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every id of an edge, component being the smallest id reachable.

    Each round passes the smallest label over the edges and then follows the label's own
    label, so a chain shortens by half each time. Rounds end when no label changes. Both
    tables are written in every round, so a node with very many edges is split by adaptive
    execution where it is joined. No edges give no rows.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u != v")
    both = keep(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "cc-edges")
    # First labels: the smallest neighbour.
    labels = keep(both.groupBy(F.col("u").alias("id")).agg(F.least(F.min("v"), F.col("id")).alias("component")), "cc-labels")
    while True:
        heard = both.join(labels, F.col("v") == F.col("id")).groupBy("u").agg(F.min("component").alias("near"))
        nearer = keep(
            labels.join(heard, F.col("id") == F.col("u"), "left").select(
                "id", "component", F.least("component", "near").alias("low")
            ),
            "cc-near",
        )
        jump = nearer.select(F.col("id").alias("at"), F.col("low").alias("further"))
        after = keep(
            nearer.join(jump, F.col("low") == F.col("at"), "left").select(
                "id", F.least("low", "further").alias("component"), (F.least("low", "further") < F.col("component")).alias("moved")
            ),
            "cc-labels",
        )
        labels = after.select("id", "component")
        if not after.filter("moved").limit(1).count():
            return labels
