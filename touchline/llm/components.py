"""Connected components of a graph given by links, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import materialise


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) for every end of a link (a, b): the smallest id it is connected with.

    Every round takes the smallest label among a node's neighbours and then the label of that label,
    so chains shrink by more than half. Each round is written out, which cuts the lineage; rounds end
    when no label changes. Links between hot nodes are reduced in the map task.
    """
    both = links.select(F.col("a").alias("id"), F.col("b").alias("near")).unionByName(
        links.select(F.col("b").alias("id"), F.col("a").alias("near"))
    )
    both = materialise(both.where("id <> near").distinct(), "component-links")
    labels = materialise(
        both.groupBy("id").agg(F.least(F.min("near"), F.min("id")).alias("component")), "component-labels"
    )
    while True:
        told = both.join(labels.select(F.col("id").alias("near"), "component"), "near")
        least = told.groupBy("id").agg(F.min("component").alias("told"))
        heard = labels.join(least, "id").select(
            "id", F.col("component").alias("before"), F.least("component", "told").alias("now")
        )
        jump = labels.select(F.col("id").alias("now"), F.col("component").alias("further"))
        moved = heard.join(jump, "now").select("id", "before", F.least("now", "further").alias("component"))
        moved = materialise(moved, "component-labels")
        labels = moved.select("id", "component")
        if moved.where("before <> component").isEmpty():
            return labels
