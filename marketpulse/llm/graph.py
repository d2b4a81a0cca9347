"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketpulse.llm.common import again, stored


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b); the component is the
    smallest id reachable. Each round takes the neighbours' smallest labels
    and then the label of the label; the labels of a round are a stored table.
    A hub's links are summed before they meet and its joins can be split."""
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct()
                  .toDF("a", "b"), "links")
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(
        F.least(F.first("a"), F.min("b")).alias("component")), "labels")
    while True:
        far = labels.select(again(F.col("id")).alias("k"), F.col("component").alias("c"))
        near = (both.join(far, again(F.col("b")) == F.col("k"))
                .groupBy(F.col("a").alias("id")).agg(F.min("c").alias("near")))
        step = labels.join(near, "id").select(
            "id", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        top = labels.select(again(F.col("id")).alias("k"), F.col("component").alias("up"))
        now = stored(step.join(top, again(F.col("component")) == F.col("k"))
                     .select("id", "old", F.least("component", "up").alias("component")), "labels")
        labels = now.select("id", "component")
        if now.filter("component <> old").isEmpty():
            return labels
