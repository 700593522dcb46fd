"""Connected components of a link table, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlake.llm._stored import stored


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id`` and ``component`` (smallest id reachable) of every id in a link.

    Each round, an id takes the smallest label among its own and its
    neighbours', then the label of that label, so labels travel twice as far
    every round. Rounds are written to the shared folder; only the number of
    changed labels comes to the driver. An id with very many links costs one
    pre-aggregated row per task and round."""
    both = links.select(F.col(a).alias("id"), F.col(b).alias("other")).where("id <> other")
    both = stored(both.union(both.select(F.col("other").alias("id"), F.col("id").alias("other"))).distinct(), "links")
    labels = stored(both.groupBy("id").agg(F.min("other").alias("low")).select("id", F.least("id", "low").alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("other"), F.col("component").alias("low")), "other").groupBy("id").agg(F.min("low").alias("low"))
        step = labels.join(near, "id").select("id", F.col("component").alias("was"), F.least("component", "low").alias("component"))
        jump = step.select(F.col("id").alias("component"), F.col("component").alias("further"))
        step = stored(step.join(jump, "component").select("id", "was", F.least("component", "further").alias("component")), "labels")
        changed = step.where("was <> component").count()
        labels = step.drop("was")
        if not changed:
            return labels
