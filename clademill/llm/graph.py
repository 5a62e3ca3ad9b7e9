"""Connected components of links, by joins; nothing is gathered on the driver but a count a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import drop_saved, saved


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): for every id in a link, the smallest id that it can reach.

    Every round takes the least label among neighbours and then the label of that label, so path lengths halve and the
    number of rounds is about the logarithm of the longest shortest path.
    """
    x = links.select(F.col(a).alias("u"), F.col(b).alias("v"))
    both = saved(x.union(x.select("v", "u").toDF("u", "v")).filter("u <> v").distinct(), "links")
    labels = saved(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("id"), F.least("u", "m").alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("v"), "component"), "v").groupBy(F.col("u").alias("id")).agg(F.min("component").alias("near"))
        lower = labels.join(near, "id").select("id", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        lower = saved(lower, "labels")
        up = lower.select(F.col("id").alias("component"), F.col("component").alias("up"))
        jumped = saved(lower.join(up, "component").select("id", "old", F.least("component", "up").alias("component")), "labels")
        changed = jumped.filter("component <> old").limit(1).count()
        drop_saved(labels), drop_saved(lower)
        labels = jumped.select("id", "component")
        if not changed:
            drop_saved(both)
            return labels
