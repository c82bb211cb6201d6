"""Connected components of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordersight.plans.shared_store import store


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every end of a link in (a, b); the component is its smallest id.

    Each round takes the smallest label among the neighbours and then jumps to the
    label of that label, so long chains need few rounds. Joins are by id, counts
    and minima are pre-aggregated; a round is stored, so lost executors do not
    cost the earlier ones.
    """
    both = store(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct())
    labels = store(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("b")).select("id", F.least("id", "b").alias("component")))
    while True:
        near = both.join(labels, both.b == labels.id).groupBy("a").agg(F.min("component").alias("near"))
        least = labels.join(near, labels.id == near.a, "left").select("id", "component", F.least("component", "near").alias("least"))
        target = labels.select(F.col("id").alias("at"), F.col("component").alias("further"))
        jumped = least.join(target, least.least == target["at"], "left")
        new = store(jumped.select("id", F.least("least", "further").alias("component"), (F.least("least", "further") < F.col("component")).alias("changed")))
        labels = new.select("id", "component")
        if new.where("changed").isEmpty():
            return labels
