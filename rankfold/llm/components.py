"""Connected components of a link table, as Spark joins and aggregations.

Every vertex takes the smallest label among its own and its neighbours', then
the label of its label (pointer jumping), until nothing changes.  Minima are
pre-aggregated before each shuffle, so a hub costs no more than its links.
Each round is checkpointed to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(links: DataFrame) -> DataFrame:
    """(v, component) for every vertex of ``links`` (a, b); the component is its smallest vertex."""
    both = (links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
            .distinct().checkpoint())
    labels = both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select(
        "v", F.least("v", "m").alias("component")).checkpoint()
    while True:
        near = (both.join(labels.withColumnRenamed("v", "b"), "b").groupBy(F.col("a").alias("v"))
                .agg(F.min("component").alias("near")))
        new = labels.join(near, "v").select("v", F.col("component").alias("old"),
                                            F.least("component", "near").alias("component"))
        roots = labels.select(F.col("v").alias("_r"), F.col("component").alias("_rc"))
        new = new.join(roots, F.col("component") == F.col("_r"), "left").select(
            "v", "old", F.least("component", F.coalesce("_rc", "component")).alias("component")).checkpoint()
        changed = not new.where("component <> old").isEmpty()
        labels = new.select("v", "component")
        if not changed:
            return labels
