"""Groups of overlapping sky regions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumitrace.operators.ranking import dense_index
from lumitrace.operators.skyjoin import region_join
from lumitrace.workspace import materialize

# A region overlaps another when its centre is within this factor of the other's radius.
OVERLAP_FACTOR = 1.1


def region_edges(regions: DataFrame) -> DataFrame:
    """Pairs (id, other) of overlapping regions, both directions, self included."""
    here = regions.select("id", F.col("centre_ra").alias("ra"), F.col("centre_dec").alias("dec"))
    reach = F.col("xtr_radius") * OVERLAP_FACTOR
    discs = regions.select(F.col("id").alias("other"), "centre_ra", "centre_dec", (reach * (1 + 1e-12)).alias("xtr_radius"))
    pairs = region_join(here, discs).select("id", "other")
    return pairs.unionByName(pairs.select(F.col("other").alias("id"), F.col("id").alias("other"))).distinct()


def connected_labels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Smallest id reachable from each node. Edges must be listed in both directions.

    Every round takes the smallest label among the neighbours and then the
    label of that label, so long chains close in a few rounds.
    """
    edges = materialize(edges.select("id", "other").filter("id <> other"), "edges")
    labels = materialize(nodes.select("id", F.col("id").alias("label")), "labels")
    while True:
        theirs = labels.select(F.col("id").alias("other"), F.col("label").alias("_l"))
        spread = edges.join(theirs, "other").select("id", F.col("_l").alias("label"))
        lowest = labels.unionByName(spread).groupBy("id").agg(F.min("label").alias("label"))
        lowest = materialize(lowest, "labels")
        jump = lowest.select(F.col("id").alias("label"), F.col("label").alias("_l"))
        after = materialize(lowest.join(jump, "label").select("id", F.col("_l").alias("label")), "labels")
        changed = after.join(labels.withColumnRenamed("label", "_old"), "id").filter("label <> _old")
        if changed.isEmpty():
            return after
        labels = after


def group_regions(regions: DataFrame) -> DataFrame:
    """`id`, `skyreg_group`: overlapping regions share a group; groups count from 1 by smallest id."""
    labels = connected_labels(regions, region_edges(regions))
    numbers = dense_index(labels.select("label").distinct(), ["label"], "skyreg_group", 1)
    return labels.join(numbers, "label").select("id", "skyreg_group")


def attach_groups(images: DataFrame, groups: DataFrame) -> DataFrame:
    """Images with the group of their sky region; images outside all regions share group 0."""
    named = groups.select(F.col("id").alias("skyreg_id"), "skyreg_group")
    return images.join(named, "skyreg_id", "left").withColumn("skyreg_group", F.coalesce("skyreg_group", F.lit(0)))
