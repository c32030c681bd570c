"""Rows of one epoch that repeat a detection of another image."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumitrace.functions.sky import separation
from lumitrace.operators.skyjoin import without_near


def with_centre_distance(measurements: DataFrame, images: DataFrame) -> DataFrame:
    """Distance in degrees of each measurement from the centre of its own image."""
    centres = images.select("image_id", F.col("ra").alias("_cra"), F.col("dec").alias("_cdec"))
    joined = measurements.join(centres, "image_id")
    return joined.withColumn("dist_from_centre", separation("ra", "dec", "_cra", "_cdec")).drop("_cra", "_cdec")


def drop_epoch_duplicates(measurements: DataFrame, limit_deg: float, by: tuple[str, ...] = ("epoch",)) -> DataFrame:
    """Keep a row unless a row of another image, closer to its image centre, lies within the limit.

    A row may be dropped by one that is dropped itself. Order is
    `dist_from_centre`, then id. All epochs are handled at once.

    A row leaves at the first such row it meets, so a clump of several images
    is not paired with itself.
    """
    # NULL distances come first.
    dist = F.coalesce("dist_from_centre", F.lit(-1.0))
    rivals = measurements.select(F.col("id").alias("_id2"), F.col("image_id").alias("_image2"), F.col("ra").alias("_ra2"), F.col("dec").alias("_dec2"), dist.alias("_dist2"), *by)
    before = (F.col("_dist2") < dist) | ((F.col("_dist2") == dist) & (F.col("_id2") < F.col("id")))
    return without_near(measurements, rivals, limit_deg, (F.col("image_id") != F.col("_image2")) & before, by=by)
