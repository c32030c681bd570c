"""Ideal coverage: which images should have seen a source and did not; new sources.

Everything is kept in long form, one row per source and image, so no image
list is collected per source or region.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumitrace.operators.pixels import sample_noise
from lumitrace.operators.skyjoin import region_join
from lumitrace.operators.stats import average_position
from lumitrace.sources.pixel_tiles import PixelTiles
from lumitrace.workspace import materialize


def ideal_images(positions: DataFrame, images: DataFrame, regions: DataFrame) -> DataFrame:
    """The image each source should be seen in per epoch: that of the nearest region covering it.

    `positions` has source, wavg_ra, wavg_dec; `images` image_id, epoch,
    datetime, skyreg_id; `regions` id, centre_ra, centre_dec, xtr_radius.
    """
    # One image per region and epoch is enough, so reduce before the join.
    offers = images.groupBy("skyreg_id", "epoch").agg(F.min(F.struct("datetime", "image_id")).alias("_image"))
    discs = regions.select(F.col("id").alias("skyreg_id"), "centre_ra", "centre_dec", "xtr_radius")
    # A region without an image offers nothing.
    discs = materialize(discs.join(images.select("skyreg_id").distinct(), "skyreg_id", "left_semi"), "regions")
    covered = region_join(positions, discs, row_pos=("wavg_ra", "wavg_dec")).select("source", "skyreg_id", "sep")
    nearest = covered.join(offers, "skyreg_id").groupBy("source", "epoch").agg(F.min(F.struct("sep", "skyreg_id", "_image")).alias("_best"))
    return nearest.select("source", "epoch", F.col("_best._image.image_id").alias("image_id"), F.col("_best._image.datetime").alias("datetime"))


def region_images(regions: DataFrame, images: DataFrame) -> DataFrame:
    """Images of every sky region, a row each; a region without images has one row of NULLs."""
    of_region = images.select(F.col("skyreg_id").alias("id"), "image_id", "name", "epoch", "datetime")
    return regions.select("id").join(of_region, "id", "left").withColumnRenamed("id", "skyreg_id")


def missing_images(detections: DataFrame, images: DataFrame, regions: DataFrame) -> DataFrame:
    """Ideal images a source was not seen in, one row each.

    An epoch in which the source was seen in any image counts as seen.
    Columns: source, image_id, epoch, image_time, detection (first image it
    was seen in), detection_time, in_primary (whether its first ideal image
    saw it), wavg_ra, wavg_dec.
    """
    positions = materialize(average_position(detections), "positions")
    ideal = ideal_images(positions, images, regions)
    seen = detections.groupBy("source", "image_id").agg(F.min("epoch").alias("epoch"))
    times = images.select("image_id", "datetime")
    first_seen = seen.join(times, "image_id").groupBy("source").agg(F.min(F.struct("datetime", "image_id")).alias("_first"))
    primary = ideal.groupBy("source").agg(F.min(F.struct("datetime", "image_id")).alias("_primary"))
    primary = primary.select("source", F.col("_primary.image_id").alias("image_id"))
    in_primary = primary.join(seen.select("source", "image_id").withColumn("in_primary", F.lit(True)), ["source", "image_id"], "left")
    in_primary = in_primary.select("source", F.coalesce("in_primary", F.lit(False)).alias("in_primary"))
    missing = ideal.join(seen.select("source", "image_id"), ["source", "image_id"], "left_anti")
    missing = missing.join(seen.select("source", "epoch").distinct(), ["source", "epoch"], "left_anti")
    return (
        missing.join(first_seen, "source")
        .join(in_primary, "source")
        .join(positions, "source")
        .select(
            "source",
            "image_id",
            "epoch",
            F.col("datetime").alias("image_time"),
            F.col("_first.image_id").alias("detection"),
            F.col("_first.datetime").alias("detection_time"),
            "in_primary",
            "wavg_ra",
            "wavg_dec",
        )
    )


def with_detection_flux(missing: DataFrame, detections: DataFrame) -> DataFrame:
    """Adds `flux_peak` at the first detection."""
    fluxes = detections.groupBy("source", F.col("image_id").alias("detection")).agg(F.max("flux_peak").alias("flux_peak"))
    return missing.join(fluxes, ["source", "detection"], "left")


def new_source_candidates(missing: DataFrame, detections: DataFrame, images: DataFrame, min_sigma: float) -> DataFrame:
    """Sources that an earlier image of their best noise would have shown at `min_sigma` or more."""
    early = missing.filter("NOT in_primary AND image_time < detection_time")
    noise = images.select("image_id", "rms_min")
    rows = with_detection_flux(early, detections).join(noise, "image_id")
    return rows.withColumn("diff_sigma", F.try_divide("flux_peak", "rms_min")).filter(F.col("diff_sigma") >= min_sigma)


def new_high_sigma(candidates: DataFrame, sampled: DataFrame, intended: bool = False) -> DataFrame:
    """Significance each new source would have had, from noise sampled in earlier images.

    By default the highest noise of a source's images counts; `intended`
    takes the lowest. Sources without a usable sample drop out.
    """
    # No usable value (NULL or 0) must not win as the lowest.
    usable = sampled.filter("true_rms IS NOT NULL AND true_rms <> 0")
    pick = F.min("true_rms") if intended else F.max("true_rms")
    noise = usable.groupBy("source").agg(pick.alias("true_rms"))
    flux = candidates.groupBy("source").agg(F.max("flux_peak").alias("flux_peak"))
    return flux.join(noise, "source").select("source", (F.col("flux_peak") / F.col("true_rms")).alias("new_high_sigma"))


def new_sources(
    missing: DataFrame,
    detections: DataFrame,
    images: DataFrame,
    wcs: DataFrame,
    noise_pixels: DataFrame | PixelTiles,
    min_sigma: float,
    edge_buffer: float,
    intended: bool = False,
) -> DataFrame:
    """New sources with their `new_high_sigma`; pixels are only read for candidates."""
    candidates = new_source_candidates(missing, detections, images, min_sigma)
    spots = candidates.select("source", "image_id", F.col("wavg_ra").alias("ra"), F.col("wavg_dec").alias("dec"))
    sampled = sample_noise(spots, wcs, noise_pixels, edge_buffer=edge_buffer)
    return new_high_sigma(candidates, sampled, intended)


def flag_new(sources: DataFrame, new: DataFrame) -> DataFrame:
    """`new` and `new_high_sigma` (0 for known sources) on every source."""
    joined = sources.join(new.select("source", F.col("new_high_sigma").alias("_sigma")), "source", "left")
    return joined.withColumns({"new": F.col("_sigma").isNotNull(), "new_high_sigma": F.coalesce("_sigma", F.lit(0.0))}).drop("_sigma")
