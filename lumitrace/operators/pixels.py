"""Lookups in pixel tables (image_id, i, j, value) through an image's projection.

Pixels come as a table, or as stored tiles (`lumitrace.sources.pixel_tiles`), of
which only those around the positions are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumitrace.functions.sky import beam_pixels, tangent_pixel
from lumitrace.sources.pixel_tiles import PixelTiles

_WCS = ["projection", "crval1", "crval2", "crpix1", "crpix2", "cdelt1", "cdelt2"]


def locate(rows: DataFrame, wcs: DataFrame) -> DataFrame:
    """Adds the pixel (i, j) of each row's (ra, dec) in its image; NULL when it has none."""
    i, j = tangent_pixel("ra", "dec", *_WCS)
    known = wcs.filter(F.col("projection").isin("SIN", "TAN"))
    return rows.join(known, "image_id").withColumns({"i": i, "j": j})


def sample_noise(rows: DataFrame, wcs: DataFrame, pixels: DataFrame | PixelTiles, nbeam: int = 3, edge_buffer: float = 1.0) -> DataFrame:
    """Noise (x 1000) at each (source, image_id, ra, dec), as `true_rms`.

    NULL near the image edge, and where a pixel within half a beam is blank.
    `wcs` holds the projection, naxis1, naxis2 and bmaj per image.
    """
    scale = F.abs(F.col("cdelt2"))
    margin = beam_pixels("bmaj", scale, nbeam, edge_buffer)
    located = locate(rows, wcs).withColumns({"_margin": margin, "_near": F.rint(F.col("bmaj") / 2.0 / scale).cast("long")})
    inside = (
        (F.col("i") >= F.col("_margin"))
        & (F.col("i") < F.col("naxis2") - F.col("_margin"))
        & (F.col("j") >= F.col("_margin"))
        & (F.col("j") < F.col("naxis1") - F.col("_margin"))
    )
    good = located.filter(inside).select("source", "image_id", "i", "j", "_near")
    if isinstance(pixels, PixelTiles):
        pixels = pixels.near(good.select("image_id", "i", "j", F.col("_near").alias("half")))
    blank = pixels.filter(F.col("value").isNull() | F.isnan("value")).select("image_id", "i", "j")
    # A few pixels around each position, met with blank pixels by equality.
    span = lambda c: F.explode(F.sequence(F.col(c) - F.col("_near"), F.col(c) + F.col("_near") - 1))
    around = good.filter("_near > 0").withColumn("_i", span("i")).withColumn("_j", span("j"))
    around = around.select("source", "image_id", F.col("_i").alias("i"), F.col("_j").alias("j"))
    spoiled = around.join(blank, ["image_id", "i", "j"], "left_semi").select("source", "image_id").distinct()
    clear = good.join(spoiled, ["source", "image_id"], "left_anti")
    values = pixels.select("image_id", "i", "j", "value")
    sampled = clear.join(values, ["image_id", "i", "j"]).select("source", "image_id", (F.col("value") * 1000.0).alias("true_rms"))
    return rows.select("source", "image_id").join(sampled, ["source", "image_id"], "left")


def stamp(rows: DataFrame, wcs: DataFrame, pixels: DataFrame | PixelTiles, size_arcmin: float) -> DataFrame:
    """Pixels of the square box of a given size around each row's position, cut at the image edges.

    `rows` has id, image_id, ra, dec. Pixels and boxes meet on tiles as wide
    as the widest box, so a box touches at most two tiles per axis.
    """
    half = F.floor(F.lit(size_arcmin / 60.0 / 2) / F.abs(F.col("cdelt2")))
    boxes = locate(rows, wcs).withColumn("_half", half.cast("long")).select("id", "image_id", F.col("i").alias("_i0"), F.col("j").alias("_j0"), "_half")
    if isinstance(pixels, PixelTiles):
        pixels = pixels.near(boxes.select("image_id", F.col("_i0").alias("i"), F.col("_j0").alias("j"), F.col("_half").alias("half")))
    widest = wcs.agg(F.min(F.abs("cdelt2"))).first()[0]
    if not widest:
        raise ValueError("no image projection to cut stamps from")
    tile = max(int(size_arcmin / 60.0 / widest) + 1, 1)
    tiles = lambda c: F.explode(F.sequence(F.floor((F.col(c) - F.col("_half")) / tile), F.floor((F.col(c) + F.col("_half")) / tile)))
    boxes = boxes.withColumn("_ti", tiles("_i0")).withColumn("_tj", tiles("_j0"))
    filed = pixels.withColumns({"_ti": F.floor(F.col("i") / tile), "_tj": F.floor(F.col("j") / tile)})
    near = (F.abs(F.col("i") - F.col("_i0")) <= F.col("_half")) & (F.abs(F.col("j") - F.col("_j0")) <= F.col("_half"))
    return filed.join(boxes, ["image_id", "_ti", "_tj"]).filter(near).select("id", "image_id", "i", "j", "value")
