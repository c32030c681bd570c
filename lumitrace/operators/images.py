"""Images: attributes from header cards, bands, sky regions, noise, what is new."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumitrace.functions.sky import julian_date, pixel_to_sky, unit_vector
from lumitrace.operators.ranking import dense_index, group_median

# Header keywords an image is described by.
KEYWORDS = [
    "STOKES", "DURATION", "TELESCOP", "DATE-OBS", "TIMESYS", "BMAJ", "BMIN", "BPA", "NAXIS1", "NAXIS2", "CTYPE1", "CRVAL1", "CRVAL2",
    "CRPIX1", "CRPIX2", "CDELT1", "CDELT2", "CTYPE3", "CRVAL3", "CDELT3", "CTYPE4", "CRVAL4", "CDELT4", "RESTFREQ", "RESTBW",
]
REQUIRED = ["DATE-OBS", "TIMESYS", "BMAJ", "BMIN", "BPA"]
FREQUENCY_TYPES = ["FREQ", "VOPT"]
# Two frequencies are of one band when they differ by less than this fraction of the band's.
BAND_TOLERANCE = 0.02


# Cards of one task: aggregates of strings sort their rows, so a task holds that many.
CARDS_PER_TASK = 1_000_000


def pivot_cards(cards: DataFrame, keywords: list[str] = KEYWORDS) -> DataFrame:
    """One row per image with a column per keyword, from (image, keyword, value) cards.

    Cards are dealt by image to as many tasks as there are cards for, before
    anything is sorted.
    """
    upper = cards.select("image", F.upper("keyword").alias("keyword"), "value")
    tasks = math.ceil(upper.count() / CARDS_PER_TASK)
    return upper.repartition(max(tasks, 1), "image").groupBy("image").pivot("keyword", keywords).agg(F.min("value"))


def header_problems(cards: DataFrame, telescope: str = "ASKAP") -> DataFrame:
    """Keywords an image of the telescope should have and has not, one row each."""
    needed = ["TELESCOP", *REQUIRED]
    wide = pivot_cards(cards.filter(F.upper("keyword").isin(needed)), needed).filter(F.col("TELESCOP") == telescope)
    absent = F.filter(
        F.array(*[F.when(F.col(f"`{k}`").isNull(), F.lit(k)) for k in REQUIRED]), lambda k: k.isNotNull()
    )
    return wide.select("image", F.explode(absent).alias("missing"))


def image_attributes(cards: DataFrame, telescope: str = "ASKAP", entire_image: bool = True) -> DataFrame:
    """Attributes of each image. Beam, time, centre and sizes only for the telescope's own headers."""
    wide = pivot_cards(cards)
    number = lambda k: F.col(f"`{k}`").try_cast("double")
    ours = F.coalesce(F.col("TELESCOP") == telescope, F.lit(False))
    own = lambda value: F.when(ours, value)
    nx, ny = number("NAXIS1"), number("NAXIS2")
    diameter = F.hypot(nx, ny) if entire_image else F.least(nx, ny)
    radius = diameter / 2.0
    projection = F.substring("CTYPE1", -3, 3)
    ra, dec = pixel_to_sky(nx / 2.0, ny / 2.0, projection, number("CRVAL1"), number("CRVAL2"), number("CRPIX1"), number("CRPIX2"), number("CDELT1"), number("CDELT2"))
    scale1, scale2 = F.abs(number("CDELT1")), F.abs(number("CDELT2"))
    axis3, axis4 = F.col("CTYPE3").isin(FREQUENCY_TYPES), F.col("CTYPE4").isin(FREQUENCY_TYPES)

    def by_axis(third: str, fourth: str, rest: str, default: Column | None = None) -> Column:
        fill = (lambda c: F.coalesce(c, default)) if default is not None else (lambda c: c)
        return F.when(axis3, fill(number(third))).when(axis4, fill(number(fourth))).otherwise(fill(number(rest)))

    stamp = F.col("`DATE-OBS`").try_cast("timestamp")
    out = wide.select(
        "image",
        F.coalesce("STOKES", F.lit("I")).alias("polarisation"),
        F.coalesce(number("DURATION"), F.lit(0.0)).alias("duration"),
        own(stamp).alias("datetime"),
        F.coalesce(own(number("BMAJ")), F.lit(0.0)).alias("beam_bmaj"),
        F.coalesce(own(number("BMIN")), F.lit(0.0)).alias("beam_bmin"),
        F.coalesce(own(number("BPA")), F.lit(0.0)).alias("beam_bpa"),
        own(ra).alias("ra"),
        own(dec).alias("dec"),
        own(radius * scale1).alias("fov_bmin"),
        own(radius * scale2).alias("fov_bmaj"),
        own(nx * scale1).alias("physical_bmin"),
        own(ny * scale2).alias("physical_bmaj"),
        own(radius).alias("radius_pixels"),
        by_axis("CRVAL3", "CRVAL4", "RESTFREQ").alias("freq_eff"),
        by_axis("CDELT3", "CDELT4", "RESTBW", F.lit(0.0)).alias("freq_bw"),
    )
    return out.withColumn("jd", julian_date("datetime"))


def assign_bands(frequencies: DataFrame, bands: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Bands of integer-MHz frequencies: (frequency -> band frequency, bands in order of creation).

    `frequencies` has `frequency` (long) and `first_seen` (its place in the
    input). Whether a frequency opens a band depends on all before it, so the
    distinct frequencies are folded in order. There are at most as many as
    integer MHz values, whatever the number of images.
    """
    distinct = frequencies.groupBy("frequency").agg(F.min("first_seen").alias("place"))
    rows = distinct.select("place", F.col("frequency").cast("double").alias("f"), F.lit(False).alias("known"))
    if bands is not None:
        rows = rows.unionByName(bands.select(F.col("id").alias("place"), F.col("frequency").cast("double").alias("f"), F.lit(True).alias("known")))
    # collect_list leaves out the NULLs that `when` gives for the other kind of row.
    entry = F.struct("place", "f")
    lists = rows.groupBy().agg(
        F.array_sort(F.collect_list(F.when(~F.col("known"), entry))).alias("_new"),
        F.array_sort(F.collect_list(F.when(F.col("known"), entry))).alias("_known"),
    )
    fits = lambda f: lambda b: F.abs(f - b) / b < BAND_TOLERANCE
    fold = F.aggregate(
        "_new",
        F.transform("_known", lambda b: b["f"]),
        lambda acc, x: F.when(F.exists(acc, fits(x["f"])), acc).otherwise(F.concat(acc, F.array(x["f"]))),
    )
    folded = lists.select("_new", fold.alias("bands"))
    table = folded.select(F.posexplode("bands").alias("pos", "band"))
    table = table.select((F.col("pos") + 1).cast("long").alias("band_order"), F.col("band").alias("band_frequency"))
    # The first band in order that fits each frequency.
    place = F.transform("_new", lambda x: F.struct(x["f"].cast("long").alias("frequency"), F.get(F.filter("bands", fits(x["f"])), F.lit(0)).alias("band_frequency")))
    return folded.select(F.inline(place)), table


def get_or_create_regions(images: DataFrame, regions: DataFrame) -> DataFrame:
    """All sky regions after adding those of `images`: one per (ra, dec, fov_bmin), with unit vector.

    `images` has ra, dec, fov_bmin, physical_bmin, physical_bmaj; `regions`
    the columns of the result.
    """
    keys = ["centre_ra", "centre_dec", "xtr_radius"]
    wanted = images.groupBy(F.col("ra").alias("centre_ra"), F.col("dec").alias("centre_dec"), F.col("fov_bmin").alias("xtr_radius")).agg(
        F.min("physical_bmin").alias("width_ra"), F.min("physical_bmaj").alias("width_dec")
    )
    fresh = wanted.join(regions.select(*keys), keys, "left_anti")
    # One number, the highest id so far, reaches the driver.
    top = regions.agg(F.max("id")).first()[0] or 0
    fresh = dense_index(fresh, keys, "id", top + 1)
    x, y, z = unit_vector("centre_ra", "centre_dec")
    fresh = fresh.withColumns({"x": x, "y": y, "z": z})
    return regions.unionByName(fresh.select(*regions.columns))


def unseen_images(images: DataFrame, existing: DataFrame) -> DataFrame:
    """Images whose name is not known yet."""
    return images.join(existing.select("name"), "name", "left_anti")


def fill_backgrounds(existing: DataFrame, images: DataFrame) -> DataFrame:
    """Known images, with background paths that were missing taken from the new list."""
    given = images.groupBy("name").agg(F.min("background_path").alias("_given"))
    joined = existing.join(given, "name", "left")
    return joined.withColumn("background_path", F.coalesce("background_path", "_given")).drop("_given")


def noise_statistics(pixels: DataFrame) -> DataFrame:
    """Median, least and greatest noise per image in mJy, over finite positive pixels (Jy)."""
    value = F.col("value")
    good = pixels.filter(value.isNotNull() & ~F.isnan(value) & (value > 0) & (value < float("inf")))
    ends = good.groupBy("image_id").agg((F.min("value") * 1000).alias("rms_min"), (F.max("value") * 1000).alias("rms_max"))
    middle = group_median(good, ["image_id"], "value", "_median")
    return ends.join(middle, "image_id").select("image_id", (F.col("_median") * 1000).alias("rms_median"), "rms_min", "rms_max")
