"""Fixed patches of sky: the unit in which stored tables are read and rewritten.

The sphere is cut into bands of declination and these into patches of about
equal size, some `width` degrees wide. There are at most `patch_count()` of them
whatever a table holds, so lists of patches may reach the driver. Widths are
divisors of 180; thinly filled tables take a larger one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 5.0
# Room for rounding at the edges of patches, in degrees.
_PAD = 1e-9


def _in_band(band: Column, width: float) -> Column:
    """Patches of a band, by the circle of it that is nearest to the equator."""
    low = band * width - 90.0
    widest = F.when((low <= 0) & (low + width >= 0), 1.0).otherwise(F.greatest(F.cos(F.radians(low)), F.cos(F.radians(low + width))))
    return F.greatest(F.floor(widest * (360.0 / width)), F.lit(1))


def patch_count(width: float = WIDTH) -> int:
    """Patches of the whole sphere."""
    total = 0
    for low in (b * width - 90.0 for b in range(int(180 / width))):
        widest = 1.0 if low <= 0 <= low + width else max(math.cos(math.radians(low)), math.cos(math.radians(low + width)))
        total += max(1, math.floor(widest * (360.0 / width)))
    return total


def _band(dec: Column, width: float) -> Column:
    return F.greatest(F.least(F.floor((dec + 90.0) / width), F.lit(int(180 / width) - 1)), F.lit(0))


def patch(ra: str, dec: str, width: float = WIDTH) -> Column:
    """Number of the patch a position lies in."""
    band = _band(F.col(dec), width)
    n = _in_band(band, width)
    place = F.least(F.floor(F.pmod(F.col(ra), F.lit(360.0)) / 360.0 * n), n - 1)
    return (band * 1000 + place).cast("long")


def patches_within(df: DataFrame, ra: str, dec: str, radius: Column | float, width: float = WIDTH) -> DataFrame:
    """The distinct patches (`patch`) that lie within `radius` degrees of any position."""
    reach = (radius if isinstance(radius, Column) else F.lit(float(radius))) + _PAD
    spots = df.select(F.pmod(F.col(ra), F.lit(360.0)).alias("_ra"), F.col(dec).alias("_dec"), reach.alias("_reach"))
    bands = spots.withColumn("_band", F.explode(F.sequence(_band(F.col("_dec") - F.col("_reach"), width), _band(F.col("_dec") + F.col("_reach"), width))))
    # A circle that holds a pole meets all patches of its bands, others reach asin(sin r / cos dec) in RA.
    turn = F.try_divide(F.sin(F.radians("_reach")), F.cos(F.radians("_dec")))
    half = F.when(F.abs("_dec") + F.col("_reach") >= 90.0, 180.0).otherwise(F.degrees(F.asin(F.least(turn, F.lit(1.0)))) + _PAD)
    sized = bands.withColumns({"_n": _in_band(F.col("_band"), width), "_half": half})
    first = F.floor((F.col("_ra") - F.col("_half")) / 360.0 * F.col("_n"))
    last = F.floor((F.col("_ra") + F.col("_half")) / 360.0 * F.col("_n"))
    places = sized.select("_band", "_n", F.explode(F.sequence(first, F.least(last, first + F.col("_n") - 1))).alias("_place"))
    return places.select((F.col("_band") * 1000 + F.pmod("_place", F.col("_n"))).cast("long").alias("patch")).distinct()


def patch_list(patches: DataFrame, column: str = "patch") -> list[int]:
    """Distinct patches on the driver: `patch_count()` numbers at most."""
    return sorted(r[0] for r in patches.select(column).distinct().collect())
