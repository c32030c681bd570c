"""Sky cells: the equality key that turns an angular distance into a hash join.

The unit sphere is cut into cubes. Two positions within a radius r lie within
a chord c = 2 sin(r / 2), so a row that is copied into every cube its box of
half-width c touches meets all partners that are filed under one cube each.
There is no special case at the poles or at RA 0.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumitrace.functions.sky import unit_vector

# Floor of the chord (about 0.2 arcsec): keeps a search at radius 0 exact.
MIN_CHORD = 1e-6
# Room for the rounding of the unit vectors.
_MARGIN = 1e-12

CELL_KEYS = ["_cx", "_cy", "_cz"]


def chord(radius_deg: float) -> float:
    """Chord of an angle on the unit sphere, never below the floor."""
    radius = math.radians(min(max(radius_deg, 0.0), 180.0))
    return max(2 * math.sin(radius / 2) * (1 + 1e-9) + _MARGIN, MIN_CHORD)


def cell_size(radius_deg: float, chords: int = 4) -> float:
    """Cube edge for a search radius, in chords of it.

    At four times the chord a ball around a row touches about two of the cubes
    that the sphere passes through, against eight at twice the chord.
    """
    return chords * chord(radius_deg)


def with_cell(df: DataFrame, ra: str, dec: str, size: float) -> DataFrame:
    """The one cube each row lies in."""
    axes = unit_vector(ra, dec)
    return df.withColumns({key: F.floor(axis / size) for key, axis in zip(CELL_KEYS, axes)})


def with_cells_touched(df: DataFrame, ra: str, dec: str, size, reach, near_only: bool = False) -> DataFrame:
    """One copy of each row per cube that its box of half-width `reach` touches.

    `reach` is a chord, `size` the edge of the cubes: numbers, or columns that
    vary by row. With `near_only`, cubes that the sphere or the ball around
    the row cannot reach are left out.
    """
    reach = F.lit(reach) if isinstance(reach, float) else reach
    size = F.lit(size) if isinstance(size, float) else size
    places = [f"_at{key}" for key in CELL_KEYS]
    # The trigonometry is done once per row, before the row is copied.
    df = df.withColumns(dict(zip(places, unit_vector(ra, dec)))).withColumns({"_reach": reach, "_size": size})
    ways = [F.sequence(F.floor((F.col(p) - F.col("_reach")) / F.col("_size")), F.floor((F.col(p) + F.col("_reach")) / F.col("_size"))) for p in places]
    for key, way in zip(CELL_KEYS, ways):
        df = df.withColumn(key, F.explode(way))
    if near_only:
        half = F.col("_size") / 2
        middles = [(F.col(key) + 0.5) * F.col("_size") for key in CELL_KEYS]
        beyond = lambda steps: sum((F.pow(F.greatest(F.abs(step) - half, F.lit(0.0)), 2) for step in steps), F.lit(0.0))
        farthest = sum((F.pow(F.abs(m) + half, 2) for m in middles), F.lit(0.0))
        on_sphere = (beyond(middles) <= 1.0 + 1e-9) & (farthest >= 1.0 - 1e-9)
        df = df.filter((beyond([m - F.col(p) for m, p in zip(middles, places)]) <= F.col("_reach") * F.col("_reach") * (1 + 1e-9)) & on_sphere)
    return df.drop(*places, "_reach", "_size")


def fullest_cell(df: DataFrame, ra: str, dec: str, size: float, by: tuple[str, ...] = ()) -> int:
    """Rows in the most crowded cube; only this one number reaches the driver."""
    counts = with_cell(df, ra, dec, size).groupBy(*by, *CELL_KEYS).count()
    return counts.agg(F.max("count")).first()[0] or 0
