"""Sky geometry as column expressions. Angles are degrees unless named otherwise."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rotation from ICRS to galactic axes (FK5 J2000 pole, with the ICRS to FK5 offset).
GALACTIC_ROTATION = (
    (-0.0548756577125917, -0.8734370519556163, -0.4838350736167155),
    (0.4941094371927275, -0.44482972122329534, 0.7469821839866675),
    (-0.8676661375596588, -0.19807633727300059, 0.4559838136873017),
)

# Rounding of a separation in degrees, far below that of a stored position: a row on the edge of a cone is in it.
EDGE_DEG = 1e-12
# Radius units, as units per degree.
UNITS_PER_DEG = {"arcsec": 3600.0, "arcmin": 60.0, "deg": 1.0}


def _col(value) -> Column:
    """A column name, a number or a column, as a column."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.col(value)
    return F.lit(float(value))


def to_degrees(value, unit: str) -> Column:
    return _col(value) / F.lit(UNITS_PER_DEG[unit])


def from_degrees(value, unit: str) -> Column:
    return _col(value) * F.lit(UNITS_PER_DEG[unit])


def unit_vector(ra, dec) -> tuple[Column, Column, Column]:
    """Cartesian position on the unit sphere."""
    a, d = F.radians(_col(ra)), F.radians(_col(dec))
    return F.cos(d) * F.cos(a), F.cos(d) * F.sin(a), F.sin(d)


def separation(ra1, dec1, ra2, dec2) -> Column:
    """On-sky separation in degrees (haversine, exact down to micro-arcsec)."""
    d1, d2 = F.radians(_col(dec1)), F.radians(_col(dec2))
    half_dec = F.sin((d1 - d2) / 2)
    half_ra = F.sin(F.radians(_col(ra1) - _col(ra2)) / 2)
    h = half_dec * half_dec + F.cos(d1) * F.cos(d2) * half_ra * half_ra
    return F.degrees(2 * F.asin(F.sqrt(F.least(F.lit(1.0), h))))


def separation_arccos(ra1, dec1, ra2, dec2) -> Column:
    """Separation in radians by the spherical law of cosines, argument clipped at 1."""
    d1, d2 = F.radians(_col(dec1)), F.radians(_col(dec2))
    cosine = F.sin(d1) * F.sin(d2) + F.cos(d1) * F.cos(d2) * F.cos(F.radians(_col(ra1) - _col(ra2)))
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))


def wrap180(angle) -> Column:
    """An angle difference brought to [-180, 180)."""
    return F.pmod(_col(angle) + 180.0, F.lit(360.0)) - 180.0


def error_radius(ra, ra_err, dec, dec_err) -> Column:
    """Largest separation from a position to the four corners of its error box, degrees.

    Corners east and west of the position are equally far, so two are enough.
    """
    ra, dec = _col(ra), _col(dec)
    east = ra + _col(ra_err)
    north = separation_arccos(ra, dec, east, dec + _col(dec_err))
    south = separation_arccos(ra, dec, east, dec - _col(dec_err))
    return F.degrees(F.greatest(north, south))


def de_ruiter(ra1, dec1, ew1, ns1, ra2, dec2, ew2, ns2) -> Column:
    """Dimensionless distance of two positions in units of their joint errors.

    The RA difference is wrapped, so pairs across RA 0, 90 or 270 are treated
    like all others.
    """
    d_ra = F.radians(wrap180(_col(ra1) - _col(ra2)))
    d_dec = F.radians(_col(dec1) - _col(dec2))
    shrink = F.cos(F.radians((_col(dec1) + _col(dec2)) / 2))
    rad = math.pi / 180.0
    var_ra = (_col(ew1) * _col(ew1) + _col(ew2) * _col(ew2)) * (rad * rad)
    var_dec = (_col(ns1) * _col(ns1) + _col(ns2) * _col(ns2)) * (rad * rad)
    scaled = d_ra * shrink
    return F.sqrt(scaled * scaled / var_ra + d_dec * d_dec / var_dec)


def _rotate(lon, lat, matrix) -> tuple[Column, Column]:
    x, y, z = unit_vector(lon, lat)
    u, v, w = (x * r[0] + y * r[1] + z * r[2] for r in matrix)
    lon_out = F.pmod(F.degrees(F.atan2(v, u)), F.lit(360.0))
    lat_out = F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), w))))
    return lon_out, lat_out


def to_galactic(ra, dec) -> tuple[Column, Column]:
    """Galactic longitude and latitude."""
    return _rotate(ra, dec, GALACTIC_ROTATION)


def from_galactic(lon, lat) -> tuple[Column, Column]:
    """Right ascension and declination of a galactic position."""
    return _rotate(lon, lat, tuple(zip(*GALACTIC_ROTATION)))


def julian_date(ts) -> Column:
    """Julian date of a timestamp."""
    return F.unix_micros(_col(ts).cast("timestamp")) / F.lit(86400000000.0) + F.lit(2440587.5)


def tangent_pixel(ra, dec, projection, crval1, crval2, crpix1, crpix2, cdelt1, cdelt2):
    """Zero-based (row, column) of a sky position in a SIN or TAN image.

    NULL for positions on the far side of the sky and for other projections.
    """
    a, d = F.radians(_col(ra) - _col(crval1)), F.radians(_col(dec))
    d0 = F.radians(_col(crval2))
    cos_c = F.sin(d0) * F.sin(d) + F.cos(d0) * F.cos(d) * F.cos(a)
    xi = F.cos(d) * F.sin(a)
    eta = F.cos(d0) * F.sin(d) - F.sin(d0) * F.cos(d) * F.cos(a)
    stretch = F.when(_col(projection) == "SIN", F.lit(1.0)).when(_col(projection) == "TAN", 1.0 / F.nullif(cos_c, F.lit(0.0)))
    stretch = F.when(cos_c > 0, stretch)
    px = F.degrees(xi * stretch) / _col(cdelt1) + _col(crpix1) - 1.0
    py = F.degrees(eta * stretch) / _col(cdelt2) + _col(crpix2) - 1.0
    return F.floor(py + 0.5).cast("long"), F.floor(px + 0.5).cast("long")


def pixel_to_sky(px, py, projection, crval1, crval2, crpix1, crpix2, cdelt1, cdelt2):
    """Sky position (ra, dec) of a one-based pixel coordinate in a SIN or TAN image."""
    x = F.radians((_col(px) - _col(crpix1)) * _col(cdelt1))
    y = F.radians((_col(py) - _col(crpix2)) * _col(cdelt2))
    rho = F.sqrt(x * x + y * y)
    angle = F.when(_col(projection) == "SIN", F.asin(F.least(rho, F.lit(1.0)))).when(_col(projection) == "TAN", F.atan(rho))
    d0 = F.radians(_col(crval2))
    y_over_rho = F.coalesce(F.try_divide(y, rho), F.lit(0.0))
    dec = F.asin(F.cos(angle) * F.sin(d0) + y_over_rho * F.sin(angle) * F.cos(d0))
    ra = F.atan2(x * F.sin(angle), rho * F.cos(d0) * F.cos(angle) - y * F.sin(d0) * F.sin(angle))
    ra = F.when(rho == 0, F.lit(0.0)).otherwise(ra)
    return F.pmod(F.degrees(ra) + _col(crval1), F.lit(360.0)), F.degrees(dec)


def beam_pixels(bmaj_deg, pixel_scale_deg, nbeam: float = 3.0, edge_buffer: float = 1.0) -> Column:
    """Pixels to keep clear of image edges; both roundings are half-to-even."""
    half_beams = F.rint(F.lit(nbeam / 2.0) * _col(bmaj_deg) / _col(pixel_scale_deg))
    return F.rint(half_beams * F.lit(float(edge_buffer))).cast("long")
