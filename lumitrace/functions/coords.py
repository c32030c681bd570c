"""Sexagesimal strings, position names and coordinate parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumitrace.functions.sky import _col

# Seconds are handled as whole numbers of 1e-8 s, so rounding and truncating
# are exact and a value such as 59.999... carries into the minutes.
_DIGITS = 8


def _parts(magnitude_deg: Column, precision: int, truncate: bool):
    """Leading unit, minutes, seconds and decimals as whole numbers."""
    precision = min(max(precision, 0), _DIGITS)
    unit = 10 ** (_DIGITS - precision)
    fine = F.floor(magnitude_deg * F.lit(3600.0 * 10**_DIGITS) + 0.5)
    kept = F.floor((fine if truncate else fine + unit // 2) / unit)
    frac = F.pmod(kept, F.lit(10**precision))
    whole = F.floor(kept / 10**precision)
    minutes = F.floor(whole / 60)
    return F.floor(minutes / 60), F.pmod(minutes, F.lit(60)), F.pmod(whole, F.lit(60)), frac, precision


def _render(parts, marks) -> Column:
    first, minute, sec, frac, precision = parts
    two = lambda c: F.format_string("%02d", c)
    pieces = [two(first), F.lit(marks[0]), two(minute), F.lit(marks[1]), two(sec)]
    if precision:
        pieces += [F.lit("."), F.format_string(f"%0{precision}d", frac)]
    return F.concat(*pieces, F.lit(marks[2]))


def degrees_to_dms(deg, precision: int = 2, truncate: bool = False, letters: bool = False) -> Column:
    """`+DD:MM:SS.s` (or `+DDdMMmSS.ss`) of an angle in degrees."""
    deg = _col(deg)
    marks = ("d", "m", "s") if letters else (":", ":", "")
    sign = F.when(deg < 0, F.lit("-")).otherwise(F.lit("+"))
    return F.concat(sign, _render(_parts(F.abs(deg), precision, truncate), marks))


def degrees_to_hms(deg, precision: int = 2, truncate: bool = False, letters: bool = False) -> Column:
    """`HH:MM:SS.s` (or `HHhMMmSS.ss`) of an angle in degrees."""
    marks = ("h", "m", "s") if letters else (":", ":", "")
    hours = F.pmod(_col(deg), F.lit(360.0)) / 15.0
    return _render(_parts(hours, precision, truncate), marks)


def position_name(ra, dec) -> Column:
    """IAU style name: `J` + HHMMSS.s + sign + DDMMSS, truncated."""
    text = F.concat(F.lit("J"), degrees_to_hms(ra, 1, True), degrees_to_dms(dec, 0, True))
    return F.replace(text, F.lit(":"), F.lit(""))


_SEXAGESIMAL = r"^([+-]?)(\d+)(?:[:dh]|\s)(\d+)(?:(?:[:m]|\s)(\d+(?:\.\d*)?)s?)?m?$"
_DECIMAL = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"
_DECIMAL_UNIT = r"^([+-]?(?:\d+\.?\d*|\.\d+))([dh])$"


def angle_to_degrees(text, sexagesimal_hours: bool) -> Column:
    """Degrees of one angle string; NULL when it cannot be read.

    Decimals are degrees. `h` or `d` marks win over the default; otherwise a
    sexagesimal value is hours when `sexagesimal_hours`, else degrees.
    """
    t = F.trim(_col(text))
    sign = F.when(F.regexp_extract(t, _SEXAGESIMAL, 1) == "-", F.lit(-1.0)).otherwise(F.lit(1.0))
    group = lambda i: F.coalesce(F.regexp_extract(t, _SEXAGESIMAL, i).try_cast("double"), F.lit(0.0))
    value = sign * (group(2) + group(3) / 60.0 + group(4) / 3600.0)
    in_hours = t.contains("h") | (F.lit(sexagesimal_hours) & ~t.contains("d"))
    sexagesimal = F.when(in_hours, value * 15.0).otherwise(value)
    marked = F.regexp_extract(t, _DECIMAL_UNIT, 1).try_cast("double")
    marked = F.when(F.regexp_extract(t, _DECIMAL_UNIT, 2) == "h", marked * 15.0).otherwise(marked)
    valid = (group(3) < 60) & (group(4) < 60)
    return (
        F.when(t.rlike(_DECIMAL), t.try_cast("double"))
        .when(t.rlike(_DECIMAL_UNIT), marked)
        .when(t.rlike(_SEXAGESIMAL) & valid, sexagesimal)
    )


def parse_position(text, frame: str = "icrs") -> tuple[Column, Column]:
    """(longitude, latitude) in degrees of a two-part or six-part position string.

    Six bare numbers are degrees, minutes, seconds of both parts, since every
    part reads as a decimal. In the galactic frame both parts are degrees.
    """
    words = F.split(F.trim(_col(text)), r"\s+")
    six = F.size(words) == 6
    first = F.when(six, F.concat_ws(":", F.slice(words, 1, 3))).when(F.size(words) == 2, F.get(words, F.lit(0)))
    second = F.when(six, F.concat_ws(":", F.slice(words, 4, 3))).when(F.size(words) == 2, F.get(words, F.lit(1)))
    hours = angle_to_degrees(first, frame != "galactic")
    degrees = angle_to_degrees(first, False)
    lon = F.when(six, degrees).otherwise(hours)
    lat = angle_to_degrees(second, False)
    ok = lon.isNotNull() & lat.isNotNull() & (F.abs(lat) <= 90)
    return F.when(ok, F.pmod(lon, F.lit(360.0))), F.when(ok, lat)


def path_right_ascension(text) -> Column:
    """RA of a URL part: with `:` it is an hour angle, else decimal degrees."""
    return angle_to_degrees(text, True)


def path_declination(text) -> Column:
    """Declination of a URL part, always degrees."""
    return angle_to_degrees(text, False)


# Angle suffixes and their size in degrees.
ANGLE_SUFFIXES = {"arcsec": 1 / 3600.0, "arcmin": 1 / 60.0, "deg": 1.0}


def path_angle(text) -> Column:
    """Degrees of `<number><unit>` such as `90arcsec`; NULL for other text."""
    t = F.trim(_col(text))
    pattern = r"^(\d+(?:\.\d+)?)\s?(arcsec|arcmin|deg)$"
    number = F.regexp_extract(t, pattern, 1).try_cast("double")
    unit = F.regexp_extract(t, pattern, 2)
    out = None
    for name, size in ANGLE_SUFFIXES.items():
        out = F.when(unit == name, number * size) if out is None else out.when(unit == name, number * size)
    return out
