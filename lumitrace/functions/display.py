"""Scaling and rounding of columns for display, and narrow export types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Display digits and scale of each float column.
DISPLAY = {
    "ra": (4, 1.0),
    "ra_err": (4, 3600.0),
    "uncertainty_ew": (4, 3600.0),
    "dec": (4, 1.0),
    "dec_err": (4, 3600.0),
    "uncertainty_ns": (4, 3600.0),
    "flux_int": (3, 1.0),
    "flux_peak": (3, 1.0),
    "flux_int_err": (3, 1.0),
    "flux_peak_err": (3, 1.0),
    "v_int": (2, 1.0),
    "eta_int": (2, 1.0),
    "v_peak": (2, 1.0),
    "eta_peak": (2, 1.0),
    "avg_flux_int": (3, 1.0),
    "avg_flux_peak": (3, 1.0),
    "max_flux_peak": (3, 1.0),
    "min_flux_peak": (3, 1.0),
    "min_flux_int": (3, 1.0),
    "max_flux_int": (3, 1.0),
    "min_flux_int_isl_ratio": (2, 1.0),
    "min_flux_peak_isl_ratio": (2, 1.0),
    "flux_peak_isl_ratio": (2, 1.0),
    "flux_int_isl_ratio": (2, 1.0),
    "rms_median": (3, 1.0),
    "rms_min": (3, 1.0),
    "rms_max": (3, 1.0),
    "new_high_sigma": (3, 1.0),
    "compactness": (3, 1.0),
    "avg_compactness": (2, 1.0),
    "n_neighbour_dist": (2, 60.0),
    "snr": (2, 1.0),
    "min_snr": (2, 1.0),
    "max_snr": (2, 1.0),
    "beam_bmaj": (2, 3600.0),
    "beam_bmin": (2, 3600.0),
    "beam_bpa": (2, 1.0),
    "frequency": (2, 1.0),
    "vs_abs_significant_max_int": (2, 1.0),
    "vs_abs_significant_max_peak": (2, 1.0),
    "m_abs_significant_max_int": (2, 1.0),
    "m_abs_significant_max_peak": (2, 1.0),
}


def round_to(value: Column, digits: int) -> Column:
    """Half-up rounding that two engines agree on bit for bit."""
    scale = float(10**digits)
    return F.floor(value * scale + 0.5).cast("double") / F.lit(scale)


def for_display(df: DataFrame) -> DataFrame:
    """Every known float column scaled and rounded; other columns unchanged."""
    out = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if field.name in DISPLAY and isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            digits, scale = DISPLAY[field.name]
            column = round_to(column * scale, digits).alias(field.name)
        out.append(column)
    return df.select(*out)


def narrow_floats(df: DataFrame) -> DataFrame:
    """Double columns as float, the type of exported tables."""
    return df.select(
        *[F.col(f.name).cast("float").alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name) for f in df.schema.fields]
    )


def narrow_ints(df: DataFrame) -> DataFrame:
    """Long columns in the smallest integer type that holds their values.

    One aggregation over the table finds the ranges; only two numbers per
    column reach the driver.
    """
    longs = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.LongType, T.IntegerType))]
    if not longs:
        return df
    bounds = df.agg(*[F.min(c).alias(f"lo_{c}") for c in longs], *[F.max(c).alias(f"hi_{c}") for c in longs]).first()
    targets = {}
    for c in longs:
        lo, hi = bounds[f"lo_{c}"], bounds[f"hi_{c}"]
        targets[c] = smallest_integer_type(lo, hi)
    return df.select(*[F.col(c).cast(targets[c]).alias(c) if c in targets else F.col(c) for c in df.columns])


def smallest_integer_type(lo: int | None, hi: int | None) -> str:
    for name, bits in (("tinyint", 8), ("smallint", 16), ("int", 32)):
        top = 2 ** (bits - 1)
        if lo is None or (-top <= lo and hi < top):
            return name
    return "bigint"
