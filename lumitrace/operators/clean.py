"""From catalogue rows to measurements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumitrace.functions.fluxes import joint_error, position_weight, with_condon_errors
from lumitrace.functions.naming import measurement_name
from lumitrace.functions.sky import error_radius
from lumitrace.operators.ranking import with_group_values
from lumitrace.settings import ARCSEC_PER_DEG, FLUX_MIN_ERROR, POSITION_MIN_ERROR, RunSettings

# A component must be wider than this many arcsec per degree of beam.
MIN_SIZE_PER_BEAM = 500


def duplicate_components(rows: DataFrame) -> DataFrame:
    """Component ids that occur more than once in an image."""
    return rows.groupBy("image_id", "component_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def drop_unrealistic(rows: DataFrame) -> DataFrame:
    """Rows with a zero axis or flux are no detections."""
    return rows.filter("NOT (bmaj = 0 OR bmin = 0 OR flux_peak = 0 OR flux_int = 0)")


def drop_tiny(rows: DataFrame) -> DataFrame:
    """Rows must be wider than about a seventh of the beam on both axes (`beam_*` in degrees)."""
    return rows.filter((F.col("bmaj") > F.col("beam_bmaj") * MIN_SIZE_PER_BEAM) & (F.col("bmin") > F.col("beam_bmin") * MIN_SIZE_PER_BEAM))


def with_floors(rows: DataFrame, rms_fill: float) -> DataFrame:
    """Smallest errors, position errors in degrees, noise 0 replaced."""
    changes = {c: F.greatest(F.col(c), F.lit(FLUX_MIN_ERROR)) for c in ("flux_int_err", "flux_peak_err")}
    changes |= {c: F.greatest(F.col(c), F.lit(POSITION_MIN_ERROR)) / ARCSEC_PER_DEG for c in ("ra_err", "dec_err")}
    changes["local_rms"] = F.when(F.col("local_rms") == 0, F.lit(rms_fill)).otherwise(F.col("local_rms"))
    return rows.withColumns(changes)


def with_ratios(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "snr": F.try_divide("flux_peak", "local_rms"),
            "compactness": F.try_divide("flux_int", "flux_peak"),
        }
    )


def with_position_errors(rows: DataFrame, ra_uncertainty: float, dec_uncertainty: float) -> DataFrame:
    """Systematic (arcsec) and statistical position errors joined, and their weights."""
    rows = rows.withColumns(
        {
            "ew_sys_err": F.lit(ra_uncertainty / ARCSEC_PER_DEG),
            "ns_sys_err": F.lit(dec_uncertainty / ARCSEC_PER_DEG),
            "error_radius": error_radius("ra", "ra_err", "dec", "dec_err"),
        }
    )
    rows = rows.withColumns(
        {
            "uncertainty_ew": F.hypot("ew_sys_err", "error_radius"),
            "uncertainty_ns": F.hypot("ns_sys_err", "error_radius"),
        }
    )
    return rows.withColumns({"weight_ew": position_weight("uncertainty_ew"), "weight_ns": position_weight("uncertainty_ns")})


def with_island_ratios(rows: DataFrame) -> DataFrame:
    """Share of each component in the flux of its island."""
    rows = with_group_values(rows, ["image_id", "island_id"], _int=F.sum("flux_int"), _peak=F.sum("flux_peak"))
    return rows.withColumns(
        {
            "flux_int_isl_ratio": F.try_divide("flux_int", "_int"),
            "flux_peak_isl_ratio": F.try_divide("flux_peak", "_peak"),
        }
    ).drop("_int", "_peak")


def with_flux_fraction(rows: DataFrame, fraction: float) -> DataFrame:
    """Fractional flux error added in quadrature, when there is one."""
    if fraction == 0:
        return rows
    return rows.withColumns({f"{c}_err": joint_error(f"{c}_err", F.lit(fraction), c) for c in ("flux_int", "flux_peak")})


def clean_components(rows: DataFrame, images: DataFrame, settings: RunSettings, check_duplicates: bool = True) -> DataFrame:
    """Measurements of the given images.

    `rows` carries image_id and the catalogue columns; `images` image_id,
    name, datetime, beam_bmaj, beam_bmin (degrees). With `check_duplicates` a
    repeated component id raises before any row is returned.
    """
    if check_duplicates and not duplicate_components(rows).isEmpty():
        raise ValueError("a catalogue holds the same component id twice")
    info = images.select("image_id", F.col("name").alias("_image_name"), F.col("datetime").alias("time"), "beam_bmaj", "beam_bmin")
    rows = drop_tiny(drop_unrealistic(rows).join(info, "image_id"))
    rows = rows.withColumn("name", measurement_name("_image_name", "component_id"))
    rows = with_ratios(with_floors(rows, settings.local_rms_fill_value))
    if settings.condon_errors:
        rows = with_condon_errors(rows)
    rows = with_position_errors(rows, settings.ra_uncertainty, settings.dec_uncertainty)
    rows = with_island_ratios(rows).withColumn("forced", F.lit(False))
    return rows.drop("beam_bmaj", "beam_bmin", "_image_name")
