"""Forced measurements: where to take them, and how a fit becomes a measurement."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumitrace.functions.naming import component_of_island, forced_name, island_number, island_prefix
from lumitrace.operators.coverage import with_detection_flux
from lumitrace.operators.ranking import number_within
from lumitrace.settings import ARCSEC_PER_DEG, POSITION_MIN_ERROR, RunSettings


def forced_candidates(missing: DataFrame, detections: DataFrame, images: DataFrame, min_sigma: float) -> DataFrame:
    """Missing images whose best noise could show the source above `min_sigma`."""
    rows = with_detection_flux(missing, detections).join(images.select("image_id", "rms_min"), "image_id")
    kept = rows.withColumn("max_snr", F.try_divide("flux_peak", "rms_min")).filter(F.col("max_snr") > min_sigma)
    return kept.select("source", "image_id", "wavg_ra", "wavg_dec", "flux_peak", "max_snr")


def candidates_when_adding(missing: DataFrame, done_images: DataFrame, done_sources: DataFrame) -> DataFrame:
    """Only what an earlier run did not extract: new images, and new sources in old images.

    `done_images` has image_id, `done_sources` source.
    """
    in_new = missing.join(done_images, "image_id", "left_anti")
    in_old = missing.join(done_images, "image_id", "left_semi").join(done_sources, "source", "left_anti")
    return in_new.unionByName(in_old)


def clean_fits(fits: DataFrame) -> DataFrame:
    """Usable fits in mJy: flux or error 0 or missing, and infinite chi-square, drop out.

    `fits` has source, image_id, flux, flux_err (Jy), chi2.
    """
    mjy = lambda c: F.coalesce(F.nanvl(F.col(c) * 1000.0, F.lit(0.0)), F.lit(0.0))
    rows = fits.select("source", "image_id", mjy("flux").alias("flux_int"), mjy("flux_err").alias("flux_int_err"), F.col("chi2").alias("chi_squared_fit"))
    return rows.filter((F.col("flux_int") != 0) & (F.col("flux_int_err") != 0) & ~F.coalesce(F.col("chi_squared_fit") == float("inf"), F.lit(False)))


def island_maxima(measurements: DataFrame, images: DataFrame) -> DataFrame:
    """Prefix and next free number of island ids per image; `island_` and 1 for an empty image."""
    found = measurements.groupBy("image_id").agg(
        (F.max(island_number("island_id")) + 1).alias("_next"), F.min(island_prefix("island_id")).alias("_prefix")
    )
    joined = images.select("image_id").join(found, "image_id", "left")
    return joined.select("image_id", F.coalesce("_prefix", F.lit("island_")).alias("prefix"), F.coalesce("_next", F.lit(1)).cast("long").alias("max_id"))


def complete_forced(fits: DataFrame, positions: DataFrame, images: DataFrame, islands: DataFrame, settings: RunSettings, run_id: int) -> DataFrame:
    """Full measurement rows of usable fits.

    `positions` has source, wavg_ra, wavg_dec; `islands` comes from
    `island_maxima`; `images` adds the beam and time.
    """
    numbered = number_within(fits, "image_id", ["source"], "_seq")
    info = images.select("image_id", F.col("datetime").alias("time"), "beam_bmaj", "beam_bmin", "beam_bpa")
    spots = positions.select("source", F.col("wavg_ra").alias("ra"), F.col("wavg_dec").alias("dec"))
    rows = numbered.join(islands, "image_id").join(info, "image_id").join(spots, "source")
    pos_err = POSITION_MIN_ERROR / ARCSEC_PER_DEG
    sys_ew, sys_ns = settings.ra_uncertainty / ARCSEC_PER_DEG, settings.dec_uncertainty / ARCSEC_PER_DEG
    unc_ew, unc_ns = math.hypot(sys_ew, pos_err), math.hypot(sys_ns, pos_err)
    rows = rows.withColumn("island_id", F.concat("prefix", (F.col("max_id") + F.col("_seq")).cast("string")))
    rows = rows.withColumn("component_id", component_of_island("island_id"))
    number = lambda v: F.lit(float(v))
    columns = {
        "name": forced_name(F.col("component_id"), run_id),
        "bmaj": F.col("beam_bmaj") * ARCSEC_PER_DEG,
        "bmin": F.col("beam_bmin") * ARCSEC_PER_DEG,
        "pa": F.col("beam_bpa"),
        "ra_err": number(pos_err),
        "dec_err": number(pos_err),
        "err_bmaj": number(0),
        "err_bmin": number(0),
        "err_pa": number(0),
        "ew_sys_err": number(sys_ew),
        "ns_sys_err": number(sys_ns),
        "error_radius": number(0),
        "uncertainty_ew": number(unc_ew),
        "uncertainty_ns": number(unc_ns),
        "weight_ew": number(1 / unc_ew**2),
        "weight_ns": number(1 / unc_ns**2),
        "flux_peak": F.col("flux_int"),
        "flux_peak_err": F.col("flux_int_err"),
        "local_rms": F.col("flux_int_err"),
        "snr": F.col("flux_int") / F.col("flux_int_err"),
        "spectral_index": number(0),
        "d2d": number(0),
        "dr": number(0),
        "forced": F.lit(True),
        "compactness": number(1),
        "psf_bmaj": F.col("beam_bmaj") * ARCSEC_PER_DEG,
        "psf_bmin": F.col("beam_bmin") * ARCSEC_PER_DEG,
        "psf_pa": F.col("beam_bpa"),
        "flag_c4": F.lit(False),
        "spectral_index_from_TT": F.lit(False),
        "has_siblings": F.lit(False),
        "flux_int_isl_ratio": number(1),
        "flux_peak_isl_ratio": number(1),
    }
    return rows.withColumns(columns).drop("prefix", "max_id", "_seq", "beam_bmaj", "beam_bmin", "beam_bpa")


def append_forced(rows: DataFrame, forced: DataFrame) -> DataFrame:
    """Forced rows added to a table, limited to the table's columns."""
    shared = [c for c in forced.columns if c in rows.columns]
    return rows.unionByName(forced.select(*shared), allowMissingColumns=True)


def remove_forced(measurements: DataFrame, associations: DataFrame, run_sources: DataFrame) -> DataFrame:
    """Measurements without the forced ones that belong to the sources of a run.

    `associations` has source, meas_id; `run_sources` source.
    """
    of_run = associations.join(run_sources, "source", "left_semi").select(F.col("meas_id").alias("id"))
    forced = measurements.filter("forced").select("id").join(of_run, "id", "left_semi")
    return measurements.join(forced, "id", "left_anti")
