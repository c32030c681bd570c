"""Flux, error and variability formulas as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumitrace.functions.sky import _col


def vs_metric(flux_a, flux_b, err_a, err_b) -> Column:
    """Two-epoch t-statistic (a - b) / hypot(err_a, err_b)."""
    return F.try_divide(_col(flux_a) - _col(flux_b), F.hypot(_col(err_a), _col(err_b)))


def m_metric(flux_a, flux_b) -> Column:
    """Two-epoch modulation index 2 (a - b) / (a + b)."""
    return F.try_divide(2 * (_col(flux_a) - _col(flux_b)), _col(flux_a) + _col(flux_b))


def joint_error(err, fraction, flux) -> Column:
    """Error with a fractional flux error added in quadrature."""
    return F.hypot(_col(err), _col(fraction) * _col(flux))


def position_weight(uncertainty) -> Column:
    return F.try_divide(F.lit(1.0), _col(uncertainty) * _col(uncertainty))


def with_condon_errors(df: DataFrame) -> DataFrame:
    """Gaussian fit errors after Condon (1997), replacing those of the catalogue.

    Reads flux_peak, flux_int, bmaj and bmin (arcsec), pa, snr, local_rms and
    the beam beam_bmaj, beam_bmin (degrees). All seven errors are 0 when any
    of them but pa is 0.

    The shared terms are columns of their own: as one expression per error
    they would be worked out again for each.
    """
    names = df.columns
    col = F.col
    zero = F.lit(False)
    for name in ("beam_bmaj", "beam_bmin", "bmaj", "bmin", "flux_peak", "flux_int", "snr", "local_rms"):
        zero = zero | (col(name) == 0)
    # Degenerate rows carry NULL through the formulas and end as 0.
    df = df.withColumns({"_zero": zero, "_major": F.when(~zero, col("bmaj") / 3600.0), "_minor": F.when(~zero, col("bmin") / 3600.0)})
    df = df.withColumns(
        {
            "_amp": F.sqrt(F.try_divide(col("_major") * col("_minor"), 4 * col("beam_bmaj") * col("beam_bmin"))) * F.abs("snr"),
            "_ratio_major": F.sqrt(1 + F.pow(F.try_divide("beam_bmaj", "_major"), F.lit(2.0))),
            "_ratio_minor": F.sqrt(1 + F.pow(F.try_divide("beam_bmin", "_minor"), F.lit(2.0))),
        }
    )

    def rho(on_major: float, on_minor: float) -> Column:
        return col("_amp") * F.pow("_ratio_major", F.lit(on_major)) * F.pow("_ratio_minor", F.lit(on_minor))

    df = df.withColumns({"_rho1": rho(2.5, 0.5), "_rho2": rho(0.5, 2.5), "_rho3": rho(1.5, 1.5)})
    fwhm = math.sqrt(4 * math.log(2))
    # Relative errors of both axes and of the peak.
    df = df.withColumns(
        {
            "_err_major": math.sqrt(2) / col("_rho1"),
            "_err_minor": math.sqrt(2) / col("_rho2"),
            "_err_peak": math.sqrt(2) / col("_rho3"),
            "_along": col("_major") / (fwhm * col("_rho1")),
            "_across": col("_minor") / (fwhm * col("_rho2")),
            "_sin": F.sin(F.radians("pa")),
            "_cos": F.cos(F.radians("pa")),
        }
    )
    tilt = F.try_divide(2 * col("_major") * col("_minor"), col("_major") * col("_major") - col("_minor") * col("_minor")) / col("_rho2")
    beams = F.try_divide(col("beam_bmaj") * col("beam_bmin"), col("_major") * col("_minor"))
    spread = col("_err_major") * col("_err_major") + col("_err_minor") * col("_err_minor")
    errors = {
        "flux_peak_err": F.abs("flux_peak") * col("_err_peak"),
        "flux_int_err": F.abs("flux_int") * F.sqrt(col("_err_peak") * col("_err_peak") + beams * spread),
        "err_bmaj": col("_major") * col("_err_major"),
        "err_bmin": col("_minor") * col("_err_minor"),
        "err_pa": F.when(col("_major") > col("_minor"), F.least(tilt, F.lit(math.pi))).otherwise(math.pi),
        "ra_err": F.hypot(col("_along") * col("_sin"), col("_across") * col("_cos")),
        "dec_err": F.hypot(col("_along") * col("_cos"), col("_across") * col("_sin")),
    }
    errors = {name: F.when(col("_zero"), F.lit(0.0)).otherwise(value) for name, value in errors.items()}
    added = [name for name in errors if name not in names]
    return df.withColumns(errors).select(*names, *added)
