"""Run settings and fixed values."""

from __future__ import annotations

from dataclasses import dataclass, replace

ARCSEC_PER_DEG = 3600.0

# Default run settings.
DEFAULTS = {
    "monitor": False,
    "monitor_min_sigma": 3.0,
    "monitor_edge_buffer": 1.2,
    "ra_uncertainty": 1.0,
    "dec_uncertainty": 1.0,
    "method": "basic",
    "radius": 10.0,
    "deruiter_radius": 5.68,
    "beamwidth_limit": 1.5,
    "epoch_duplicate_radius": 2.5,
    "new_source_min_sigma": 5.0,
    "flux_fractional_error": 0.0,
    "condon_errors": True,
    "local_rms_fill_value": 0.2,
    "pair_metrics": True,
    "min_abs_vs": 4.3,
}

# Lowest errors a catalogue row may have (mJy, arcsec).
FLUX_MIN_ERROR = 0.001
POSITION_MIN_ERROR = 0.01

# Two-epoch pairs drawn as candidate edges.
PAIR_EDGE_MIN_ABS_M = 0.26
PAIR_EDGE_MIN_ABS_VS = 4.3

# Association methods.
METHODS = ("basic", "advanced", "deruiter")


@dataclass(frozen=True)
class RunSettings:
    """Settings of one run. Angles are arcsec unless a name says otherwise."""

    monitor: bool = DEFAULTS["monitor"]
    monitor_min_sigma: float = DEFAULTS["monitor_min_sigma"]
    monitor_edge_buffer: float = DEFAULTS["monitor_edge_buffer"]
    ra_uncertainty: float = DEFAULTS["ra_uncertainty"]
    dec_uncertainty: float = DEFAULTS["dec_uncertainty"]
    method: str = DEFAULTS["method"]
    radius: float = DEFAULTS["radius"]
    deruiter_radius: float = DEFAULTS["deruiter_radius"]
    beamwidth_limit: float = DEFAULTS["beamwidth_limit"]
    epoch_duplicate_radius: float = DEFAULTS["epoch_duplicate_radius"]
    new_source_min_sigma: float = DEFAULTS["new_source_min_sigma"]
    flux_fractional_error: float = DEFAULTS["flux_fractional_error"]
    condon_errors: bool = DEFAULTS["condon_errors"]
    local_rms_fill_value: float = DEFAULTS["local_rms_fill_value"]
    pair_metrics: bool = DEFAULTS["pair_metrics"]
    min_abs_vs: float = DEFAULTS["min_abs_vs"]

    def __post_init__(self):
        if self.method not in METHODS:
            raise ValueError(f"unknown association method {self.method!r}, use one of {METHODS}")

    def with_(self, **changes) -> "RunSettings":
        return replace(self, **changes)
