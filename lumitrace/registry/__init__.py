"""Named queries over the test tables, each with the SQL it must agree with."""

from __future__ import annotations

import importlib

from lumitrace.registry.base import ORACLES, QUERIES

_MODULES = ["scalars", "cleaning", "skyjoins", "statistics", "associating", "covering", "lifecycle", "searching", "storing", "growing", "versions"]


def load() -> tuple[dict, dict]:
    for name in _MODULES:
        importlib.import_module(f"lumitrace.registry.{name}")
    return dict(QUERIES), dict(ORACLES)
