"""The query catalogue: every operator wired to the analytics tables, with its SQL check."""

from __future__ import annotations

import importlib

from rillstone.plans.catalog import CATALOG, Query

SECTIONS = ["scans", "scalars", "aggregates", "event_windows", "lateral", "stateful", "streams", "jobs", "stream_jobs", "event_streams"]


def load_all() -> dict[str, Query]:
    """Import every section, which fills the catalogue."""
    for section in SECTIONS:
        importlib.import_module(f"rillstone.plans.{section}")
    return CATALOG
