"""Every query by name, with the SQL that must give the same rows."""

from __future__ import annotations

from .core import ORACLES, QUERIES
from . import aggregates, cleaning, filters, latest, panels, scans, sinks, streams  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
