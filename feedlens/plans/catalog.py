"""Import every catalog module so that all queries are registered."""

from __future__ import annotations

from feedlens.plans import catalog_cube, catalog_distinct, catalog_engagement, catalog_experiments, catalog_forecast, catalog_power, catalog_reports, catalog_services, catalog_upkeep  # noqa: F401
from feedlens.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
