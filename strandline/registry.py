"""All queries over the driver's tables, with the SQL that must give the same rows."""

from __future__ import annotations

from .catalog import choices, rasters, series, shapes, space, tides, zones

_PARTS = [series, space, tides, rasters, shapes, zones, choices]
QUERIES: dict = {k: v for part in _PARTS for k, v in part.QUERIES.items()}
SQL: dict = {k: v for part in _PARTS for k, v in part.SQL.items()}
