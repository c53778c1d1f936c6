"""Every operator as a named query over the check tables, with its oracle."""

from voidage.catalog import base, joins, lookups, rollups, windows  # noqa: F401
from voidage.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
