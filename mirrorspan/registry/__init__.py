"""All registered queries with their oracle SQL."""

from mirrorspan.registry import checks, loads, scans, upkeep  # noqa: F401  (they register)
from mirrorspan.registry.core import ORACLES, QUERIES, Inputs

__all__ = ["ORACLES", "QUERIES", "Inputs"]
