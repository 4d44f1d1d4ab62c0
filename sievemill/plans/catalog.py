"""All queries over the driver's tables."""

from __future__ import annotations

from sievemill.plans import checks, curation, forms, measures, mechanics  # noqa: F401  they register their queries
from sievemill.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
