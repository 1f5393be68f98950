"""All queries of the library, and the SQL of those that DuckDB can check."""

from granary.plans import books, calls, models, sources  # noqa: F401 - they register their queries
from granary.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
