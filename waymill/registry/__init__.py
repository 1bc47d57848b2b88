"""The checked queries: each runs library operators over the test tables.

``QUERIES`` maps a name to ``(spark, folder) -> DataFrame``, ``ORACLES`` the same
name to SQL with the same result.
"""

from . import fares, incremental, jobs, lookups, nested, operations, quality, storing

_PARTS = (fares, lookups, nested, operations, incremental, quality, storing, jobs)

QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
