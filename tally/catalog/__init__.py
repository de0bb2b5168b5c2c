"""All registered queries with their checks."""

from tally.catalog import aggregating, basics, live, night, ordering, reshaping, results, storage, streams  # noqa: F401
from tally.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
