"""The operators bound to the driver's tables, each with the same result stated in SQL."""

from workload import changes, commits, files, keys, ledgers, lookup, text, theses  # noqa: F401  (register queries)
from workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
