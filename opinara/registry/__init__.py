"""Registered queries by name, with the SQL that gives the same rows where there is one.

Each module registers the queries of one stage; importing this package loads them all.
"""

from opinara.registry.core import ORACLES, PLAIN, QUERIES  # noqa: F401
from opinara.registry import (  # noqa: F401  isort: skip
    collection, text, sentiment, topics, warehouse, reports, kpis,
)
