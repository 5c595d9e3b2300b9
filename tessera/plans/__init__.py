"""Registered query plans over the driver tables.

Importing this package registers every query module; see
:mod:`tessera.plans.registry`.
"""

from tessera.plans import (  # noqa: F401
    alert_queries,
    analytics_queries,
    dependency_queries,
    history_queries,
    jobs,
    layout_queries,
    metrics_queries,
    profile_queries,
    quality_queries,
    sketch_queries,
    stream_queries,
    transform_queries,
    versioned_queries,
)
from tessera.plans.registry import ORACLE, QUERIES, table

FLAGSHIP = "dq_report"

__all__ = ["ORACLE", "QUERIES", "table"]
