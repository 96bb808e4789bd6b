"""All registered queries."""

from __future__ import annotations

from ticklake.plans import (  # noqa: F401  (importing registers)
    backlog_queries,
    config_queries,
    quality_queries,
    snapshot_queries,
    stream_queries,
    table_queries,
)
from ticklake.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
