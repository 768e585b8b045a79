"""All registered queries and their DuckDB counterparts."""

from __future__ import annotations

from . import clone_queries, report_queries, sequence_queries, source_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
