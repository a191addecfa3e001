"""The library's queries over the driver's tables, by name, and the SQL that gives the same rows."""

from __future__ import annotations

from . import queries_checks, queries_incidents, queries_marts, queries_relational, queries_scale, queries_system, queries_warehouse  # noqa: F401
from .registry import ORACLE_SQL, QUERIES

FLAGSHIP = "metric_answer_rate_daily"

__all__ = ["FLAGSHIP", "ORACLE_SQL", "QUERIES"]
