"""All registered queries."""

from __future__ import annotations

from . import q_commits, q_export, q_files, q_functions, q_log, q_staging, q_sync, q_tables
from .base import ORACLES, QUERIES, Query

__all__ = ["q_commits", "q_export", "q_files", "q_functions", "q_log", "q_staging", "q_sync", "q_tables", "queries", "oracles"]


def queries() -> dict[str, Query]:
    return dict(sorted(QUERIES.items()))


def oracles() -> dict[str, str]:
    return dict(sorted(ORACLES.items()))
