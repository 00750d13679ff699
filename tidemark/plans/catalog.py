"""Imports every query module so the registry is complete."""

from __future__ import annotations

from tidemark.plans import branch_queries, core_queries, log_queries, replica_queries, stream_queries  # noqa: F401
from tidemark.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
