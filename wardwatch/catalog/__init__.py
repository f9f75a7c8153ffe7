"""Registered queries and, next to each, the same question in plain SQL for checking."""

from __future__ import annotations

from wardwatch.catalog import alerts, chains, history, metrics, quality, streams, vitals  # noqa: F401
from wardwatch.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
