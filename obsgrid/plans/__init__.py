"""Registered queries over the given tables, each with its SQL counterpart where one exists."""

from obsgrid.plans import observations, payloads, profiles, quality, refresh  # noqa: F401
from obsgrid.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
