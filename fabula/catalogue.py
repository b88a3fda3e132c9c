"""All queries of the engine by name, and their SQL."""

from __future__ import annotations

from fabula.plans import classes, discovery, evaluation, joins, ledger, markup, ordered, pairs, rates, records, selection, sources, storage, texts  # noqa: F401  each registers its queries
from fabula.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
