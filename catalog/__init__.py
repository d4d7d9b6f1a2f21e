"""Queries over the given tables, one per operator, with SQL to check them by."""

from catalog import (aggregates, chains, closed_forms, columns, joins, matrix, profiles, rows,  # noqa: F401
                     step_queries, transforms)
from catalog.registry import ORACLES, QUERIES  # noqa: F401
