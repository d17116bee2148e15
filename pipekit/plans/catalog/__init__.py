"""The query catalogue: every operator over the given tables, beside the same query in SQL."""

from pipekit.plans.catalog import (audits, exports, flows, history, modelling, relational,  # noqa: F401
                                   scalars, scans)
from pipekit.plans.catalog.registry import OPERATORS, ORACLES, QUERIES

__all__ = ["OPERATORS", "ORACLES", "QUERIES"]
