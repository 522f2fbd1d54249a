"""Every operator as a query over the given tables, most with the SQL that checks it."""

from foldwise.queries import boosting, features, fit_steps, fitted, metrics, scoring, stacking, tables  # noqa: F401
from foldwise.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
