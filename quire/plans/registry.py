"""Named queries over the driver's tables, and the SQL that gives the same rows."""

from quire.plans.corpus import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
