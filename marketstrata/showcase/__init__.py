"""Every operator applied to the given tables, each with SQL that must agree."""

from marketstrata.showcase import batches, market, monitoring, payloads, quality, runs, tables  # noqa: F401
from marketstrata.showcase.standins import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
