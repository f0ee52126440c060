"""Operators for training-data corpora, and their registered queries."""

from marketstrata.llm.queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
