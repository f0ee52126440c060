"""Casts that turn dirty input into NULL instead of failing the job (ANSI mode is on), as SQL text."""

from __future__ import annotations


def iso_instant(value: str) -> str:
    """ISO-8601 text to ``TIMESTAMP``; unparsable gives NULL."""
    return f"try_to_timestamp({value})"


def number(value: str) -> str:
    """Text or number to ``DOUBLE``; non-numeric gives NULL."""
    return f"try_cast({value} as double)"
