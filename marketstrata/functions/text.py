"""Names and strings as SQL text."""

from __future__ import annotations


def quoted(name: str) -> str:
    """Back-quoted form of a column or of a one- to three-part table name."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def text_literal(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
