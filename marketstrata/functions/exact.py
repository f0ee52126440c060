"""Order-independent arithmetic, as SQL text.

Sums of doubles depend on the order in which partitions are merged, so a retried or
re-partitioned job could report another total. Amounts are summed as decimals instead and
turned into doubles once at the end. Values may be any SQL expression.
"""

from __future__ import annotations

# Sums add ten digits of precision: MONEY sums are DECIMAL(34,2), PRICE sums DECIMAL(38,10).
MONEY = "decimal(24,2)"
PRICE = "decimal(28,10)"
PERCENT = "decimal(16,8)"


def exact_sum(value: str, kind: str = MONEY) -> str:
    """Decimal sum of a double; NULLs and values the decimal cannot hold are skipped, without any it is NULL.

    A rule of ``quality.FIT_RULES`` counts the values that are skipped.
    """
    return f"sum(try_cast({value} as {kind}))"


def exact_avg(value: str, kind: str = PERCENT) -> str:
    """Average as decimal sum over count of what is summed; no rows gives NULL."""
    return f"try_divide(cast({exact_sum(value, kind)} as double), count(try_cast({value} as {kind})))"


def percent_of(part: str, whole: str) -> str:
    """``part / whole * 100``; NULL where the whole is NULL or zero."""
    return f"try_divide(cast({part} as double), cast({whole} as double)) * 100d"


def percentage(part: str, whole: str) -> str:
    """``part * 100 / whole`` for counts; NULL where the whole is zero."""
    return f"try_divide(cast({part} as double) * 100d, cast({whole} as double))"
