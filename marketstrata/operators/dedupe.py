"""One row per key, chosen by rule instead of by chance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstrata.functions import quoted


def dedupe_snapshot(
    df: DataFrame,
    keys: list[str],
    newest: str = "last_updated",
    copies: str | None = None,
) -> DataFrame:
    """Keep the newest row per key; ties go to the greatest remaining columns in column order.

    The maximum is taken on the map side first, so a key with a third of all rows sends one row
    per map task. ``copies`` adds the number of input rows behind each survivor.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = ([newest] if newest in rest else []) + [c for c in rest if c != newest]
    if not ranked and not copies:
        return df.distinct()
    best = [F.expr(f"max(struct({', '.join(quoted(c) for c in ranked)})) as _best")] if ranked else []
    counted = [F.expr(f"count(1) as {quoted(copies)}")] if copies else []
    grouped = df.groupBy(*keys).agg(*best, *counted)
    picked = [quoted(c) if c in keys else f"_best.{quoted(c)} as {quoted(c)}" for c in df.columns]
    return grouped.selectExpr(*picked, *([quoted(copies)] if copies else []))
