"""Share of each row in the total of its batch."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstrata.functions import exact_sum, percent_of, quoted


def market_share(
    df: DataFrame,
    value: str = "market_cap_usd",
    batch: str | None = None,
    out: str = "market_dominance",
) -> DataFrame:
    """``value / sum(value) * 100`` within the batch; a NULL or zero total gives NULL.

    A window over the batch would put all its rows into one task. The total is an aggregate
    instead: a scalar subquery for a single batch, a join on the batch key otherwise.
    """
    if batch is None:
        joined = df.withColumn("_total", df.agg(F.expr(exact_sum(quoted(value)))).scalar())
    else:
        totals = df.groupBy(batch).agg(F.expr(exact_sum(quoted(value))).alias("_total"))
        joined = attach_by_key(df, totals, [batch])
    return joined.withColumn(out, F.expr(percent_of(quoted(value), "_total"))).drop("_total")


def attach_by_key(
    rows: DataFrame,
    small: DataFrame,
    keys: list[str],
    how: str = "left",
) -> DataFrame:
    """Join ``small`` (unique on ``keys``) to ``rows`` where one key may hold most rows; NULL keys match.

    Nothing runs here. Spark broadcasts ``small`` where its measured size allows it; otherwise both sides are
    shuffled by the keys and a hot key is split at run time over as many tasks as its bytes need.
    """
    small = small.withColumnsRenamed({key: f"_key_{key}" for key in keys})
    match = reduce(and_, [F.col(key).eqNullSafe(F.col(f"_key_{key}")) for key in keys])
    return rows.join(small, match, how).drop(*[f"_key_{key}" for key in keys])
