"""Aggregates of a batch or of every batch of a history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstrata.contracts import METRICS
from marketstrata.functions import (
    MONEY,
    PERCENT,
    PRICE,
    exact_avg,
    exact_sum,
    percent_of,
    text_literal,
)
from marketstrata.operators.conform import fit_contract
from marketstrata.operators.quantiles import column_value, refine_quantiles, sketch_figures

# Coins whose dominance the market metrics report.
ANCHORS = {"btc": "bitcoin", "eth": "ethereum"}


def price_stats(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Row count, distinct coins and price/cap range of a bronze table, in one aggregate."""
    distinct = "approx_count_distinct(id)" if approximate else "count(distinct id)"
    return df.agg(
        F.expr("count(1) as total_records"),
        F.expr(f"{distinct} as unique_coins"),
        F.expr("min(current_price) as min_price"),
        F.expr("max(current_price) as max_price"),
        F.expr(f"{exact_avg('current_price', PRICE)} as avg_price"),
        F.expr("min(market_cap) as min_market_cap"),
        F.expr("max(market_cap) as max_market_cap"),
    )


def market_metrics(
    silver: DataFrame,
    batch: str | None = None,
    as_of: str = "silver_ingestion_time",
    anchors: dict[str, str] | None = None,
) -> DataFrame:
    """Market overview: one row for a single batch, one per value of ``batch`` otherwise.

    The weighted return is ``sum(cap * change) / sum(cap)``; coins without a change stay in the
    denominator. A coin that is absent has NULL dominance. Dominance is read from
    ``market_dominance`` where the data has it, else taken from the totals of the same pass.
    """
    anchors = anchors or ANCHORS
    stored_share = "market_dominance" in silver.columns
    change, cap = "price_change_percentage_24h", "market_cap_usd"
    weighted = f"cast(sum(try_cast({cap} as {MONEY}) * try_cast({change} as {PERCENT})) as double)"
    figures = {
        "total_coins": "count(coin_id)",
        "total_market_cap_usd": exact_sum(cap),
        "total_volume_24h_usd": exact_sum("total_volume_24h"),
        "avg_price_change_24h": exact_avg(change),
        "market_cap_weighted_24h_return": f"try_divide({weighted}, cast({exact_sum(cap)} as double))",
        "coins_positive_24h": f"count_if({change} > 0)",
        "coins_negative_24h": f"count_if({change} < 0)",
        **{f"dominance_{tag}": _dominance(coin, stored_share) for tag, coin in anchors.items()},
    }
    figures = [F.expr(text).alias(name) for name, text in figures.items()]
    if batch is None:
        return silver.agg(*figures, F.max(as_of).alias("as_of_timestamp"))
    return silver.groupBy(F.col(batch).alias("as_of_timestamp")).agg(*figures)


def gold_metrics(silver: DataFrame, batch: str | None = "silver_ingestion_time") -> DataFrame:
    """Market metrics in the types of the gold table."""
    return fit_contract(market_metrics(silver, batch), METRICS)


def _dominance(coin: str, stored_share: bool) -> str:
    """Share of one coin; the greatest where a batch has several rows of it."""
    value = "market_dominance" if stored_share else "market_cap_usd"
    point = f"max(case when coin_id = {text_literal(coin)} then {value} end)"
    return point if stored_share else percent_of(point, exact_sum(value))


def profile_columns(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """One row per column: count, mean, stddev, min, quartiles, max; NaN counts as NULL, infinities as values.

    Quartiles are elements of the data. They are exact by default, in two scans of ``df``; ``approximate`` takes them
    from the sketch of the first scan, within its rank error (``quantiles.RANK_ERROR``). The mean is exact where all
    values fit the decimals of the sums; with infinities it is infinite, or NaN where both occur, as is the stddev.
    The scans run when this is called; the result is a row a column.
    """
    figures = {}
    for i, name in enumerate(columns):
        value = column_value(name)
        whole = f"count(try_cast({value} as {PRICE})) = count({value})"
        figures |= {
            f"mean_{i}": f"case when {whole} then {exact_avg(value, PRICE)} else avg({value}) end",
            f"sd_{i}": f"stddev({value})",
            f"min_{i}": f"min({value})",
            f"max_{i}": f"max({value})",
            **sketch_figures(value, f"_{i}", QUARTILES),
        }
    first = df.agg(*[F.expr(text).alias(name) for name, text in figures.items()]).first().asDict()
    if approximate:
        quartiles = {(i, k): first[f"near{k}_{i}"] for i in range(len(columns)) for k in range(len(QUARTILES))}
    else:
        quartiles = refine_quantiles(df, columns, QUARTILES, first)
    rows = [
        (
            name, first[f"n_{i}"], first[f"mean_{i}"], first[f"sd_{i}"], first[f"min_{i}"],
            *[quartiles[i, k] for k in range(len(QUARTILES))], first[f"max_{i}"],
        )
        for i, name in enumerate(columns)
    ]
    shape = ", ".join(f"`{c}` {'string' if c == 'column' else 'bigint' if c == 'count' else 'double'}" for c in PROFILE)
    return df.sparkSession.createDataFrame(rows, shape)


QUARTILES = [0.25, 0.5, 0.75]
PROFILE = ["column", "count", "mean", "stddev", "min", "p25", "p50", "p75", "max"]
