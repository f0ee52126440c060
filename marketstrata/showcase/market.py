"""Gold: market share, metrics, rankings and leaders."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketstrata.contracts import LEADERS, METRICS
from marketstrata.operators import leaders, metrics
from marketstrata.operators.conform import fit_contract
from marketstrata.operators.shares import market_share
from marketstrata.showcase.standins import (
    BRONZE_CTE,
    MARKET,
    SILVER_CTE,
    bronze,
    market,
    plain,
    query,
    silver,
    stored_market,
)

STAND_IN_ANCHORS = {"btc": "c0", "eth": "c1"}


@query(
    "market_dominance",
    MARKET + "SELECT coin_id, market_cap_usd, market_dominance FROM shared",
)
def market_dominance(spark, sf_dir):
    return market_share(stored_market(spark, sf_dir)).select("coin_id", "market_cap_usd", "market_dominance")


@query(
    "batch_dominance",
    "WITH"
    + BRONZE_CTE
    + """
SELECT event_id, pipeline_run_id,
  market_cap / NULLIF(CAST(SUM(CAST(market_cap AS DECIMAL(18,2))) OVER (PARTITION BY pipeline_run_id) AS DOUBLE), 0)
    * 100 AS market_dominance
FROM bronze""",
)
def batch_dominance(spark, sf_dir):
    rows = market_share(bronze(spark, sf_dir), "market_cap", batch="pipeline_run_id")
    return rows.select("event_id", "pipeline_run_id", "market_dominance")


def _metrics_sql(source: str, as_of: str, btc: str, eth: str, group: str = "") -> str:
    def decimal(x: str) -> str:
        return f"CAST(CAST({x} AS DECIMAL(10,4)) AS DOUBLE)"

    return f"""
SELECT COUNT(coin_id) AS total_coins,
  CAST(SUM(CAST(market_cap_usd AS DECIMAL(18,2))) AS DOUBLE) AS total_market_cap_usd,
  CAST(SUM(CAST(total_volume_24h AS DECIMAL(18,2))) AS DOUBLE) AS total_volume_24h_usd,
  {decimal("CAST(SUM(CAST(price_change_percentage_24h AS DECIMAL(18,8))) AS DOUBLE)"
           " / COUNT(price_change_percentage_24h)")} AS avg_price_change_24h,
  {decimal("CAST(SUM(CAST(market_cap_usd AS DECIMAL(18,2)) * CAST(price_change_percentage_24h AS DECIMAL(10,4)))"
           " AS DOUBLE) / NULLIF(CAST(SUM(CAST(market_cap_usd AS DECIMAL(18,2))) AS DOUBLE), 0)")}
    AS market_cap_weighted_24h_return,
  COUNT(*) FILTER (WHERE price_change_percentage_24h > 0) AS coins_positive_24h,
  COUNT(*) FILTER (WHERE price_change_percentage_24h < 0) AS coins_negative_24h,
  {decimal(f"MAX(CASE WHEN coin_id = '{btc}' THEN market_dominance END)")} AS dominance_btc,
  {decimal(f"MAX(CASE WHEN coin_id = '{eth}' THEN market_dominance END)")} AS dominance_eth,
  {as_of} AS as_of_timestamp
FROM {source} {group}"""


@query("market_metrics", MARKET + _metrics_sql("shared", "MAX(last_updated)", "c0", "c1"))
def market_metrics(spark, sf_dir):
    rows = market(spark, sf_dir)
    found = metrics.market_metrics(rows, as_of="last_updated", anchors=STAND_IN_ANCHORS)
    return plain(fit_contract(found, METRICS))


_BATCH_SHARED = """,
shared AS (
  SELECT silver.*, market_cap_usd / NULLIF(CAST(SUM(CAST(market_cap_usd AS DECIMAL(18,2)))
    OVER (PARTITION BY silver_ingestion_time) AS DOUBLE), 0) * 100 AS market_dominance
  FROM silver)
"""


@query(
    "market_metrics_by_batch",
    "WITH"
    + SILVER_CTE
    + _BATCH_SHARED
    + _metrics_sql("shared", "silver_ingestion_time", "u8", "u46", "GROUP BY silver_ingestion_time"),
)
def market_metrics_by_batch(spark, sf_dir):
    rows = silver(spark, sf_dir)
    found = metrics.market_metrics(rows, "silver_ingestion_time", anchors={"btc": "u8", "eth": "u46"})
    return plain(fit_contract(found, METRICS))


@query(
    "top_by_market_cap",
    MARKET
    + """,
bucketed AS (
  SELECT coin_id, name, symbol, CAST(floor(market_cap_usd / 100000) AS DOUBLE) AS market_cap_usd,
    current_price_usd, price_change_percentage_24h FROM market),
bucket_total AS (SELECT CAST(SUM(CAST(market_cap_usd AS DECIMAL(18,2))) AS DOUBLE) AS cap FROM bucketed),
ranked AS (
  SELECT CAST(RANK() OVER (ORDER BY market_cap_usd DESC NULLS LAST) AS BIGINT) AS rank, bucketed.*,
    market_cap_usd / NULLIF(cap, 0) * 100 AS market_dominance FROM bucketed, bucket_total)
SELECT * FROM ranked WHERE rank <= 10""",
)
def top_by_market_cap(spark, sf_dir):
    """Caps in buckets, so that coins tie."""
    cap = F.floor(F.col("market_cap_usd") / F.lit(100000.0)).cast("double")
    rows = market_share(stored_market(spark, sf_dir).withColumn("market_cap_usd", cap))
    return leaders.top_by_market_cap(rows).select(F.col("rank").cast("bigint").alias("rank"), *leaders.LEADER_COLUMNS)


@query(
    "top_by_market_cap_by_batch",
    "WITH"
    + SILVER_CTE
    + """,
ranked AS (
  SELECT silver_ingestion_time, event_id, coin_id, CAST(floor(market_cap_usd / 20000) AS DOUBLE) AS market_cap_usd,
    CAST(RANK() OVER (PARTITION BY silver_ingestion_time ORDER BY floor(market_cap_usd / 20000) DESC NULLS LAST)
      AS BIGINT) AS rank
  FROM silver)
SELECT * FROM ranked WHERE rank <= 10""",
)
def top_by_market_cap_by_batch(spark, sf_dir):
    cap = F.floor(F.col("market_cap_usd") / F.lit(20000.0)).cast("double")
    rows = silver(spark, sf_dir).withColumn("market_cap_usd", cap)
    ranked = leaders.top_by_market_cap(rows, batch="silver_ingestion_time")
    return ranked.select(
        "silver_ingestion_time", "event_id", "coin_id", "market_cap_usd", F.col("rank").cast("bigint").alias("rank")
    )


@query(
    "top_gainers",
    MARKET
    + """
SELECT coin_id, name, symbol, current_price_usd, price_change_percentage_24h, market_cap_usd FROM market
ORDER BY price_change_percentage_24h DESC NULLS LAST, coin_id LIMIT 10""",
)
def top_gainers(spark, sf_dir):
    return leaders.top_gainers(market(spark, sf_dir))


@query(
    "top_volume",
    MARKET
    + """
SELECT coin_id, name, symbol, total_volume_24h, market_cap_usd FROM market
ORDER BY total_volume_24h DESC NULLS LAST, coin_id LIMIT 10""",
)
def top_volume(spark, sf_dir):
    return leaders.top_volume(market(spark, sf_dir))


@query(
    "top_performers",
    MARKET
    + """,
cap AS (SELECT RANK() OVER (ORDER BY market_cap_usd DESC NULLS LAST) AS rank, shared.* FROM shared),
gain AS (SELECT coin_id, price_change_percentage_24h AS top_gainer_24h FROM market
  ORDER BY price_change_percentage_24h DESC NULLS LAST, coin_id LIMIT 10),
volume AS (SELECT coin_id, total_volume_24h FROM market
  ORDER BY total_volume_24h DESC NULLS LAST, coin_id LIMIT 10)
SELECT cap.coin_id, name, symbol, CAST(rank AS INTEGER) AS market_cap_rank, market_cap_usd, current_price_usd,
  price_change_percentage_24h, gain.top_gainer_24h, volume.total_volume_24h,
  CAST(CAST(market_dominance AS DECIMAL(10,4)) AS DOUBLE) AS market_dominance, last_updated AS as_of_timestamp
FROM cap LEFT JOIN gain ON cap.coin_id = gain.coin_id LEFT JOIN volume ON cap.coin_id = volume.coin_id
WHERE rank <= 10""",
)
def top_performers(spark, sf_dir):
    rows = market_share(stored_market(spark, sf_dir))
    return plain(fit_contract(leaders.top_performers(rows, as_of="last_updated"), LEADERS))


@query(
    "price_stats",
    "WITH"
    + BRONZE_CTE
    + """
SELECT COUNT(*) AS total_records, COUNT(DISTINCT id) AS unique_coins,
  MIN(current_price) AS min_price, MAX(current_price) AS max_price,
  CAST(SUM(CAST(current_price AS DECIMAL(18,2))) AS DOUBLE) / COUNT(current_price) AS avg_price,
  MIN(market_cap) AS min_market_cap, MAX(market_cap) AS max_market_cap
FROM bronze""",
)
def price_stats(spark, sf_dir):
    return metrics.price_stats(bronze(spark, sf_dir))


PROFILED = ["current_price_usd", "market_cap_usd", "total_volume_24h", "price_change_percentage_24h"]


@query(
    "profile_columns",
    MARKET
    + "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", COUNT({c}) AS count,
  CAST(SUM(CAST({c} AS DECIMAL(18,4))) AS DOUBLE) / COUNT({c}) AS mean, ROUND(STDDEV_SAMP({c}), 3) AS stddev,
  MIN({c}) AS min, QUANTILE_DISC({c}, 0.25) AS p25, QUANTILE_DISC({c}, 0.5) AS p50,
  QUANTILE_DISC({c}, 0.75) AS p75, MAX({c}) AS max FROM market"""
        for c in PROFILED
    ),
)
def profile_columns(spark, sf_dir):
    profile = metrics.profile_columns(stored_market(spark, sf_dir), PROFILED)
    return profile.withColumn("stddev", F.round("stddev", 3))
