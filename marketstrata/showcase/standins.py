"""Markets, snapshots and run logs derived from the given tables, in Spark and in SQL alike.

The SQL is for an independent engine that checks the results; amounts are summed as decimals
on both sides, so the values agree to the last bit.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketstrata.functions import MONEY, exact_sum
from marketstrata.operators.tables import ensure_schema
from marketstrata.session import fresh_path, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with the SQL that must give the same rows."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame, utc: bool = False) -> DataFrame:
    """Decimals as doubles and instants as zone-less timestamps, for comparison across engines.

    Instants made from zone-less test data go back the way they came, through the session zone.
    With ``utc`` they are true instants and are shown in UTC.
    """
    moved = "to_utc_timestamp({0}, current_timezone())" if utc else "{0}"
    shown = {T.DecimalType: "cast({0} as double)", T.TimestampType: f"cast({moved} as timestamp_ntz)"}
    fields = [(f.name, shown.get(type(f.dataType))) for f in df.schema.fields]
    return df.selectExpr(*[f"{form.format(name)} as {name}" if form else name for name, form in fields])


def scratch_schema(spark: SparkSession) -> str:
    """A fresh catalog schema whose tables live in the shared folder."""
    name = f"ms_{uuid.uuid4().hex[:12]}"
    ensure_schema(spark, name, fresh_path(spark, "schema"))
    return name


def moment(text: str):
    return F.lit(text).cast("timestamp_ntz")


def instant(text: str):
    return F.lit(f"{text}Z").cast("timestamp")


# --- a market: one coin per part --------------------------------------------------------------

SPLIT = "1998-06-01"


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = f"cast(l_extendedprice as {MONEY})"
    split = f"timestamp_ntz '{SPLIT}'"
    trade = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(
            F.expr(f"cast({exact_sum(price)} as double) as cap"),
            F.expr(f"cast({exact_sum('l_quantity')} as double) as volume"),
            F.expr(f"cast({exact_sum(f'case when l_shipdate >= {split} then {price} end')} as double) as late"),
            F.expr(f"cast({exact_sum(f'case when l_shipdate < {split} then {price} end')} as double) as early"),
            F.expr("max(l_shipdate) as last_updated"),
        )
    )
    part = table(spark, sf_dir, "part")
    return part.join(trade, part["p_partkey"] == trade["l_partkey"], "left").selectExpr(
        "concat('c', p_partkey) as coin_id",
        "p_brand as symbol",
        "p_name as name",
        "p_retailprice as current_price_usd",
        "cap as market_cap_usd",
        "volume as total_volume_24h",
        "cast(cast(100d * (try_divide(late, early) - 1d) as decimal(10,4)) as double) as price_change_percentage_24h",
        "last_updated",
    )


def stored_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The market as a written table, for operators that pass over it more than once."""
    return stored(market(spark, sf_dir), "market")


MARKET = f"""
WITH trade AS (
  SELECT l_partkey,
    CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS cap,
    CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS volume,
    CAST(SUM(CASE WHEN l_shipdate >= TIMESTAMP '{SPLIT}' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END)
      AS DOUBLE) AS late,
    CAST(SUM(CASE WHEN l_shipdate < TIMESTAMP '{SPLIT}' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END)
      AS DOUBLE) AS early,
    MAX(l_shipdate) AS last_updated
  FROM lineitem GROUP BY l_partkey),
market AS (
  SELECT 'c' || CAST(p_partkey AS VARCHAR) AS coin_id, p_brand AS symbol, p_name AS name,
    p_retailprice AS current_price_usd, cap AS market_cap_usd, volume AS total_volume_24h,
    CAST(CAST(CAST(100 AS DOUBLE) * (late / NULLIF(early, 0) - 1) AS DECIMAL(10,4)) AS DOUBLE)
      AS price_change_percentage_24h,
    last_updated
  FROM part LEFT JOIN trade ON l_partkey = p_partkey),
total AS (SELECT CAST(SUM(CAST(market_cap_usd AS DECIMAL(18,2))) AS DOUBLE) AS cap FROM market),
shared AS (
  SELECT market.*, market_cap_usd / NULLIF(total.cap, 0) * 100 AS market_dominance FROM market, total)
"""


def market_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The market in payload columns; the first two coins play bitcoin and ethereum."""
    return market(spark, sf_dir).selectExpr(
        "case coin_id when 'c0' then 'bitcoin' when 'c1' then 'ethereum' else coin_id end as id",
        "symbol",
        "name",
        "current_price_usd as current_price",
        "market_cap_usd as market_cap",
        "total_volume_24h as total_volume",
        "price_change_percentage_24h",
        "date_format(last_updated, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") as last_updated",
    )


MARKET_PAYLOAD = (
    MARKET
    + """,
payload AS (
  SELECT CASE coin_id WHEN 'c0' THEN 'bitcoin' WHEN 'c1' THEN 'ethereum' ELSE coin_id END AS id,
    symbol, name, current_price_usd AS current_price, market_cap_usd AS market_cap,
    total_volume_24h AS total_volume, price_change_percentage_24h,
    strftime(last_updated, '%Y-%m-%dT%H:%M:%SZ') AS last_updated
  FROM market)
"""
)


# --- snapshots: a bronze and a silver history from the event stream ---------------------------

ISO = "\"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\""


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """30 daily runs of events as coins, with duplicates, negative prices and NULL symbols."""
    return table(spark, sf_dir, "events").selectExpr(
        "concat('u', user_id) as id",
        "nullif(event_type, 'error') as symbol",
        "event_type as name",
        "value - 5d as current_price",
        "value * 1000d as market_cap",
        "value * 10d as total_volume",
        "value - 50d as price_change_percentage_24h",
        f"date_format(ts, {ISO}) as last_updated",
        "ts as ingestion_timestamp",
        "date_format(ts, 'yyyy-MM-dd') as pipeline_run_id",
        "event_id",
    )


BRONZE_CTE = """
bronze AS (
  SELECT 'u' || CAST(user_id AS VARCHAR) AS id, NULLIF(event_type, 'error') AS symbol, event_type AS name,
    value - CAST(5 AS DOUBLE) AS current_price, value * CAST(1000 AS DOUBLE) AS market_cap,
    value * CAST(10 AS DOUBLE) AS total_volume, value - CAST(50 AS DOUBLE) AS price_change_percentage_24h,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS last_updated, ts AS ingestion_timestamp,
    strftime(ts, '%Y-%m-%d') AS pipeline_run_id, event_id
  FROM events)
"""


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze history with text faults: bad numbers, bad dates, missing ids, fractional ranks."""
    kind = F.col("name")
    return bronze(spark, sf_dir).withColumns(
        {
            "id": F.when(F.col("current_price") > 200, None).otherwise(F.col("id")),
            "price_change_24h": F.when(kind == "signup", "n/a").otherwise("1.25"),
            "last_updated": F.when(kind == "purchase", "soon")
            .when(F.col("current_price") < -4, None)
            .otherwise(F.col("last_updated")),
            "ath_date": F.when(kind == "signup", "never").when(kind == "view", F.col("last_updated")),
            "market_cap_rank": F.col("total_volume") / 10,
        }
    )


DIRTY = (
    "WITH"
    + BRONZE_CTE
    + """,
dirty AS (
  SELECT CASE WHEN current_price > 200 THEN NULL ELSE id END AS id, symbol, name, current_price, market_cap,
    total_volume, price_change_percentage_24h,
    CASE WHEN name = 'purchase' THEN 'soon' WHEN current_price < -4 THEN NULL ELSE last_updated END AS last_updated,
    CASE WHEN name = 'signup' THEN 'n/a' ELSE '1.25' END AS price_change_24h,
    CASE WHEN name = 'signup' THEN 'never' WHEN name = 'view' THEN last_updated END AS ath_date,
    total_volume / 10 AS market_cap_rank, event_id
  FROM bronze)
"""
)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A silver history of daily batches in which errors have no price."""
    return bronze(spark, sf_dir).selectExpr(
        "id as coin_id",
        "symbol",
        "name",
        "case when symbol is not null then current_price end as current_price_usd",
        "market_cap as market_cap_usd",
        "total_volume as total_volume_24h",
        "price_change_percentage_24h",
        "cast(date_trunc('day', ingestion_timestamp) as timestamp_ntz) as silver_ingestion_time",
        "event_id",
    )


SILVER_CTE = (
    BRONZE_CTE
    + """,
silver AS (
  SELECT id AS coin_id, symbol, name, CASE WHEN symbol IS NOT NULL THEN current_price END AS current_price_usd,
    market_cap AS market_cap_usd, total_volume AS total_volume_24h, price_change_percentage_24h,
    CAST(date_trunc('day', ingestion_timestamp) AS TIMESTAMP) AS silver_ingestion_time, event_id
  FROM bronze)
"""
)


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per silver batch, with totals five percent too high."""
    total = f"cast(cast({exact_sum('market_cap_usd')} as double) * 1.05d as decimal(38,2)) as total_market_cap_usd"
    batches = silver(spark, sf_dir).withColumnRenamed("silver_ingestion_time", "as_of_timestamp")
    return batches.groupBy("as_of_timestamp").agg(F.expr(total))


GOLD_CTE = (
    SILVER_CTE
    + """,
gold AS (
  SELECT silver_ingestion_time AS as_of_timestamp,
    CAST(CAST(CAST(SUM(CAST(market_cap_usd AS DECIMAL(18,2))) AS DOUBLE) * CAST(1.05 AS DOUBLE)
      AS DECIMAL(18,2)) AS DOUBLE) AS total_market_cap_usd
  FROM silver GROUP BY silver_ingestion_time)
"""
)


# --- a run log from the orders ----------------------------------------------------------------


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log row per order; several rows share a run id, a third have not ended."""
    seconds, ended = "cast(floor(o_totalprice / 1000d) as bigint)", "o_orderstatus <> 'P'"
    end = f"cast(timestampadd(second, {seconds}, o_orderdate) as timestamp_ntz)"
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('r', o_custkey) as run_id",
        "case when o_orderpriority = '5-LOW' then 'other' else 'market_hourly' end as pipeline_name",
        "o_orderdate as start_time",
        f"case when {ended} then {end} end as end_time",
        f"case when {ended} then cast({seconds} as double) end as duration_seconds",
        f"case when {ended} then 'SUCCESS' else 'RUNNING' end as status",
        "o_orderkey as records_processed",
        "map('priority', o_orderpriority) as metadata",
    )


RUNS_CTE = """
runs AS (
  SELECT 'r' || CAST(o_custkey AS VARCHAR) AS run_id,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'other' ELSE 'market_hourly' END AS pipeline_name,
    o_orderdate AS start_time,
    CASE WHEN o_orderstatus <> 'P'
      THEN o_orderdate + to_seconds(CAST(floor(o_totalprice / 1000) AS BIGINT)) END AS end_time,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice / 1000) AS DOUBLE) END AS duration_seconds,
    CASE WHEN o_orderstatus <> 'P' THEN 'SUCCESS' ELSE 'RUNNING' END AS status,
    o_orderkey AS records_processed, o_orderpriority AS priority
  FROM orders)
"""
