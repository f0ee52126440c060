"""Landed payloads, the stream over them and the whole hourly run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marketstrata.contracts import METRICS, PAYLOAD
from marketstrata.plans.hourly import LayerTables, hourly_run
from marketstrata.session import fresh_path, stored
from marketstrata.showcase.market import _metrics_sql
from marketstrata.showcase.standins import (
    BRONZE_CTE,
    MARKET,
    MARKET_PAYLOAD,
    bronze,
    market_payload,
    moment,
    plain,
    query,
    scratch_schema,
    table,
)
from marketstrata.sources import payloads
from marketstrata.streaming.incremental import landed_snapshots, run_incremental_silver

_FIELDS = [
    "id", "symbol", "name", "current_price", "market_cap", "total_volume",
    "price_change_percentage_24h", "last_updated",
]

_ALL = MARKET_PAYLOAD + "SELECT * FROM payload"


@query("scan_market_payload", _ALL)
def scan_market_payload(spark, sf_dir):
    """The market lands as JSON files and is read back with the payload contract."""
    landing = fresh_path(spark, "landing")
    market_payload(spark, sf_dir).write.json(landing)
    return payloads.scan_market_payload(spark, landing, multi_line=False).select(*_FIELDS)


@query("decode_market_payload", _ALL)
def decode_market_payload(spark, sf_dir):
    """The same from a column of JSON text, one coin per document."""
    text = market_payload(spark, sf_dir).select(F.to_json(F.struct(*_FIELDS)).alias("body"))
    return payloads.decode_market_payload(text, "body", PAYLOAD).select(*_FIELDS)


@query(
    "market_page",
    MARKET_PAYLOAD + "SELECT * FROM payload ORDER BY total_volume ASC NULLS LAST, id LIMIT 50 OFFSET 100",
)
def market_page(spark, sf_dir):
    """The third page of 50 by rising volume."""
    return payloads.market_page(market_payload(spark, sf_dir), order="volume_asc", per_page=50, page=3)


def _chart_text(spark, sf_dir):
    """One chart of three hourly points per event; charts of errors have shifted cap times."""
    start = F.unix_millis(F.col("ts").cast("timestamp")).cast("double")
    value = F.col("value")
    shift = F.when(F.col("event_type") == "error", 1.0).otherwise(0.0)

    def series(factor: float, moved):
        return F.array(
            *[F.array(start + F.lit(3_600_000.0 * i) + moved, (value + F.lit(float(i))) * F.lit(factor)) for i in range(3)]
        )

    body = F.struct(
        series(1.0, F.lit(0.0)).alias("prices"),
        series(1000.0, shift).alias("market_caps"),
        series(10.0, F.lit(0.0)).alias("total_volumes"),
    )
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("coin_id"), F.to_json(body).alias("chart")
    )


_POINTS = """
WITH points AS (
  SELECT 'u' || CAST(user_id AS VARCHAR) AS coin_id, date_trunc('milliseconds', ts) + to_hours(i) AS ts,
    value + i AS price, (value + i) * CAST(1000 AS DOUBLE) AS market_cap, (value + i) * CAST(10 AS DOUBLE) AS total_volume
  FROM events, (VALUES (0), (1), (2)) AS steps(i) WHERE event_type <> 'error')
"""


@query("explode_market_chart", _POINTS + "SELECT * FROM points")
def explode_market_chart(spark, sf_dir):
    charts = payloads.decode_chart(_chart_text(spark, sf_dir), "chart")
    return plain(payloads.explode_market_chart(charts))


@query(
    "daily_market_chart",
    _POINTS
    + """,
ordered AS (
  SELECT coin_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, price, market_cap, total_volume,
    ROW_NUMBER() OVER (PARTITION BY coin_id, date_trunc('day', ts)
      ORDER BY ts DESC, price DESC, market_cap DESC, total_volume DESC) AS n
  FROM points WHERE ts > TIMESTAMP '2024-01-31' - INTERVAL 14 DAY)
SELECT coin_id, day AS ts, price, market_cap, total_volume FROM ordered WHERE n = 1""",
)
def daily_market_chart(spark, sf_dir):
    """The last point of each day of the last 14 days."""
    charts = payloads.decode_chart(_chart_text(spark, sf_dir), "chart")
    as_of = moment("2024-01-31").cast("timestamp")
    return plain(payloads.explode_market_chart(charts, days=14, interval="daily", as_of=as_of))


@query(
    "chart_rejects",
    """
SELECT 'u' || CAST(user_id AS VARCHAR) AS coin_id, CAST(3 AS BIGINT) AS points FROM events
WHERE event_type = 'error'""",
)
def chart_rejects(spark, sf_dir):
    """Charts whose three time grids differ."""
    _, rejected = payloads.split_charts(payloads.decode_chart(_chart_text(spark, sf_dir), "chart"))
    return rejected.select("coin_id", F.size("prices").cast("bigint").alias("points"))


@query(
    "explode_sparkline",
    MARKET
    + """
SELECT coin_id AS id, CAST(i AS INTEGER) AS position, current_price_usd + i AS price
FROM market, (VALUES (0), (1), (2)) AS steps(i)""",
)
def explode_sparkline(spark, sf_dir):
    price = F.col("current_price")
    spark_line = F.struct(F.array(price, price + 1.0, price + 2.0).alias("price"))
    rows = market_payload(spark, sf_dir).withColumn("sparkline_in_7d", spark_line)
    named = F.when(F.col("id") == "bitcoin", "c0").when(F.col("id") == "ethereum", "c1").otherwise(F.col("id"))
    text = rows.select(F.to_json(F.struct(named.alias("id"), "symbol", "sparkline_in_7d")).alias("body"))
    return payloads.explode_sparkline(payloads.decode_sparkline(text, "body"))


@query(
    "incremental_silver",
    "WITH"
    + BRONZE_CTE
    + """,
good AS (SELECT * FROM bronze WHERE symbol IS NOT NULL),
ordered AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY pipeline_run_id, id ORDER BY last_updated DESC, symbol DESC, name DESC,
    current_price DESC, market_cap DESC) AS n FROM good),
kept AS (SELECT * FROM ordered WHERE n = 1)
SELECT id AS coin_id, CAST(last_updated AS TIMESTAMP) AS last_updated, current_price AS current_price_usd,
  market_cap AS market_cap_usd, pipeline_run_id,
  market_cap / NULLIF(CAST(SUM(CAST(market_cap AS DECIMAL(18,2))) OVER (PARTITION BY pipeline_run_id) AS DOUBLE), 0)
    * 100 AS market_dominance
FROM kept""",
)
def incremental_silver(spark, sf_dir):
    """Every run lands as JSON; the stream merges them into silver."""
    schema, landing, progress = scratch_schema(spark), fresh_path(spark, "landing"), fresh_path(spark, "progress")
    rows = bronze(spark, sf_dir).drop("event_id", "ingestion_timestamp")
    rows.write.partitionBy("pipeline_run_id").json(landing)
    now = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
    landed = landed_snapshots(spark, landing)
    run_incremental_silver(landed, f"{schema}.silver", f"{schema}.quarantine", progress, now)
    return plain(
        spark.read.table(f"{schema}.silver").select(
            "coin_id", "last_updated", "current_price_usd", "market_cap_usd", "pipeline_run_id", "market_dominance"
        ),
        utc=True,
    )


@query(
    "hourly_run",
    MARKET.replace("SELECT 'c' || CAST(p_partkey AS VARCHAR) AS coin_id",
                   "SELECT CASE p_partkey WHEN 0 THEN 'bitcoin' WHEN 1 THEN 'ethereum'"
                   " ELSE 'c' || CAST(p_partkey AS VARCHAR) END AS coin_id")
    + _metrics_sql("shared", "TIMESTAMP '2024-02-01'", "bitcoin", "ethereum"),
)
def hourly(spark, sf_dir):
    """Bronze to monitoring for one payload; returns the stored metrics."""
    tables = LayerTables.under(scratch_schema(spark))
    now = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
    hourly_run(spark, market_payload(spark, sf_dir), tables, "run_1706745600", now, clock=lambda: now)
    return plain(spark.read.table(tables.metrics).select(METRICS.fieldNames()), utc=True)


_HOURLY_MARKET = MARKET.replace(
    "SELECT 'c' || CAST(p_partkey AS VARCHAR) AS coin_id",
    "SELECT CASE p_partkey WHEN 0 THEN 'bitcoin' WHEN 1 THEN 'ethereum' ELSE 'c' || CAST(p_partkey AS VARCHAR) END AS coin_id",
)


@query(
    "hourly_two_runs",
    _HOURLY_MARKET
    + _metrics_sql("shared", "TIMESTAMP '2024-02-01'", "bitcoin", "ethereum")
    + " UNION ALL "
    + _metrics_sql("shared", "TIMESTAMP '2024-02-01 01:00:00'", "bitcoin", "ethereum"),
)
def hourly_two_runs(spark, sf_dir):
    """Two runs whose coins are all unchanged, the later one ingested first, and one of them run twice."""
    tables = LayerTables.under(scratch_schema(spark))
    first = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
    # It lands once, and all three runs read it as landed.
    payload = stored(market_payload(spark, sf_dir), "payload")
    for run, now in (("r2", first + dt.timedelta(hours=1)), ("r1", first), ("r1", first)):
        hourly_run(spark, payload, tables, run, now, clock=lambda now=now: now)
    return plain(spark.read.table(tables.metrics).select(METRICS.fieldNames()), utc=True)
