"""Runs repeated, late, dirty or long past, and the upkeep of what they leave."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marketstrata.operators import batches, monitor, publish, rollup, tables
from marketstrata.operators.quality import RUN_RULES
from marketstrata.plans.hourly import LayerTables, hourly_run
from marketstrata.showcase.market import _metrics_sql
from marketstrata.showcase.standins import (
    BRONZE_CTE,
    GOLD_CTE,
    MARKET,
    SILVER_CTE,
    bronze,
    gold,
    market_payload,
    moment,
    plain,
    query,
    scratch_schema,
    silver,
    table,
)
from marketstrata.session import stored
from marketstrata.sources.payloads import raw_market

_NAMED = MARKET.replace(
    "SELECT 'c' || CAST(p_partkey AS VARCHAR) AS coin_id",
    "SELECT CASE p_partkey WHEN 0 THEN 'bitcoin' WHEN 1 THEN 'ethereum' ELSE 'c' || CAST(p_partkey AS VARCHAR) END AS coin_id",
)
_SOME = _NAMED.replace("FROM part LEFT JOIN", "FROM (SELECT * FROM part WHERE p_partkey % 3 <> 2) AS part LEFT JOIN")


def _stored_metrics(market: str, at: str) -> str:
    return f"SELECT * FROM ({market}{_metrics_sql('shared', f"TIMESTAMP '{at}'", 'bitcoin', 'ethereum')}) AS m"


def _some(payload):
    """Two of three coins; the numbered names keep their parts' numbers."""
    number = F.when(F.col("id") == "bitcoin", 0).when(F.col("id") == "ethereum", 1).otherwise(F.substring("id", 2, 20).cast("long"))
    return payload.filter(number % 3 != 2)


def _at(hour: int, minute: int = 0) -> dt.datetime:
    return dt.datetime(2024, 2, 1, hour, minute, tzinfo=dt.timezone.utc)


def _runs(spark, schema, attempts):
    names = LayerTables.under(schema)
    for run, now, payload, options in attempts:
        hourly_run(spark, payload, names, run, now, clock=lambda now=now: now, **options)
    return names


@query(
    "hourly_rerun",
    f"SELECT *, 'r1' AS pipeline_run_id FROM ({_stored_metrics(_NAMED, '2024-02-01 00:30:00')}) AS a"
    f" UNION ALL SELECT *, 'r2' FROM ({_stored_metrics(_SOME, '2024-02-01 01:00:00')}) AS b",
)
def hourly_rerun(spark, sf_dir):
    """A run lands in part, is repeated whole with another clock before and after the next run, and counts once."""
    whole = stored(market_payload(spark, sf_dir), "payload")
    attempts = [
        ("r1", _at(0), _some(whole), {}),
        ("r2", _at(1), _some(whole), {}),
        ("r1", _at(0, 30), whole, {}),
    ]
    names = _runs(spark, scratch_schema(spark), attempts)
    return plain(spark.read.table(names.metrics), utc=True)


@query(
    "hourly_late_run",
    f"SELECT 'r1' AS pipeline_run_id, total_coins, as_of_timestamp, 'r2' AS leaders_of FROM ({_stored_metrics(_SOME, '2024-02-01')}) AS a"
    f" UNION ALL SELECT 'r2', total_coins, as_of_timestamp, 'r2' FROM ({_stored_metrics(_NAMED, '2024-02-01 02:00:00')}) AS b",
)
def hourly_late_run(spark, sf_dir):
    """The later run is first; the late one has other coins and leaves the leaders to the newest batch."""
    whole = stored(market_payload(spark, sf_dir), "payload")
    names = _runs(spark, scratch_schema(spark), [("r2", _at(2), whole, {}), ("r1", _at(0), _some(whole), {})])
    metrics = spark.read.table(names.metrics)
    leaders_at = spark.read.table(names.leaders).agg(F.max("as_of_timestamp")).scalar()
    leaders_of = metrics.filter(F.col("as_of_timestamp") == leaders_at).agg(F.max("pipeline_run_id")).scalar()
    found = metrics.select("pipeline_run_id", "total_coins", "as_of_timestamp", leaders_of.alias("leaders_of"))
    return plain(found, utc=True)


# --- a dirty payload through the whole plan ---------------------------------------------------

# The faults, by event: text and infinities in a price, an amount beyond the sums, ranks no integer holds, changes
# beyond gold's decimals or the sums' decimals, text in a number, dates that are none, missing symbols.
_FAULTS = {
    ("symbol", "is_not_null"): "event_type = 'error'",
    ("current_price", "is_positive_or_null"): "event_id % 17 = 2 OR (event_id % 17 > 2 AND value - 5 < 0)",
    ("current_price", "fits_double_or_null"): "event_id % 17 = 0",
    ("current_price", "is_finite_or_null"): "event_id % 17 = 1",
    ("market_cap", "fits_sums_or_null"): "event_id % 19 = 0",
    ("market_cap", "is_positive_or_null"): "event_id % 19 <> 0 AND value < 0",
    ("market_cap_rank", "is_positive_integer_or_null"): "event_id % 13 = 0",
    ("market_cap_rank", "fits_integer_or_null"): "event_id % 13 IN (0, 1)",
    ("price_change_percentage_24h", "fits_gold_or_null"): "event_id % 11 IN (0, 1)",
    ("price_change_24h", "is_numeric_or_null"): "event_type = 'signup'",
    ("price_change_24h", "fits_double_or_null"): "event_type = 'signup'",
    ("last_updated", "is_valid_timestamp"): "event_type = 'purchase'",
}
_FATAL = "event_type IN ('error', 'purchase') OR event_id % 17 = 1 OR event_id % 19 = 0"


def _dirty_text(spark, sf_dir):
    """One JSON document an event, with its faults written as a feed would write them."""
    fields = {
        "id": "concat('\"e', event_id, '\"')",
        "symbol": "if(event_type = 'error', 'null', concat('\"', event_type, '\"'))",
        "name": "concat('\"', event_type, '\"')",
        "current_price": "case event_id % 17 when 0 then '\"n/a\"' when 1 then '\"Infinity\"' when 2 then '\"NaN\"' else string(value - 5d) end",
        "market_cap": "if(event_id % 19 = 0, '1e23', string(value * 1000d))",
        "market_cap_rank": "case event_id % 13 when 0 then '1.7' when 1 then '3000000000' else string(event_id + 1) end",
        "price_change_percentage_24h": "case event_id % 11 when 0 then '2e8' when 1 then '1200000.0' else '2.5' end",
        "price_change_24h": "if(event_type = 'signup', '\"n/a\"', '1.25')",
        "last_updated": "if(event_type = 'purchase', '\"soon\"', concat('\"', date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\"), '\"'))",
    }
    pairs = ", ',', ".join(f"'\"{name}\":', {value}" for name, value in fields.items())
    return table(spark, sf_dir, "events").selectExpr(f"concat('{{', {pairs}, '}}') as body")


@query(
    "hourly_dirty_run",
    "\nUNION ALL\n".join(
        f"""SELECT '{r.column}' AS "column", '{r.rule}' AS rule, '{r.severity}' AS severity, COUNT(*) AS total_records,
  COUNT(*) FILTER (WHERE {_FAULTS.get((r.column, r.rule), "FALSE")}) AS invalid_records FROM events"""
        for r in RUN_RULES
    )
    + f"""
UNION ALL SELECT '*', 'quarantined', 'error', COUNT(*), COUNT(*) FILTER (WHERE {_FATAL}) FROM events
UNION ALL SELECT '*', 'in gold', 'ok', COUNT(*), COUNT(*) FILTER (WHERE NOT ({_FATAL})) FROM events""",
)
def hourly_dirty_run(spark, sf_dir):
    """Every fault is counted by the stored validation, though the typed columns cannot hold it."""
    payload = raw_market(_dirty_text(spark, sf_dir), "body")
    names = _runs(spark, scratch_schema(spark), [("r1", _at(0), payload, {"strict": False})])
    counted = spark.read.table(names.validation).drop("pipeline_run_id")
    total = counted.agg(F.max("total_records")).scalar()
    line = lambda rule, severity, n: n.select(
        F.lit("*").alias("column"), F.lit(rule).alias("rule"), F.lit(severity).alias("severity"),
        total.alias("total_records"), F.col("n").alias("invalid_records"),
    )
    aside = spark.read.table(names.quarantine).agg(F.count("*").alias("n"))
    used = spark.read.table(names.metrics).select(F.col("total_coins").alias("n"))
    return counted.unionByName(line("quarantined", "error", aside)).unionByName(line("in gold", "ok", used))


# --- merge, registry, sketches, reconciliation, compaction ------------------------------------


@query(
    "merge_old_key",
    """
SELECT event_id, ts, value FROM events WHERE ts < TIMESTAMP '2024-01-29'
UNION ALL SELECT event_id, ts, value + 1000 FROM events WHERE ts >= TIMESTAMP '2024-01-29'
UNION ALL SELECT -event_id - 1, ts - INTERVAL 1461 DAY, value FROM events WHERE event_id % 100 = 0""",
)
def merge_old_key(spark, sf_dir):
    """New versions of the last days, some four years old, and stored ones of the first day that stay as they are."""
    name = f"{scratch_schema(spark)}.versions"
    rows = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    last = F.col("ts") >= moment("2024-01-29").cast("timestamp")
    first = F.col("ts") < moment("2024-01-02").cast("timestamp")
    tables.insert_only_merge(rows.filter(~last), name, ["event_id", "ts"], day="day")
    changed = rows.filter(last | first).withColumn("value", F.col("value") + 1000)
    # An instant four years back, whatever the session's time zone: microseconds are subtracted.
    ago = F.timestamp_micros(F.unix_micros("ts") - F.lit(1461 * 86_400_000_000))
    old = rows.filter("event_id % 100 = 0").select((-F.col("event_id") - 1).alias("event_id"), ago.alias("ts"), "value")
    tables.insert_only_merge(changed.unionByName(old), name, ["event_id", "ts"], day="day")
    return plain(tables.read_table(spark, name).drop("day"))


def _recorded(spark, sf_dir):
    """Figures of every run of both layers, as the runs would have stored them."""
    moment_ = F.lit(_at(0))
    # Silver batches of the stand-in are days, as its bronze runs are.
    runs = silver(spark, sf_dir).withColumn("pipeline_run_id", F.date_format("silver_ingestion_time", "yyyy-MM-dd"))
    first = rollup.run_figures(monitor.bronze_layer(bronze(spark, sf_dir)), moment_)
    return first.unionByName(rollup.run_figures(monitor.silver_layer(runs), moment_))


@query(
    "history_coins",
    "WITH"
    + SILVER_CTE
    + """
SELECT 'bronze' AS layer, COUNT(*) AS row_count, MIN(ingestion_timestamp) AS first_record,
  MAX(ingestion_timestamp) AS last_record, CAST(NULL AS DOUBLE) AS avg_price, CAST(NULL AS DOUBLE) AS total_market_cap,
  TRUE AS within_error FROM bronze
UNION ALL
SELECT 'silver', COUNT(*), MIN(silver_ingestion_time), MAX(silver_ingestion_time),
  CAST(SUM(CAST(current_price_usd AS DECIMAL(18,2))) AS DOUBLE) / COUNT(current_price_usd),
  CAST(SUM(CAST(market_cap_usd AS DECIMAL(18,2))) AS DOUBLE), TRUE FROM silver""",
)
def history_coins(spark, sf_dir):
    """Statistics of the history added up from its runs; distinct coins are within four standard errors of the truth."""
    layers = [monitor.bronze_layer(None), monitor.silver_layer(None)]
    added = rollup.statistics(_recorded(spark, sf_dir), layers)
    exact = bronze(spark, sf_dir).agg(F.countDistinct("id")).scalar()
    within = F.abs(F.col("unique_coins") - exact) <= exact * (4 * rollup.COIN_ERROR)
    return plain(added.withColumn("within_error", within).drop("unique_coins", "avg_market_cap"))


@query(
    "latest_run_registered",
    "WITH"
    + BRONZE_CTE
    + """
SELECT event_id, id, pipeline_run_id FROM bronze WHERE pipeline_run_id = (SELECT MAX(pipeline_run_id) FROM bronze)""",
)
def latest_run_registered(spark, sf_dir):
    """The newest run, looked up among the recorded figures and read as one partition."""
    name = f"{scratch_schema(spark)}.bronze"
    tables.create_from(bronze(spark, sf_dir), name, ["pipeline_run_id"])
    registry = rollup.newest_attempts(_recorded(spark, sf_dir)).filter("layer = 'bronze'")
    return batches.latest_run(spark.read.table(name), registry=registry).select("event_id", "id", "pipeline_run_id")


@query(
    "batch_reconciliation",
    "WITH"
    + GOLD_CTE
    + """,
computed AS (SELECT silver_ingestion_time AS batch, CAST(SUM(CAST(market_cap_usd AS DECIMAL(18,2))) AS DOUBLE) AS total
  FROM silver GROUP BY 1),
ends AS (SELECT MIN(batch) AS first, MAX(batch) AS last FROM computed),
pairs AS (
  SELECT coalesce(s.batch, g.batch) AS batch, s.total AS silver_total, g.total AS gold_total
  FROM (SELECT computed.* FROM computed, ends WHERE batch <> last) AS s
  FULL JOIN (SELECT as_of_timestamp AS batch, total_market_cap_usd AS total FROM gold, ends WHERE as_of_timestamp <> first) AS g
    ON s.batch = g.batch)
SELECT CASE WHEN silver_total IS NULL OR gold_total IS NULL THEN 'ERROR' ELSE 'WARNING' END AS level,
  'batch_reconciliation' AS "check", strftime(batch, '%Y-%m-%d %H:%M:%S') AS subject,
  abs((silver_total - gold_total) / NULLIF(silver_total, 0) * 100) AS observed, CAST(1 AS DOUBLE) AS threshold
FROM pairs WHERE silver_total IS NULL OR gold_total IS NULL OR abs((silver_total - gold_total) / NULLIF(silver_total, 0) * 100) > 1""",
)
def batch_reconciliation(spark, sf_dir):
    """Silver lacks the last batch, gold the first; the others differ by five percent."""
    sums = silver(spark, sf_dir).groupBy(F.col("silver_ingestion_time").alias("batch"))
    computed = sums.agg(F.expr(f"{rollup.exact_sum('market_cap_usd')} as total"))
    reported = gold(spark, sf_dir).selectExpr("as_of_timestamp as batch", "total_market_cap_usd as total")
    ends = computed.agg(F.min("batch").alias("first"), F.max("batch").alias("last"))
    some = computed.filter(F.col("batch") != ends.select("last").scalar())
    other = reported.filter(F.col("batch") != ends.select("first").scalar())
    return monitor.batch_reconciliation(some, other, "batch").drop("message")


@query(
    "compact_table",
    """
SELECT strftime(ts, '%Y-%m-%d') AS day, COUNT(*) AS n, SUM(event_id)::BIGINT AS ids, SUM(CAST(value AS DECIMAL(18,4)))::DOUBLE AS total,
  1::BIGINT AS files FROM events GROUP BY 1""",
)
def compact_table(spark, sf_dir):
    """Days appended in four pieces each, then rewritten into one file a day."""
    name = f"{scratch_schema(spark)}.pieces"
    rows = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    for piece in range(4):
        tables.write_table(rows.filter(F.col("event_id") % 4 == piece), name, "append", partition_by=["day"], stamp=False)
    publish.compact_table(spark, name)
    found = spark.read.table(name).withColumn("file", F.col("_metadata.file_path"))
    return found.groupBy("day").agg(
        F.count("*").alias("n"),
        F.sum("event_id").alias("ids"),
        F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("total"),
        F.countDistinct("file").alias("files"),
    )


