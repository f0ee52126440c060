"""Health checks over stand-in layers: bronze and silver from events, gold from silver, runs from orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketstrata.operators import monitor
from marketstrata.operators.monitor import Thresholds, bronze_layer, gold_layer, silver_layer
from marketstrata.showcase.standins import GOLD_CTE, RUNS_CTE, bronze, gold, query, runs, silver, table

# The silver floor is out of reach, so that the check reports it.
LIMITS = Thresholds(min_rows={"bronze": 10, "silver": 1_000_000_000_000, "gold": 1})
NAME = "market_hourly"

_CTE = "WITH" + GOLD_CTE + "," + RUNS_CTE

_COLUMNS = ["level", "check", "subject", "observed", "threshold"]


def _layers(spark, sf_dir):
    return [
        bronze_layer(bronze(spark, sf_dir)),
        silver_layer(silver(spark, sf_dir)),
        gold_layer(gold(spark, sf_dir)),
    ]


def _lossy_silver(spark, sf_dir):
    """Silver in which the coins with a number ending in 7, 8 or 9 lost their id."""
    rows = silver(spark, sf_dir)
    return rows.withColumn("coin_id", F.when(~F.col("coin_id").rlike("[789]$"), F.col("coin_id")))


def _as_of(spark, sf_dir):
    """Three hours after the newest event."""
    newest = table(spark, sf_dir, "events").agg(F.max("ts")).scalar()
    return F.timestamp_add("HOUR", F.lit(3), newest)


_AS_OF = "(SELECT MAX(ts) + INTERVAL 3 HOUR FROM events)"

_NULL_ROWS = [
    ("silver", "current_price_usd"),
    ("silver", "market_cap_usd"),
    ("silver", "total_volume_24h"),
    ("gold", "total_market_cap_usd"),
]


def _percent_sql(column: str) -> str:
    return f"CAST(COUNT(*) FILTER (WHERE {column} IS NULL) * 100 AS DOUBLE) / NULLIF(COUNT(*), 0)"


@query(
    "null_percentage",
    _CTE
    + "\nUNION ALL\n".join(
        f"""SELECT '{la}' AS layer, '{c}' AS "column", {_percent_sql(c)} AS percent FROM {la}""" for la, c in _NULL_ROWS
    ),
)
def null_percentage(spark, sf_dir):
    return monitor.null_percentage(_layers(spark, sf_dir)[1:])


@query(
    "layer_stats",
    _CTE
    + """
SELECT 'bronze' AS layer, COUNT(*) AS row_count, MIN(ingestion_timestamp) AS first_record,
  MAX(ingestion_timestamp) AS last_record, CAST(COUNT(DISTINCT id) AS DOUBLE) AS unique_coins,
  CAST(NULL AS DOUBLE) AS avg_price, CAST(NULL AS DOUBLE) AS total_market_cap, CAST(NULL AS DOUBLE) AS avg_market_cap
FROM bronze UNION ALL
SELECT 'silver', COUNT(*), MIN(silver_ingestion_time), MAX(silver_ingestion_time),
  CAST(COUNT(DISTINCT coin_id) AS DOUBLE),
  CAST(SUM(CAST(current_price_usd AS DECIMAL(18,2))) AS DOUBLE) / COUNT(current_price_usd),
  CAST(SUM(CAST(market_cap_usd AS DECIMAL(18,2))) AS DOUBLE), NULL
FROM silver UNION ALL
SELECT 'gold', COUNT(*), MIN(as_of_timestamp), MAX(as_of_timestamp), NULL, NULL, NULL,
  CAST(SUM(CAST(total_market_cap_usd AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*)
FROM gold""",
)
def layer_stats(spark, sf_dir):
    """The coin count is NULL for gold; shown as DOUBLE."""
    return monitor.layer_stats(_layers(spark, sf_dir)).withColumn("unique_coins", F.col("unique_coins").cast("double"))


_FRESHNESS = f"""
SELECT CASE WHEN newest_at IS NULL THEN 'ERROR' ELSE 'WARNING' END AS level, 'freshness' AS "check", layer AS subject,
  CAST(date_sub('second', newest_at, {_AS_OF}) AS DOUBLE) AS observed, CAST(7200 AS DOUBLE) AS threshold
FROM (SELECT 'bronze' AS layer, MAX(ingestion_timestamp) AS newest_at FROM bronze
  UNION ALL SELECT 'silver', MAX(silver_ingestion_time) FROM silver) AS newest
WHERE newest_at IS NULL OR date_sub('second', newest_at, {_AS_OF}) > 7200"""


@query("freshness_check", _CTE + _FRESHNESS)
def freshness_check(spark, sf_dir):
    layers = _layers(spark, sf_dir)[:2]
    return monitor.freshness_check(layers, _as_of(spark, sf_dir)).select(*_COLUMNS)


_ROW_COUNT = """
SELECT 'WARNING' AS level, 'row_count' AS "check", layer AS subject, CAST(n AS DOUBLE) AS observed,
  CAST(floor AS DOUBLE) AS threshold
FROM (SELECT 'bronze' AS layer, COUNT(*) AS n, 10 AS floor FROM bronze
  UNION ALL SELECT 'silver', COUNT(*), 1000000000000 FROM silver
  UNION ALL SELECT 'gold', COUNT(*), 1 FROM gold) AS counted
WHERE n < floor"""


@query("row_count_check", _CTE + _ROW_COUNT)
def row_count_check(spark, sf_dir):
    return monitor.row_count_check(_layers(spark, sf_dir), LIMITS).select(*_COLUMNS)


_NULLS = (
    """
SELECT 'WARNING' AS level, 'nulls' AS "check", subject, observed, CAST(10 AS DOUBLE) AS threshold FROM ("""
    + " UNION ALL ".join(
        f"SELECT '{la}.{c}' AS subject, {_percent_sql(c)} AS observed FROM {la}" for la, c in _NULL_ROWS
    )
    + ") AS percents WHERE observed > 10"
)


@query("null_check", _CTE + _NULLS)
def null_check(spark, sf_dir):
    return monitor.null_check(_layers(spark, sf_dir)[1:]).select(*_COLUMNS)


def _retention(kept: str) -> str:
    return f"""
SELECT 'WARNING' AS level, 'retention' AS "check", 'silver/bronze' AS subject, observed,
  CAST(0.9 AS DOUBLE) AS threshold
FROM (SELECT CAST((SELECT COUNT(DISTINCT {kept}) FROM silver) AS DOUBLE)
  / NULLIF((SELECT COUNT(DISTINCT id) FROM bronze), 0) AS observed) AS ratio
WHERE observed < CAST(0.9 AS DOUBLE)"""


@query(
    "layer_retention",
    _CTE + _retention("CASE WHEN NOT regexp_matches(coin_id, '[789]$') THEN coin_id END"),
)
def layer_retention(spark, sf_dir):
    layers = bronze_layer(bronze(spark, sf_dir)), silver_layer(_lossy_silver(spark, sf_dir))
    return monitor.layer_retention(*layers).select(*_COLUMNS)


_RECONCILIATION = """
SELECT 'WARNING' AS level, 'cap_reconciliation' AS "check", 'gold/silver' AS subject, observed,
  CAST(1 AS DOUBLE) AS threshold
FROM (
  SELECT abs((actual - reported) / NULLIF(actual, 0) * 100) AS observed FROM (
    SELECT (SELECT CAST(SUM(CAST(market_cap_usd AS DECIMAL(18,2))) AS DOUBLE) FROM silver
        WHERE silver_ingestion_time = (SELECT MAX(as_of_timestamp) FROM gold)) AS actual,
      (SELECT total_market_cap_usd FROM gold ORDER BY as_of_timestamp DESC LIMIT 1) AS reported) AS pair) AS found
WHERE observed > 1"""


@query("cap_reconciliation", _CTE + _RECONCILIATION)
def cap_reconciliation(spark, sf_dir):
    found = monitor.cap_reconciliation(silver(spark, sf_dir), gold(spark, sf_dir))
    return found.select(*_COLUMNS)


def _duration(name: str, as_of: str) -> str:
    return f"""
SELECT CASE WHEN end_time IS NULL THEN 'ERROR' ELSE 'WARNING' END AS level, 'run_duration' AS "check",
  run_id AS subject, seconds AS observed, average * 1.5 AS threshold
FROM (
  SELECT run_id, end_time, duration_seconds AS seconds,
    CAST(SUM(CAST(duration_seconds AS DECIMAL(18,2))) OVER () AS DOUBLE) / COUNT(duration_seconds) OVER () AS average,
    ROW_NUMBER() OVER (ORDER BY start_time DESC, run_id DESC, end_time DESC NULLS LAST) AS n
  FROM runs
  WHERE pipeline_name = '{name}' AND start_time >= CAST({as_of} AS DATE) - INTERVAL 7 DAY) AS recent
WHERE n = 1 AND (end_time IS NULL OR seconds > average * 1.5)"""


_LAST_START = "(SELECT MAX(start_time) FROM runs)"


def _last_start(spark, sf_dir):
    return runs(spark, sf_dir).agg(F.max("start_time")).scalar()


@query(
    "run_duration_check",
    _CTE + _duration(NAME, _LAST_START) + "\nUNION ALL" + _duration("other", _LAST_START),
)
def run_duration_check(spark, sf_dir):
    log, as_of = runs(spark, sf_dir), _last_start(spark, sf_dir)
    both = [monitor.run_duration_check(log, as_of, name) for name in (NAME, "other")]
    return both[0].unionByName(both[1]).select(*_COLUMNS)


@query(
    "recent_runs",
    _CTE
    + f"""
SELECT run_id, start_time, records_processed FROM runs
WHERE pipeline_name = '{NAME}' AND start_time >= CAST({_LAST_START} AS DATE) - INTERVAL 7 DAY""",
)
def recent_runs(spark, sf_dir):
    found = monitor.recent_runs(runs(spark, sf_dir), _last_start(spark, sf_dir), name=NAME)
    return found.select("run_id", "start_time", "records_processed")


# The report looks at the run log as of the newest event; the runs ended years before, so the
# duration check has nothing to say there.
_REPORT = "\nUNION ALL".join(
    [_FRESHNESS, _ROW_COUNT, _NULLS, _retention("coin_id"), _RECONCILIATION, _duration(NAME, _AS_OF)]
)


def _report(spark, sf_dir):
    return monitor.health_report(
        bronze(spark, sf_dir),
        silver(spark, sf_dir),
        gold(spark, sf_dir),
        runs(spark, sf_dir),
        _as_of(spark, sf_dir),
        NAME,
        LIMITS,
    )


@query("health_report", _CTE + _REPORT)
def health_report(spark, sf_dir):
    return _report(spark, sf_dir).select(*_COLUMNS)


@query(
    "health_status",
    _CTE
    + f""", report AS ({_REPORT})
SELECT CAST(COALESCE(MAX(CASE WHEN level = 'ERROR' THEN 1 ELSE 0 END), 0) AS INTEGER) AS status,
  COUNT(*) FILTER (WHERE level = 'ERROR') AS errors, COUNT(*) FILTER (WHERE level = 'WARNING') AS warnings
FROM report""",
)
def health_status(spark, sf_dir):
    return monitor.health_status(_report(spark, sf_dir))
