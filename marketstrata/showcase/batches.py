"""Picking runs, batches and log rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketstrata.operators import batches
from marketstrata.showcase.standins import BRONZE_CTE, RUNS_CTE, SILVER_CTE, bronze, query, runs, silver

_BRONZE_SQL = "WITH" + BRONZE_CTE


@query(
    "latest_run",
    _BRONZE_SQL
    + """
SELECT event_id, id, current_price, pipeline_run_id FROM bronze WHERE pipeline_run_id =
  (SELECT pipeline_run_id FROM bronze ORDER BY ingestion_timestamp DESC, pipeline_run_id DESC LIMIT 1)""",
)
def latest_run(spark, sf_dir):
    return batches.latest_run(bronze(spark, sf_dir)).select("event_id", "id", "current_price", "pipeline_run_id")


@query(
    "latest_batch",
    "WITH"
    + SILVER_CTE
    + """
SELECT event_id, coin_id, market_cap_usd, silver_ingestion_time FROM silver
WHERE silver_ingestion_time = (SELECT MAX(silver_ingestion_time) FROM silver)""",
)
def latest_batch(spark, sf_dir):
    rows = batches.latest_batch(silver(spark, sf_dir))
    return rows.select("event_id", "coin_id", "market_cap_usd", "silver_ingestion_time")


@query("distinct_runs", _BRONZE_SQL + "SELECT DISTINCT pipeline_run_id FROM bronze")
def distinct_runs(spark, sf_dir):
    return batches.distinct_runs(bronze(spark, sf_dir))


@query(
    "newest_rows",
    _BRONZE_SQL
    + """
SELECT event_id, id, ingestion_timestamp FROM bronze ORDER BY ingestion_timestamp DESC NULLS LAST, id LIMIT 5""",
)
def newest_rows(spark, sf_dir):
    return batches.newest_rows(bronze(spark, sf_dir)).select("event_id", "id", "ingestion_timestamp")


@query(
    "run_status",
    "WITH"
    + RUNS_CTE
    + """,
ordered AS (
  SELECT runs.*, ROW_NUMBER() OVER (PARTITION BY run_id ORDER BY end_time DESC NULLS LAST,
    start_time DESC, pipeline_name DESC, status DESC, records_processed DESC) AS n FROM runs)
SELECT run_id, pipeline_name, start_time, end_time, duration_seconds, status, records_processed, priority
FROM ordered WHERE n = 1""",
)
def run_status(spark, sf_dir):
    """Newest log row of every run id."""
    newest = batches.run_statuses(runs(spark, sf_dir))
    return newest.withColumn("priority", F.col("metadata")["priority"]).drop("metadata")
