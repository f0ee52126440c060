"""Table writes: each query writes to fresh tables in the shared folder and reads them back."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketstrata.contracts import BRONZE, PAYLOAD
from marketstrata.operators import tables
from marketstrata.operators.conform import conform_bronze, missing_columns
from marketstrata.operators.dedupe import dedupe_snapshot
from marketstrata.operators.runlog import append_run_log, counters_frame, observe_ingest
from marketstrata.session import fresh_path
from marketstrata.showcase.standins import (
    BRONZE_CTE,
    RUNS_CTE,
    bronze,
    moment,
    plain,
    query,
    runs,
    scratch_schema,
    table,
)

_DAY = "strftime(ts, '%Y-%m-%d')"


def _events(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    return rows.withColumn("pipeline_run_id", F.date_format("ts", "yyyy-MM-dd"))


@query("write_modes", f"SELECT event_id, value, {_DAY} AS pipeline_run_id FROM events")
def write_modes(spark, sf_dir):
    """Overwrite with January's first half, append the second; ignore and error add nothing."""
    name = f"{scratch_schema(spark)}.modes"
    rows = _events(spark, sf_dir).select("event_id", "value", "ts", "pipeline_run_id")
    early, late = rows.filter(F.col("ts") < moment("2024-01-16")), rows.filter(F.col("ts") >= moment("2024-01-16"))
    now = moment("2024-02-01")
    tables.write_table(early, name, "overwrite", partition_by=["pipeline_run_id"], now=now)
    tables.write_table(late, name, "append", now=now)
    tables.write_table(rows, name, "ignore", now=now)
    try:
        tables.write_table(rows, name, "error", now=now)
    except AnalysisException:
        return tables.read_table(spark, name).select("event_id", "value", "pipeline_run_id")
    raise AssertionError("mode error must refuse an existing table")


@query(
    "insert_only_merge",
    """
SELECT event_id, ts, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN value ELSE value + 1000 END AS value FROM events""",
)
def insert_only_merge(spark, sf_dir):
    """The 15th is in both sides: its stored versions stay, later ones are inserted."""
    name = f"{scratch_schema(spark)}.versions"
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    tables.create_from(rows.filter(F.col("ts") < moment("2024-01-16")), name)
    updates = rows.filter(F.col("ts") >= moment("2024-01-15")).withColumn("value", F.col("value") + 1000)
    tables.insert_only_merge(updates, name, ["event_id", "ts"])
    return tables.read_table(spark, name)


@query(
    "overwrite_run_partition",
    f"""
SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN value * 2 ELSE value END AS value,
  {_DAY} AS pipeline_run_id FROM events""",
)
def overwrite_run_partition(spark, sf_dir):
    """All runs are written, then those from the 20th on are replaced."""
    name = f"{scratch_schema(spark)}.runs"
    rows = _events(spark, sf_dir).select("event_id", "value", "pipeline_run_id")
    tables.overwrite_partitions(rows, name, ["pipeline_run_id"])
    again = rows.filter(F.col("pipeline_run_id") >= "2024-01-20").withColumn("value", F.col("value") * 2)
    tables.overwrite_partitions(again, name, ["pipeline_run_id"])
    return tables.read_table(spark, name)


@query(
    "evolve_schema",
    """
SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN value END AS value,
  CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN props END AS props FROM events""",
)
def evolve_schema(spark, sf_dir):
    """The second batch lacks ``value`` and brings ``props``."""
    name = f"{scratch_schema(spark)}.evolving"
    rows = table(spark, sf_dir, "events")
    early, late = rows.filter(F.col("ts") < moment("2024-01-16")), rows.filter(F.col("ts") >= moment("2024-01-16"))
    tables.write_table(early.select("event_id", "value"), name, "overwrite", overwrite_schema=True, stamp=False)
    tables.write_table(late.select("event_id", "props"), name, "append", merge_schema=True, stamp=False)
    return tables.read_table(spark, name)


@query(
    "union_batches",
    """
SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN value END AS value,
  CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN props END AS props FROM events""",
)
def union_batches(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    early, late = rows.filter(F.col("ts") < moment("2024-01-16")), rows.filter(F.col("ts") >= moment("2024-01-16"))
    return tables.evolve_union(early.select("event_id", "value"), late.select("event_id", "props"))


@query("create_typed_table", f"SELECT CAST(event_id AS VARCHAR) AS id, value AS price, {_DAY} AS day FROM events")
def create_typed_table(spark, sf_dir):
    """An empty partitioned table with comment and properties, filled afterwards."""
    name = f"{scratch_schema(spark)}.typed"
    schema = T.StructType(
        [
            T.StructField("id", T.StringType(), False),
            T.StructField("price", T.DoubleType()),
            T.StructField("day", T.StringType()),
        ]
    )
    for _ in range(2):
        tables.create_typed_table(spark, name, schema, ["day"], "prices by day", {"layer": "bronze"})
    rows = _events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("id"),
        F.col("value").alias("price"),
        F.col("pipeline_run_id").alias("day"),
    )
    tables.write_table(rows, name, "append", stamp=False)
    return tables.read_table(spark, name)


@query(
    "append_run_log",
    "WITH"
    + RUNS_CTE
    + """
SELECT run_id, pipeline_name, start_time, end_time, duration_seconds, status, records_processed, priority
FROM runs""",
)
def append_run_log_(spark, sf_dir):
    """Two appends, the first of which creates the log."""
    name = f"{scratch_schema(spark)}.run_log"
    rows = runs(spark, sf_dir)
    append_run_log(rows.filter(F.col("end_time").isNotNull()), name)
    append_run_log(rows.filter(F.col("end_time").isNull()), name)
    stored = tables.read_table(spark, name).withColumn("priority", F.col("metadata")["priority"])
    return plain(
        stored.select(
            "run_id", "pipeline_name", "start_time", "end_time", "duration_seconds", "status",
            "records_processed", "priority",
        )
    )


@query("cluster_rewrite", "SELECT event_id, user_id, ts, value FROM events")
def cluster_rewrite(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return tables.cluster_rewrite(rows, fresh_path(spark, "clustered"), ["user_id", "ts"])


@query(
    "table_stats",
    f"""
SELECT COUNT(*) AS row_count, CAST(4 AS BIGINT) AS column_count,
  COUNT(DISTINCT {_DAY}) AS partition_count, 'double' AS value_type, TIMESTAMP '2024-02-01' AS last_updated
FROM events""",
)
def table_stats(spark, sf_dir):
    name = f"{scratch_schema(spark)}.counted"
    rows = _events(spark, sf_dir).select("event_id", "value", "ts", "pipeline_run_id")
    tables.create_from(rows, name, ["pipeline_run_id"])
    tables.collect_statistics(spark, name, ["event_id", "value"])
    stats = tables.table_stats(spark, name, moment("2024-02-01"))
    return stats.withColumn("value_type", F.col("columns")["value"]).drop("table_name", "columns")


@query(
    "layer_inventory",
    f"""
SELECT 'bronze' AS table_name, 'parquet' AS provider, COUNT(*) AS row_count,
  COUNT(DISTINCT {_DAY}) AS partition_count, 'pipeline_run_id=' || MIN({_DAY}) AS first_partition FROM events
UNION ALL
SELECT 'run_log', 'parquet', COUNT(*), 0, NULL FROM orders""",
)
def layer_inventory(spark, sf_dir):
    schema = scratch_schema(spark)
    tables.create_from(_events(spark, sf_dir), f"{schema}.bronze", ["pipeline_run_id"])
    tables.create_from(runs(spark, sf_dir), f"{schema}.run_log")
    found = tables.layer_inventory(spark, schema)
    first = F.try_element_at("first_partitions", F.lit(1))
    return found.withColumn("first_partition", first).drop("location", "first_partitions")


@query(
    "ingest_counters",
    "WITH"
    + BRONZE_CTE
    + """,
kept AS (SELECT DISTINCT pipeline_run_id, id FROM bronze)
SELECT COUNT(*) AS records_processed, (SELECT COUNT(*) FROM kept) AS records_saved,
  COUNT(*) - (SELECT COUNT(*) FROM kept) AS duplicates_removed, CAST(30 AS BIGINT) AS columns_processed,
  CAST(20 AS BIGINT) AS missing_columns
FROM bronze""",
)
def ingest_counters(spark, sf_dir):
    """Counters of a deduplicated write, taken while it runs."""
    rows = bronze(spark, sf_dir)
    unique = dedupe_snapshot(conform_bronze(rows), ["pipeline_run_id", "id"], copies="copies")
    counted = Observation("ingest-counters")
    observe_ingest(unique, "copies", counted).write.parquet(fresh_path(spark, "ingest"))
    absent = missing_columns(rows, PAYLOAD.fieldNames())
    found = counters_frame(spark, counted, absent, len(BRONZE.fields))
    return found.withColumn("missing_columns", F.size("missing_columns").cast("bigint"))
