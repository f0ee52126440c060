"""One hourly run: bronze, silver, gold, monitoring, run log.

Each layer is written once and the next one reads the table. All clocks are arguments.
"""

from __future__ import annotations

import datetime as dt
import logging
import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketstrata.contracts import (
    ALERTS, BRONZE, BRONZE_TABLE, FIGURES, LEADERS, MERGE_KEYS, METRICS_TABLE, PAYLOAD, RUN_LOG, SILVER_TABLE, STATISTICS,
    VALIDATION, VERSION_MONTH,
)
from marketstrata.operators import rollup
from marketstrata.operators.conform import fit_contract, missing_columns, require_columns, silver_transform, stamp_batch
from marketstrata.operators.dedupe import dedupe_snapshot
from marketstrata.operators.leaders import gold_leaders
from marketstrata.operators.metrics import gold_metrics
from marketstrata.operators.monitor import DEFAULTS, Thresholds, bronze_layer, figures_report, gold_layer, silver_layer
from marketstrata.operators.publish import compact_table, publish_partitions, publish_table, switch_partitions, write_version
from marketstrata.operators.quality import RUN_RULES, flag_rows, flagged_report, require_valid, split_flagged, validation_summary
from marketstrata.operators.runlog import append_run_log, observe_ingest, run_record
from marketstrata.operators.tables import (
    MAX_DAYS,
    create_typed_table,
    drop_partition,
    ensure_schema,
    insert_only_merge,
    month_of,
    on_days,
    overwrite_partitions,
    write_table,
)
from marketstrata.session import stored

log = logging.getLogger(__name__)

RUN = "pipeline_run_id"


@dataclass(frozen=True)
class LayerTables:
    """Catalog names of the tables a run reads and writes."""

    bronze: str
    silver: str
    quarantine: str
    metrics: str
    leaders: str
    run_log: str
    alerts: str
    validation: str
    figures: str
    statistics: str

    @classmethod
    def under(cls, schema: str) -> LayerTables:
        return cls(
            f"{schema}.bronze_snapshots",
            f"{schema}.silver_coins",
            f"{schema}.silver_quarantine",
            f"{schema}.gold_market_metrics",
            f"{schema}.gold_top_performers",
            f"{schema}.run_log",
            f"{schema}.alerts",
            f"{schema}.run_validation",
            f"{schema}.layer_figures",
            f"{schema}.layer_statistics",
        )


@dataclass
class RunResult:
    run_id: str
    status: str = "FAILED"
    processed: int = 0
    saved: int = 0
    error: str | None = None
    metadata: dict[str, str] = field(default_factory=dict)


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def ensure_layers(spark: SparkSession, tables: LayerTables, location: str | None = None) -> None:
    """Create the schema and the typed tables that do not exist yet."""
    ensure_schema(spark, tables.bronze.rpartition(".")[0], location)
    create_typed_table(spark, tables.bronze, BRONZE_TABLE, [RUN], "append-only snapshot log")
    create_typed_table(spark, tables.silver, SILVER_TABLE, [VERSION_MONTH], "cleaned history, one row per coin version")
    create_typed_table(spark, tables.metrics, METRICS_TABLE, comment="one row per run")
    create_typed_table(spark, tables.leaders, LEADERS, comment="leaders of the newest batch")
    create_typed_table(spark, tables.validation, VALIDATION, [RUN], "broken rules of each run")
    create_typed_table(spark, tables.figures, FIGURES, comment="figures of each run and layer, which add up")
    create_typed_table(spark, tables.statistics, STATISTICS, comment="statistics of each layer")
    create_typed_table(spark, tables.run_log, RUN_LOG, comment="one row per run")
    create_typed_table(spark, tables.alerts, ALERTS, comment="alerts of the newest run")


def ingest_bronze(payload: DataFrame, tables: LayerTables, result: RunResult, now: dt.datetime) -> None:
    """Judge the payload as it came, then conform, deduplicate and write one run; counters come from the write itself.

    The rules see the values before they are typed, so text in a number, a fractional rank or an infinity is named in
    ``broken_rules`` although the typed column holds NULL.
    """
    judged = flag_rows(require_columns(stamp_batch(payload, now, result.run_id)), RUN_RULES, severity="any")
    absent = missing_columns(payload, PAYLOAD.fieldNames())
    counted = Observation("ingest")
    unique = dedupe_snapshot(fit_contract(judged, BRONZE_TABLE), [RUN, "id"], copies="_copies")
    # The deduplication already spread the single run over tasks; no second shuffle to balance it.
    rows = observe_ingest(unique, "_copies", counted)
    if RUN in payload.columns:
        publish_partitions(rows, tables.bronze, balance=False)
    else:
        written = write_version(rows, tables.bronze, {RUN: result.run_id})
        if counted.get["records_saved"]:
            switch_partitions(payload.sparkSession, tables.bronze, written)
    seen = counted.get
    result.processed, result.saved = int(seen["records_processed"]), int(seen["records_saved"])
    result.metadata = {
        "missing_columns": ",".join(absent),
        "duplicates_removed": str(seen["duplicates_removed"]),
        "columns_processed": str(len(BRONZE.fields)),
    }


def run_rows(spark: SparkSession, tables: LayerTables, run_id: str) -> DataFrame:
    return spark.read.table(tables.bronze).filter(F.col(RUN) == run_id)


def refine_silver(spark: SparkSession, tables: LayerTables, run_id: str, now: dt.datetime, strict: bool) -> DataFrame:
    """Count the broken rules of this run, quarantine the rows that broke an error rule, merge the rest into the history.

    Returns the run's valid rows in silver form, stored once: the merge and the gold layer both read them, so
    gold covers the run's whole market, also the coins whose version silver already has.
    """
    run = run_rows(spark, tables, run_id)
    # One row a rule, read once here for the table and for the verdict.
    counted = [(run_id, *row) for row in flagged_report(run).collect()]
    report = spark.createDataFrame(counted, VALIDATION)
    switch_partitions(spark, tables.validation, write_version(report.coalesce(1), tables.validation, {RUN: run_id}))
    # A run that is repaired must not keep the rows that were set aside before.
    drop_partition(spark, tables.quarantine, {RUN: run_id})
    good, bad = split_flagged(run)
    if strict:
        # Passing means that no row broke an error rule, so there is nothing to set aside.
        require_valid(validation_summary(report))
    else:
        overwrite_partitions(bad, tables.quarantine, [RUN])
    # Error rules reject NULL merge keys, so none are left among the good rows.
    versions = stored(silver_transform(good, now).withColumn(VERSION_MONTH, month_of("last_updated")), "run-versions")
    insert_only_merge(versions, tables.silver, MERGE_KEYS, keep_null_keys=False, day=VERSION_MONTH)
    return versions


def aggregate_gold(spark: SparkSession, tables: LayerTables, batch: DataFrame, run_id: str) -> None:
    """Metrics of a run's market in place of those it had; leaders of the newest batch.

    The metrics hold one row a run, so they are written anew as a whole and switched. The leaders are those of
    ``batch`` where it is the newest; where a repeated run has ceased to be it, they are taken anew from the run that is.
    """
    others = spark.read.table(tables.metrics).filter(~F.col(RUN).eqNullSafe(run_id))
    metrics = gold_metrics(batch).filter("as_of_timestamp is not null").withColumn(RUN, F.lit(run_id))
    publish_table(others.unionByName(metrics).coalesce(1), tables.metrics)
    at = F.col("as_of_timestamp")
    newest = spark.read.table(tables.metrics).orderBy(at.desc(), (F.col(RUN) == run_id).desc(), F.col(RUN).desc()).first()
    if newest is None:
        publish_table(spark.createDataFrame([], LEADERS), tables.leaders)
    elif newest[RUN] == run_id:
        publish_table(gold_leaders(batch), tables.leaders)
    elif spark.read.table(tables.leaders).filter(at == F.lit(newest["as_of_timestamp"])).isEmpty() and newest[RUN]:
        good, _ = split_flagged(run_rows(spark, tables, newest[RUN]))
        publish_table(gold_leaders(stored(silver_transform(good, newest["as_of_timestamp"]), "newest")), tables.leaders)


def record_figures(spark: SparkSession, tables: LayerTables, run_id: str, versions: DataFrame) -> None:
    """Store what this run holds in each layer. Reads the run's own partitions, also those of its earlier attempts."""
    read, moment = spark.read.table, utc_now()
    own = F.col(RUN) == run_id
    spark.catalog.refreshTable(tables.silver)
    earlier = read(tables.figures).filter(own & (F.col("layer") == "silver")).select(F.explode("days").alias(VERSION_MONTH))
    days = [r[0] for r in versions.select(VERSION_MONTH).union(earlier).distinct().limit(MAX_DAYS + 1).collect()]
    silver = read(tables.silver).filter(own)
    if len(days) <= MAX_DAYS:
        silver = silver.filter(F.col(VERSION_MONTH).isin(days) if days else F.lit(False))
    market = replace(silver_layer(versions), name="market")
    rows = [
        rollup.run_figures(bronze_layer(run_rows(spark, tables, run_id)), moment, run_id),
        rollup.run_figures(silver_layer(silver), moment, run_id, days if len(days) <= MAX_DAYS else None),
        rollup.run_figures(market, moment, run_id),
        rollup.run_figures(gold_layer(read(tables.metrics).filter(own)), moment, run_id),
    ]
    write_table(reduce(DataFrame.unionByName, rows).coalesce(1), tables.figures, "append", stamp=False)


def tend_tables(spark: SparkSession, tables: LayerTables, versions: DataFrame, max_files: int) -> None:
    """Compact what hourly appends leave in small files: the months of silver this run touched, run log and figures.

    Files are counted from listings, without a job; a table or month of at most ``max_files`` files is left alone.
    """
    for name in (tables.run_log, tables.figures):
        if len(spark.read.table(name).inputFiles()) > max_files:
            compact_table(spark, name)
    touched = spark.read.table(tables.silver).filter(on_days(versions, VERSION_MONTH))
    folders = Counter(re.search(f"{VERSION_MONTH}=([^/]*)", file)[1] for file in touched.inputFiles())
    full = [month for month, files in folders.items() if files > max_files]
    if full:
        compact_table(spark, tables.silver, where=F.col(VERSION_MONTH).cast("string").isin(full))


def check_health(spark: SparkSession, tables: LayerTables, now: dt.datetime, name: str, limits: Thresholds) -> DataFrame:
    """Alerts of all checks, each guarded by itself, and the statistics of each layer, from the stored figures alone."""
    read = spark.read.table
    layers = [bronze_layer(None), silver_layer(None), gold_layer(None)]

    def totals() -> tuple[DataFrame, DataFrame]:
        markets = rollup.newest_attempts(read(tables.figures)).filter("layer = 'market' and row_count > 0")
        return markets.select(RUN, F.col("cap_sum").alias("total")), read(tables.metrics).select(RUN, F.col("total_market_cap_usd").alias("total"))

    # Three rows, added up once for all checks.
    held: list[DataFrame] = []

    def figures() -> DataFrame:
        if not held:
            summed = rollup.add_figures(read(tables.figures), layers)
            held.append(spark.createDataFrame(summed.collect(), summed.schema))
        return held[0]

    alerts = figures_report(spark, figures, totals, lambda: read(tables.run_log), now, name, limits)
    publish_table(alerts.coalesce(1), tables.alerts)
    if held:
        publish_table(rollup.coined(held[0], layers).coalesce(1), tables.statistics)
    return alerts


def hourly_run(
    spark: SparkSession,
    payload: DataFrame,
    tables: LayerTables,
    run_id: str,
    now: dt.datetime | None = None,
    name: str = "market_hourly",
    strict: bool = True,
    limits: Thresholds = DEFAULTS,
    clock: Callable[[], dt.datetime] = utc_now,
    location: str | None = None,
    max_files: int = 48,
) -> RunResult:
    """Run all layers for one payload and log the run.

    An empty payload gives ``SKIPPED``. Any failure is logged as ``FAILED`` and raised. Running
    the same ``run_id`` again, with any clock and rows, replaces what it has in bronze, quarantine, validation and gold,
    and adds to silver only versions that are new; a run that is late or unlike the newest is still refined as itself.
    Old partitions of bronze and silver are not read: monitoring adds up the figures that each run has stored.
    Tables or months of more than ``max_files`` files are compacted after the run.
    ``strict`` fails a run with error-level rows; otherwise they are only quarantined.
    """
    started = clock()
    now = now or started
    result = RunResult(run_id)
    batch: DataFrame | None = None
    ensure_layers(spark, tables, location)
    try:
        ingest_bronze(payload, tables, result, now)
        if result.saved == 0:
            result.status = "SKIPPED"
        else:
            batch = refine_silver(spark, tables, run_id, now, strict)
            aggregate_gold(spark, tables, batch, run_id)
            record_figures(spark, tables, run_id, batch)
            result.status = "SUCCESS"
    except Exception as problem:
        result.error = str(problem)
        log.error("run %s failed: %s", run_id, result.error)
        raise
    finally:
        record = run_record(
            spark, run_id, name, started, clock(), result.status, result.processed, result.saved,
            processing_status=result.status, error=result.error, metadata=result.metadata,
        )
        append_run_log(record, tables.run_log)
    if batch is not None:
        tend_tables(spark, tables, batch, max_files)
    check_health(spark, tables, now, name, limits)
    return result
