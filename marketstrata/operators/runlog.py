"""The log of pipeline runs and the counters that feed it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketstrata.contracts import RUN_LOG
from marketstrata.operators.conform import fit_contract
from marketstrata.operators.tables import create_typed_table, write_table


def run_record(
    spark: SparkSession,
    run_id: str,
    name: str,
    start: dt.datetime,
    end: dt.datetime | None,
    status: str,
    processed: int = 0,
    saved: int = 0,
    api_status: str | None = None,
    processing_status: str | None = None,
    error: str | None = None,
    metadata: dict[str, str] | None = None,
) -> DataFrame:
    """One run as a row of the run-log contract."""
    seconds = None if end is None else round((end - start).total_seconds(), 2)
    row = (
        run_id, name, start, end, seconds, status, processed, saved,
        api_status, processing_status, error, metadata or {},
    )
    return spark.createDataFrame([row], RUN_LOG)


def append_run_log(runs: DataFrame, table: str) -> None:
    """Append runs to the log, creating it on first use."""
    create_typed_table(runs.sparkSession, table, RUN_LOG, comment="one row per pipeline run")
    write_table(fit_contract(runs, RUN_LOG), table, "append", stamp=False)


def observe_ingest(deduped: DataFrame, copies: str, observation: Observation) -> DataFrame:
    """Count a deduplicated batch while it is being written; drops the ``copies`` column.

    The counters sit after the last shuffle, in the stage that writes. Spark counts each
    partition of that stage once, even if tasks are retried; counters in an earlier stage could
    be added twice when an executor is lost.
    """
    observed = deduped.observe(
        observation,
        F.coalesce(F.sum(copies), F.lit(0)).alias("records_processed"),
        F.count(F.lit(1)).alias("records_saved"),
        F.coalesce(F.sum(F.col(copies) - 1), F.lit(0)).alias("duplicates_removed"),
    )
    return observed.drop(copies)


def counters_frame(
    spark: SparkSession, observation: Observation, missing: list[str], columns: int
) -> DataFrame:
    """The observed counters of a finished write as one row."""
    seen = observation.get
    row = (
        int(seen["records_processed"]),
        int(seen["records_saved"]),
        int(seen["duplicates_removed"]),
        columns,
        missing,
    )
    shape = (
        "records_processed bigint, records_saved bigint, duplicates_removed bigint, "
        "columns_processed bigint, missing_columns array<string>"
    )
    return spark.createDataFrame([row], shape)
