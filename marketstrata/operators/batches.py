"""Picking runs and batches out of a history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketstrata.contracts import ARRIVAL_COLUMNS


def latest_run(
    df: DataFrame, run: str = "pipeline_run_id", arrival: list[str] | None = None, registry: DataFrame | None = None
) -> DataFrame:
    """Rows of the run that arrived last; equal arrival goes to the greatest run id.

    The run id is a scalar subquery, evaluated before the scan, so a table partitioned by run
    reads one partition. Without any arrival column the greatest run id is taken. ``registry`` has one row a
    recorded run with its ``last_record``; then the run is looked up there and no other run's rows are read.
    """
    if registry is not None:
        seen = F.when(F.col("last_record").isNotNull(), F.struct(F.col("last_record").alias("at"), F.col(run).alias("run")))
        return df.filter(F.col(run) == registry.agg(F.max(seen).getField("run")).scalar())
    when = next((c for c in arrival or ARRIVAL_COLUMNS if c in df.columns), None)
    if when is None:
        newest = df.agg(F.max(run))
    else:
        newest = df.agg(F.max(F.struct(F.col(when).alias("at"), F.col(run).alias("run"))).getField("run"))
    return df.filter(F.col(run) == newest.scalar())


def latest_batch(df: DataFrame, time: str = "silver_ingestion_time", registry: DataFrame | None = None) -> DataFrame:
    """Rows carrying the greatest ``time``; with a ``registry`` of ``last_record`` it is looked up there."""
    if registry is not None:
        return df.filter(F.col(time) == registry.agg(F.max("last_record")).scalar())
    return df.filter(F.col(time) == df.agg(F.max(time)).scalar())


def distinct_runs(df: DataFrame, run: str = "pipeline_run_id") -> DataFrame:
    return df.select(run).distinct()


def newest_rows(df: DataFrame, time: str = "ingestion_timestamp", n: int = 5, tie: str = "id") -> DataFrame:
    """The ``n`` newest rows; equal times are ordered by ``tie``."""
    return df.orderBy(F.col(time).desc_nulls_last(), F.col(tie).asc_nulls_last()).limit(n)


def run_status(log: DataFrame, run_id: str) -> DataFrame:
    """Newest log row of one run by ``end_time``; no rows if the run is unknown."""
    newest_first = [F.col("end_time").desc_nulls_last(), F.col("start_time").desc_nulls_last()]
    return log.filter(F.col("run_id") == run_id).orderBy(*newest_first).limit(1)


def run_statuses(log: DataFrame) -> DataFrame:
    """Newest log row of every run by ``end_time``, then ``start_time``."""
    ordered = [c for c in log.columns if c not in ("run_id", "end_time", "start_time", "metadata")]
    order = F.struct("end_time", "start_time", *ordered)
    newest = F.max_by(F.struct(*[c for c in log.columns if c != "run_id"]), order).alias("_row")
    return log.groupBy("run_id").agg(newest).select("run_id", "_row.*").select(*log.columns)


def recent_runs(log: DataFrame, as_of: dt.datetime | Column, days: int = 7, name: str | None = None) -> DataFrame:
    """Runs started on or after the date ``days`` before ``as_of`` (a date bound, so up to ``days`` + 1 days)."""
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of)
    kept = log.filter(F.col("start_time") >= F.date_sub(moment, days))
    return kept if name is None else kept.filter(F.col("pipeline_name") == name)
