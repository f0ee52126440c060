"""Incremental bronze to silver over landed snapshot files."""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marketstrata.contracts import BRONZE_TABLE, MERGE_KEYS, PAYLOAD, SILVER_TABLE, VERSION_MONTH
from marketstrata.functions import iso_instant
from marketstrata.operators.conform import fit_contract, require_columns, silver_transform
from marketstrata.operators.dedupe import dedupe_snapshot
from marketstrata.operators.publish import publish_partitions
from marketstrata.operators.quality import RUN_RULES, flag_rows, split_flagged
from marketstrata.operators.tables import (
    aligned,
    create_typed_table,
    insert_only_merge,
    month_of,
    on_days,
    overwrite_partitions,
)
from marketstrata.session import stored

RUN, MOVE = "pipeline_run_id", "move"
SHARE = "market_dominance"


def landed_snapshots(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Stream of snapshots landed under ``path/pipeline_run_id=<run>/``.

    Arrival time is the file's own, so a replay reproduces it. A run's files may land in any number of moves.
    """
    schema = T.StructType(PAYLOAD.fields + [T.StructField(RUN, T.StringType(), True)])
    reader = spark.readStream.schema(schema).option("multiLine", multi_line)
    landed = reader.json(path)
    return landed.withColumn("ingestion_timestamp", F.col("_metadata.file_modification_time"))


def land_rows(batch: DataFrame, table: str, move: str) -> list[str | None]:
    """Write a micro-batch, judged and typed, as the partitions of its runs and its move; returns the runs.

    A replayed micro-batch replaces its own partitions, so rows are never landed twice by one checkpoint.
    """
    spark = batch.sparkSession
    shape = T.StructType([*BRONZE_TABLE.fields, T.StructField(MOVE, T.StringType())])
    create_typed_table(spark, table, shape, [RUN, MOVE], "rows of each run and move, as they landed")
    rows = fit_contract(flag_rows(require_columns(batch), RUN_RULES, severity="any"), BRONZE_TABLE)
    publish_partitions(rows.withColumn(MOVE, F.lit(move)), table)
    return [r[0] for r in spark.read.table(table).filter(F.col(MOVE) == move).select(RUN).distinct().collect()]


def owned_versions(versions: DataFrame, own: DataFrame) -> DataFrame:
    """One row per merge key among the ``versions`` of some runs, of which ``own`` are the rows that silver has.

    A key stays with the run that silver has it from, while that run still holds it, and its row stays as it is but
    for the share, which is the one of ``versions``. Other keys go to one of the runs by rule.
    """
    key = [*MERGE_KEYS, RUN]
    kept = own.join(versions.select(*key, F.col(SHARE).alias("_share")), key).withColumn(SHARE, F.col("_share")).drop("_share")
    free = versions.filter(F.col("coin_id").isNotNull() & F.col("last_updated").isNotNull()).join(kept.select(*MERGE_KEYS), MERGE_KEYS, "left_anti")
    return kept.select(*versions.columns).unionByName(dedupe_snapshot(free, MERGE_KEYS, newest="last_updated"))


def correct_runs(versions: DataFrame, touched: DataFrame, runs: list, table: str) -> None:
    """Make silver hold, of ``runs``, what a single landing of all their rows would have given.

    ``versions`` are the runs' whole markets, ``touched`` every month any of their rows ever had. Runs that silver
    does not know are appended. Otherwise the months concerned are written anew with the other runs' rows as they are,
    and switched one by one; a month is at most the rows of some hundred runs.
    """
    spark = versions.sparkSession
    spark.catalog.refreshTable(table)
    mine = F.col(RUN).isin([r for r in runs if r is not None])
    near = spark.read.table(table).filter(on_days(touched, VERSION_MONTH))
    own = stored(near.filter(mine), "stream-own")
    if own.isEmpty():
        insert_only_merge(versions, table, MERGE_KEYS, keep_null_keys=False, day=VERSION_MONTH)
        return
    others = near.filter(~F.coalesce(mine, F.lit(False)))
    # A version that another run has brought stays with it.
    free = versions.join(others.select(*MERGE_KEYS).join(versions.select(*MERGE_KEYS), MERGE_KEYS, "left_semi").distinct(), MERGE_KEYS, "left_anti")
    now_own = stored(owned_versions(aligned(free, table, merge_schema=True), own), "stream-now")
    changed = own.exceptAll(now_own).unionByName(now_own.exceptAll(own)).select(VERSION_MONTH).distinct()
    months = [r[0] for r in changed.collect()]
    if not months:
        return
    here = F.col(VERSION_MONTH).isin(months)
    publish_partitions(others.filter(here).unionByName(now_own.filter(here)), table)
    left = {r[0] for r in others.filter(here).select(VERSION_MONTH).union(now_own.select(VERSION_MONTH)).distinct().collect()}
    for month in set(months) - left:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({VERSION_MONTH} = date'{month}')")
    spark.catalog.refreshTable(table)


def start_incremental_silver(
    landed: DataFrame,
    silver_table: str,
    quarantine_table: str,
    checkpoint: str,
    now: dt.datetime | None = None,
    landed_table: str | None = None,
) -> StreamingQuery:
    """Merge every landed snapshot into silver once per ``(coin_id, last_updated)``, then stop.

    Rows are first kept as they landed (``landed_table``, by default named after silver). When more of a run lands,
    its market is taken from all its moves: shares are those of the whole run, and a coin that came twice counts by
    its newest row, as if all had landed at once. Only the landed partitions of the runs in the micro-batch, their
    months of silver and their partition of the quarantine are read or written.

    Late rows are kept: the merge is keyed, not bounded by time. A micro-batch that is replayed after a crash, or
    all of them by a new checkpoint, change nothing: landed moves and quarantined runs are replaced, silver is keyed.
    A version that a run gives up, since a later move brought a newer row of the coin, is not looked for in runs
    that landed it too but came second.
    """
    landed_name = landed_table or f"{silver_table}_landed"
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        runs = land_rows(batch, landed_name, f"{stream}-{batch_id}")
        if not runs:
            return
        whole = spark.read.table(landed_name).filter(F.col(RUN).isin([r for r in runs if r is not None])).drop(MOVE)
        good, bad = split_flagged(whole)
        create_typed_table(spark, silver_table, SILVER_TABLE, [VERSION_MONTH])
        unique = dedupe_snapshot(good, [RUN, "id"])
        versions = silver_transform(unique, now, batch=RUN).withColumn(VERSION_MONTH, month_of("last_updated"))
        touched = good.select(month_of(F.expr(iso_instant("last_updated"))).alias(VERSION_MONTH))
        correct_runs(stored(versions, "stream-versions"), touched, runs, silver_table)
        held = F.to_json(F.struct(*bad.columns), {"ignoreNullFields": "false"})
        rejects = bad.withColumn("reject_id", F.sha2(held, 256)).dropDuplicates([RUN, "reject_id"])
        overwrite_partitions(rejects, quarantine_table, [RUN])

    writer = landed.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def run_incremental_silver(
    landed: DataFrame,
    silver_table: str,
    quarantine_table: str,
    checkpoint: str,
    now: dt.datetime | None = None,
    landed_table: str | None = None,
) -> None:
    """Merge what has landed, wait, and let the calling session see the new files.

    Micro-batches write in a session of their own, so the caller's list of files is stale.
    """
    start_incremental_silver(landed, silver_table, quarantine_table, checkpoint, now, landed_table).awaitTermination()
    catalog = landed.sparkSession.catalog
    for table in (silver_table, quarantine_table, landed_table or f"{silver_table}_landed"):
        if catalog.tableExists(table):
            catalog.refreshTable(table)
