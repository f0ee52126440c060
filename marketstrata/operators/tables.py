"""Writing, merging and tending catalog tables stored as Parquet.

Parquet tables have no transactions: two concurrent writers of one table are not isolated, so
run one writer at a time, as an hourly schedule does.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketstrata.functions import quoted, text_literal
from marketstrata.operators.conform import missing_columns, stamp_batch
from marketstrata.operators.dedupe import dedupe_snapshot

log = logging.getLogger(__name__)

MODES = ("append", "overwrite", "ignore", "error", "errorifexists")

#: Days named one by one in a merge's filter; updates that touch more are bounded by their first and last day.
MAX_DAYS = 1000


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the schema if absent; with a location its managed tables live there."""
    where = f" LOCATION {text_literal(location)}" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(name)}{where}")


def table_exists(spark: SparkSession, table: str) -> bool:
    """False only for an absent table; any other problem raises."""
    return spark.catalog.tableExists(table)


def read_table(spark: SparkSession, table: str | None = None, default: str | None = None) -> DataFrame:
    """Scan ``table`` or the default; ``ValueError`` if neither is named."""
    name = table or default
    if not name:
        raise ValueError("no table named and no default set")
    return spark.read.table(name)


def create_typed_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    partition_columns: list[str] | None = None,
    comment: str | None = None,
    properties: dict[str, str] | None = None,
) -> None:
    """Create an empty Parquet table with these types; nothing happens if it exists."""
    absent = [c for c in partition_columns or [] if c not in schema.fieldNames()]
    if absent:
        raise ValueError(f"partition columns not in the schema: {', '.join(absent)}")
    columns = ", ".join(
        f"{quoted(field.name)} {field.dataType.simpleString()}{'' if field.nullable else ' NOT NULL'}"
        for field in schema.fields
    )
    clauses = [f"CREATE TABLE IF NOT EXISTS {quoted(table)} ({columns}) USING parquet"]
    if partition_columns:
        clauses.append(f"PARTITIONED BY ({', '.join(quoted(c) for c in partition_columns)})")
    if comment:
        clauses.append(f"COMMENT {text_literal(comment)}")
    if properties:
        pairs = ", ".join(f"{text_literal(k)} = {text_literal(v)}" for k, v in properties.items())
        clauses.append(f"TBLPROPERTIES ({pairs})")
    spark.sql(" ".join(clauses))


def create_from(df: DataFrame, table: str, partition_by: list[str] | None = None) -> None:
    """Create or replace ``table`` with the rows and schema of ``df``."""
    write_table(df, table, "overwrite", overwrite_schema=True, partition_by=partition_by, stamp=False)


def write_table(
    df: DataFrame,
    table: str,
    mode: str = "append",
    merge_schema: bool = False,
    overwrite_schema: bool = False,
    partition_by: list[str] | None = None,
    now: dt.datetime | Column | None = None,
    run_id: str | None = None,
    stamp: bool = True,
    balance: bool = True,
) -> None:
    """Write ``df`` to ``table`` with a save mode, stamping batch metadata where absent.

    A partitioned write is balanced first: one shuffle gives every partition well-sized files
    instead of one per task, and AQE splits a partition that holds most rows. Turn ``balance``
    off where all rows belong to one partition anyway.

    ``append`` to a table with other columns evolves the table: new columns are added to it and
    absent ones are written as NULL (asked for with ``merge_schema``, otherwise with a warning).
    A plain ``overwrite`` keeps the columns of the table in the same way; ``overwrite_schema``
    replaces them. Columns never change type silently.
    """
    mode = mode.lower()
    if mode not in MODES:
        raise ValueError(f"unknown save mode {mode!r}; expected one of {', '.join(MODES)}")
    spark = df.sparkSession
    if stamp:
        df = stamp_batch(df, now, run_id)
    absent = missing_columns(df, partition_by or [])
    if absent:
        raise ValueError(f"partition columns not in the data: {', '.join(absent)}")
    if table_exists(spark, table):
        if mode == "ignore":
            return
        if mode == "append" or (mode == "overwrite" and not overwrite_schema):
            df = aligned(df, table, merge_schema)
            partition_by = partition_by or partition_columns(spark, table)
    if partition_by and balance:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.format("parquet").mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def aligned(df: DataFrame, table: str, merge_schema: bool) -> DataFrame:
    """``df`` in the column order of ``table``, after adding to the table what only ``df`` has."""
    spark = df.sparkSession
    target = spark.read.table(table).schema
    known = {field.name: field.dataType for field in target.fields}
    given = {field.name: field.dataType for field in df.schema.fields}
    for name in given.keys() & known.keys():
        if not _writable(given[name], known[name]):
            raise ValueError(
                f"column {name} of {table} is {known[name].simpleString()}, "
                f"the data has {given[name].simpleString()}"
            )
    added = [field for field in df.schema.fields if field.name not in known]
    lacking = [name for name in known if name not in given]
    if (added or lacking) and not merge_schema:
        log.warning("columns of %s differ from the data; merging: +%s -%s", table, [f.name for f in added], lacking)
    if added:
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {quoted(table)} ADD COLUMNS ({columns})")
        target = spark.read.table(table).schema
    return df.select(
        *[
            F.col(f.name).cast(f.dataType) if f.name in given else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )


def _writable(given: T.DataType, known: T.DataType) -> bool:
    """Equal types, a typeless NULL, or a number that the known type holds without loss."""
    have, want = given.simpleString(), known.simpleString()
    for widening in (["tinyint", "smallint", "int", "bigint"], ["tinyint", "smallint", "int", "double"], ["float", "double"]):
        if have in widening and want in widening:
            return widening.index(have) <= widening.index(want)
    if isinstance(given, T.DecimalType) and isinstance(known, T.DecimalType):
        return given.scale <= known.scale and given.precision - given.scale <= known.precision - known.scale
    return have in (want, "void")


def evolve_union(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by name of batches with differing columns; absent columns are NULL."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return description(spark, table).get("partition_columns", [])


def description(spark: SparkSession, table: str) -> dict:
    """What the catalog knows about a table; reads no data and runs no job."""
    return json.loads(spark.sql(f"DESCRIBE EXTENDED {quoted(table)} AS JSON").first()[0])


def new_versions(
    updates: DataFrame,
    target: DataFrame,
    keys: list[str],
    range_key: str | None = None,
    keep_null_keys: bool = True,
    day: str | None = None,
) -> DataFrame:
    """Rows of ``updates`` whose key is not in ``target`` yet, one per key.

    A NULL in a key never matches, so such rows are always new; they bypass the join, where
    they would all meet in one task. ``keep_null_keys=False`` leaves them out and saves a scan.
    ``range_key`` (by default the last key) bounds the scan of the target: only values between
    the least and greatest of the updates can match. The two bounds are fetched first, so that
    the filter is constant and skips partitions and row groups of an ordered history.

    ``day`` names a column of both sides, the day (or month) of ``range_key``, by which the target is partitioned. Then only
    the partitions of the very days that the updates hold are read, however far apart they are, and the target's
    keys are first reduced to those among the updates: by a broadcast where these are few, otherwise by Spark's own
    run-time filter and join.
    """
    range_key = range_key or keys[-1]
    whole = reduce(and_, [F.col(key).isNotNull() for key in keys])
    keyed = updates.filter(whole)
    fresh = dedupe_snapshot(keyed, keys, newest=range_key)
    if day:
        near = target.filter(on_days(keyed, day)).select(*keys).join(keyed.select(*keys), keys, "left_semi")
    else:
        near = target.filter(F.col(range_key).between(*_bounds(keyed, range_key)))
    # Distinct on the map side: copies of one key in the target do not pile up in a task.
    known = near.select(*keys).distinct()
    new = fresh.join(known, keys, "left_anti").select(*updates.columns)
    return new.unionByName(updates.filter(~whole)) if keep_null_keys else new


def day_of(column: str | Column) -> Column:
    """The UTC day of an instant, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(column) / F.lit(86_400_000_000)).cast("int"))


def month_of(column: str | Column) -> Column:
    """The first day of an instant's UTC month: partitions that an hourly feed fills well and a merge prunes by."""
    return F.trunc(day_of(column), "month")


def on_days(rows: DataFrame, day: str) -> Column:
    """A constant filter on ``day`` that holds for all days of ``rows``; beyond ``MAX_DAYS`` of them for the span they cover."""
    days = [r[0] for r in rows.select(day).filter(F.col(day).isNotNull()).distinct().limit(MAX_DAYS + 1).collect()]
    if len(days) > MAX_DAYS:
        return F.col(day).between(*[F.lit(d) for d in rows.agg(F.min(day), F.max(day)).first()])
    return F.col(day).isin(sorted(days)) if days else F.lit(False)


def _bounds(df: DataFrame, column: str) -> tuple[Column, Column]:
    """Least and greatest value as literals; instants travel as microseconds, free of time zones."""
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, T.TimestampType):
        low, high = df.agg(F.unix_micros(F.min(value)), F.unix_micros(F.max(value))).first()
        return F.timestamp_micros(F.lit(low).cast("bigint")), F.timestamp_micros(F.lit(high).cast("bigint"))
    low, high = df.agg(F.min(value), F.max(value)).first()
    return F.lit(low).cast(kind), F.lit(high).cast(kind)


def insert_only_merge(
    updates: DataFrame,
    table: str,
    keys: list[str],
    range_key: str | None = None,
    keep_null_keys: bool = True,
    day: str | None = None,
) -> None:
    """Append the new versions among ``updates``; stored versions never change.

    Running it again with the same updates adds nothing (except rows with a NULL key; send
    those to quarantine first). ``updates`` is evaluated once for its bounds and once for its
    rows, so store it first where it is costly to compute. ``day`` is the date column the table is
    partitioned by; it is taken from ``range_key`` where the updates lack it.
    """
    spark = updates.sparkSession
    if day and day not in updates.columns:
        updates = updates.withColumn(day, day_of(range_key or keys[-1]))
    if not table_exists(spark, table):
        create_typed_table(spark, table, updates.schema, [day] if day else None)
    # Another session may have written since this one listed the files.
    spark.catalog.refreshTable(table)
    fresh = new_versions(updates, spark.read.table(table), keys, range_key, keep_null_keys, day)
    write_table(fresh, table, "append", merge_schema=True, stamp=False)


def overwrite_partitions(df: DataFrame, table: str, partition_by: list[str], balance: bool = True) -> None:
    """Replace exactly the partitions present in ``df``; repeating it changes nothing.

    ``balance`` adds one shuffle that gives every partition well-sized files; AQE splits a
    partition that holds most rows.
    """
    spark = df.sparkSession
    if not table_exists(spark, table):
        columns = [f for f in df.schema.fields if f.name not in partition_by]
        columns += [df.schema[name] for name in partition_by]
        create_typed_table(spark, table, T.StructType(columns), partition_by)
    rows = aligned(df, table, merge_schema=True)
    if balance:
        rows = rows.hint("rebalance", *[F.col(c) for c in partition_by])
    with _dynamic_overwrite(spark):
        rows.write.mode("overwrite").insertInto(table)


def drop_partition(spark: SparkSession, table: str, partition: dict[str, str]) -> None:
    """Remove one partition, named by all its text columns, if it is there."""
    if table_exists(spark, table):
        named = ", ".join(f"{quoted(c)} = {text_literal(v)}" for c, v in partition.items())
        spark.sql(f"ALTER TABLE {quoted(table)} DROP IF EXISTS PARTITION ({named})")
        spark.catalog.refreshTable(table)


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Inserts into catalog tables take this mode from the session only, not from the writer."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def cluster_rewrite(source: DataFrame, path: str, columns: list[str], partitions: int | None = None) -> DataFrame:
    """Write ``source`` to ``path`` in ranges of ``columns``, each file sorted by them.

    The source partition breaks ties between equal keys, so a key with a third of all rows is cut
    over many files instead of filling one. Linear order, not a space-filling curve.
    """
    spread = source.withColumn("_part", F.spark_partition_id())
    cuts = [F.col(c) for c in [*columns, "_part"]]
    ranged = spread.repartitionByRange(partitions, *cuts) if partitions else spread.repartitionByRange(*cuts)
    ranged.drop("_part").sortWithinPartitions(*columns).write.parquet(path)
    return source.sparkSession.read.schema(source.schema).parquet(path)


def recluster_table(spark: SparkSession, table: str, columns: list[str], path: str) -> None:
    """Rewrite an unpartitioned table in clustered order under ``path`` and point the table at it."""
    if partition_columns(spark, table):
        raise ValueError("recluster each partition of a partitioned table with cluster_rewrite")
    cluster_rewrite(spark.read.table(table), path, columns)
    spark.sql(f"ALTER TABLE {quoted(table)} SET LOCATION {text_literal(path)}")
    spark.catalog.refreshTable(table)


def collect_statistics(spark: SparkSession, table: str, columns: list[str] | None = None) -> None:
    """Row count and size for the optimizer; also distinct counts and ranges of ``columns``."""
    spark.sql(f"ANALYZE TABLE {quoted(table)} COMPUTE STATISTICS")
    if columns:
        named = ", ".join(quoted(c) for c in columns)
        spark.sql(f"ANALYZE TABLE {quoted(table)} COMPUTE STATISTICS FOR COLUMNS {named}")


def table_stats(spark: SparkSession, table: str, as_of: dt.datetime | Column | None = None) -> DataFrame:
    """One row: name, row, column and partition count, time of the report, column types."""
    rows = spark.read.table(table)
    kinds = [v for f in rows.schema.fields for v in (F.lit(f.name), F.lit(f.dataType.simpleString()))]
    when = F.current_timestamp() if as_of is None else as_of if isinstance(as_of, Column) else F.lit(as_of)
    return rows.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(table).alias("table_name"),
        "row_count",
        F.lit(len(rows.columns)).cast("bigint").alias("column_count"),
        F.lit(_partition_count(spark, table)).cast("bigint").alias("partition_count"),
        when.alias("last_updated"),
        F.create_map(*kinds).alias("columns"),
    )


def _partition_count(spark: SparkSession, table: str) -> int:
    if not partition_columns(spark, table):
        return 0
    return spark.sql(f"SHOW PARTITIONS {quoted(table)}").count()


def layer_inventory(spark: SparkSession, schema: str, sample: int = 10) -> DataFrame:
    """One row per table of a schema: provider, location, rows, partitions and the first few of them.

    Only catalog metadata passes the driver; all rows are counted by one Spark job.
    """
    facts, counts = [], None
    for entry in spark.catalog.listTables(schema):
        if entry.isTemporary or entry.tableType == "VIEW":
            continue
        table = f"{schema}.{entry.name}"
        detail = description(spark, table)
        total, first = 0, []
        if detail.get("partition_columns"):
            names = spark.sql(f"SHOW PARTITIONS {quoted(table)}").orderBy("partition")
            total, first = names.count(), [row[0] for row in names.take(sample)]
        facts.append((entry.name, detail.get("provider"), detail.get("location"), total, first))
        counted = spark.read.table(table).agg(F.lit(entry.name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        counts = counted if counts is None else counts.unionByName(counted)
    shape = "table_name string, provider string, location string, partition_count bigint, first_partitions array<string>"
    known = spark.createDataFrame(facts, shape)
    if counts is None:
        return known.withColumn("row_count", F.lit(None).cast("bigint"))
    return known.join(F.broadcast(counts), "table_name")
