"""Publishing new contents of a table or of its partitions by one switch in the catalog.

Contents are first written whole to a version folder under the table's own folder, which readers do not list, and only
then take the place of the old ones. A failure before the switch leaves the old contents as they were; the folder of
the version before stays, so that running readers finish; a retention rule on the folder removes it.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketstrata.functions import quoted, text_literal
from marketstrata.operators.tables import aligned, description, partition_columns

_VERSIONS = "_versions"


def new_version(spark: SparkSession, table: str) -> str:
    """A folder for the next version of a table's contents, beside those of the versions before."""
    location = description(spark, table)["location"].rstrip("/")
    return f"{location.split(f'/{_VERSIONS}/')[0]}/{_VERSIONS}/{uuid.uuid4().hex}"


def _spec(columns: Sequence[str], values: Sequence) -> str:
    def literal(value) -> str:
        if value is None:
            return "null"
        if isinstance(value, dt.date):
            return f"date'{value.isoformat()}'"
        return text_literal(value) if isinstance(value, str) else str(value)

    return ", ".join(f"{quoted(c)} = {literal(v)}" for c, v in zip(columns, values, strict=True))


def switch_table(spark: SparkSession, table: str, path: str) -> None:
    spark.sql(f"ALTER TABLE {quoted(table)} SET LOCATION {text_literal(path)}")
    spark.catalog.refreshTable(table)


def switch_partitions(spark: SparkSession, table: str, folders: dict[str, str]) -> None:
    """Point each partition, named by its specification, at its new folder. Repeating it changes nothing."""
    if not folders:
        return
    added = " ".join(f"PARTITION ({spec}) LOCATION {text_literal(path)}" for spec, path in folders.items())
    spark.sql(f"ALTER TABLE {quoted(table)} ADD IF NOT EXISTS {added}")
    for spec, path in folders.items():
        spark.sql(f"ALTER TABLE {quoted(table)} PARTITION ({spec}) SET LOCATION {text_literal(path)}")
    spark.catalog.refreshTable(table)


def publish_table(df: DataFrame, table: str) -> None:
    """Replace all rows of an unpartitioned table. ``df`` may read the table itself; readers see the old or the new rows."""
    spark = df.sparkSession
    if partition_columns(spark, table):
        raise ValueError(f"{table} is partitioned; publish its partitions")
    path = new_version(spark, table)
    aligned(df, table, merge_schema=True).write.parquet(path)
    switch_table(spark, table, path)


def publish_partitions(df: DataFrame, table: str, balance: bool = True) -> int:
    """Replace exactly the partitions present in ``df``, each by one switch; returns their number.

    ``df`` may read the table itself. ``balance`` adds a shuffle that gives every partition well-sized files; turn it
    off where the rows of a partition are few or already spread. Only partition values and paths pass the driver.
    """
    spark = df.sparkSession
    columns = partition_columns(spark, table)
    rows = aligned(df, table, merge_schema=True)
    if balance:
        rows = rows.hint("rebalance", *[F.col(c) for c in columns])
    path = new_version(spark, table)
    rows.write.partitionBy(*columns).parquet(path)
    folders = written_folders(spark.read.schema(rows.schema).parquet(path), columns)
    switch_partitions(spark, table, folders)
    return len(folders)


def write_version(df: DataFrame, table: str, partition: dict) -> dict[str, str]:
    """Write the rows of one known partition to a version folder; returns what ``switch_partitions`` takes.

    For a caller that knows the partition: nothing is looked up in the written files, and it may still decide not to
    switch, for instance because no row was written.
    """
    spark = df.sparkSession
    path = new_version(spark, table)
    aligned(df, table, merge_schema=True).drop(*partition).write.parquet(path)
    return {_spec(list(partition), list(partition.values())): path}


def written_folders(written: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Specification and folder of each partition among written files; reads no data column."""
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("_folder")
    found = written.select(*columns, folder).distinct().collect()
    return {_spec(columns, row[:-1]): unquote(row["_folder"]) for row in found}


# --- compaction -------------------------------------------------------------------------------


def file_bins(rows: DataFrame, columns: Sequence[str], target_bytes: int) -> DataFrame:
    """``columns, file, size, bin, files, bins``: the files of each partition dealt to bins of about ``target_bytes``.

    Files are taken by name; one belongs to the bin in which it begins, so a bin holds at most the target and one file.
    """
    files = rows.select(*columns, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).distinct()
    whole = Window.partitionBy(*columns)
    before = F.sum("size").over(whole.orderBy("file")) - F.col("size")
    binned = files.withColumn("bin", F.floor(before / target_bytes).cast("int"))
    return binned.withColumns({"files": F.count("*").over(whole), "bins": F.max("bin").over(whole) + 1})


def compact_table(spark: SparkSession, table: str, target_bytes: int = 128 << 20, where: Column | None = None, most: int = 500) -> int:
    """Rewrite the partitions whose files are more than their bins need, and switch each; returns how many were rewritten.

    The rows stay the same, their order does not. ``where`` restricts the look to some partitions; ``most`` bounds the
    partitions of one call, the fullest of files first, so a neglected table is worked off call by call. An
    unpartitioned table is one partition. Sizes come from file metadata, so looking reads no data.
    """
    spark.catalog.refreshTable(table)
    columns = partition_columns(spark, table)
    rows = spark.read.table(table) if where is None else spark.read.table(table).filter(where)
    binned = file_bins(rows, columns, target_bytes)
    loose = binned.filter("files > bins").groupBy(*columns).agg(F.max("files").alias("_files"))
    chosen = loose.filter("_files is not null").orderBy(F.desc("_files"), *columns).limit(most).collect()
    if not chosen:
        return 0
    same = [reduce(and_, [F.col(c).eqNullSafe(F.lit(row[c])) for c in columns], F.lit(True)) for row in chosen]
    picked = rows.filter(reduce(or_, same)) if columns else rows
    bins = binned.select(F.col("file").alias("_file"), F.col("bin").alias("_bin"))
    dealt = picked.withColumn("_file", F.col("_metadata.file_path")).join(bins, "_file")
    dealt = dealt.repartition(*columns, "_bin").drop("_file", "_bin")
    if columns:
        publish_partitions(dealt, table, balance=False)
    else:
        publish_table(dealt, table)
    return len(chosen)
