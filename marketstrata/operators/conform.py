"""Projections onto the layer contracts (required columns, bronze, silver, batch stamps)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketstrata.contracts import BRONZE, REQUIRED_COLUMNS, SILVER, SILVER_NAMES
from marketstrata.functions import iso_instant, number, quoted
from marketstrata.operators.shares import market_share


def require_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Return ``df`` unchanged or raise ``ValueError`` naming the absent columns. No job runs."""
    absent = missing_columns(df, columns or REQUIRED_COLUMNS)
    if absent:
        raise ValueError(f"required columns missing: {', '.join(absent)}")
    return df


def missing_columns(df: DataFrame, expected: list[str]) -> list[str]:
    present = set(df.columns)
    return [name for name in expected if name not in present]


def fit_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """One projection: contract order, contract types, absent columns as typed NULLs.

    Uses ``try_cast``, so a value that does not fit its column becomes NULL; validate first
    where that must be noticed.
    """
    kinds = {field.name: field.dataType for field in df.schema.fields}
    return df.selectExpr(*[_fitted(field, kinds.get(field.name)) for field in contract.fields])


def _fitted(field: T.StructField, kind: T.DataType | None) -> str:
    name, wanted = quoted(field.name), field.dataType.simpleString()
    if kind is None:
        return f"cast(null as {wanted}) as {name}"
    if kind == field.dataType:
        return name
    return f"try_cast({name} as {wanted}) as {name}"


def stamp_batch(df: DataFrame, now: dt.datetime | Column | None = None, run_id: str | Column | None = None) -> DataFrame:
    """Add ``ingestion_timestamp`` and ``pipeline_run_id`` where absent.

    Both are arguments so that a re-run reproduces its rows; the defaults are the clock.
    """
    added: dict[str, Column] = {}
    if "ingestion_timestamp" not in df.columns:
        added["ingestion_timestamp"] = F.current_timestamp() if now is None else _literal(now)
    if "pipeline_run_id" not in df.columns:
        if run_id is None:
            run_id = f"run_{int(dt.datetime.now(dt.timezone.utc).timestamp())}"
        added["pipeline_run_id"] = _literal(run_id)
    return df.withColumns(added) if added else df


def conform_bronze(df: DataFrame) -> DataFrame:
    """Check the required columns and project onto the 30-column bronze contract."""
    return fit_contract(require_columns(df), BRONZE)


def silver_transform(
    bronze: DataFrame,
    now: dt.datetime | Column | None = None,
    batch: str | None = None,
) -> DataFrame:
    """Bronze rows to the 28-column silver contract.

    ``batch`` names the run column when ``bronze`` holds several runs; market share is then
    taken per run. Without it all rows are one batch.
    """
    parsed = {c: iso_instant(c) for c in ("ath_date", "atl_date", "last_updated")}
    parsed |= {c: number(c) for c in ("price_change_24h", "price_change_percentage_24h")}
    present = {c: F.expr(text) for c, text in parsed.items() if c in bronze.columns}
    renamed = bronze.withColumns(present).withColumnsRenamed(SILVER_NAMES)
    shared = market_share(renamed, batch=batch)
    stamped = shared.withColumn(
        "silver_ingestion_time", F.current_timestamp() if now is None else _literal(now)
    )
    return fit_contract(stamped, SILVER)


def _literal(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
