"""Bronze and silver: conforming, validating, deduplicating."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketstrata.contracts import BRONZE, SILVER
from marketstrata.operators import conform, quality
from marketstrata.operators.dedupe import dedupe_snapshot
from marketstrata.showcase.standins import BRONZE_CTE, DIRTY, bronze, dirty, instant, moment, plain, query
from marketstrata.sources.payloads import project_narrow_snapshot

NOW = "2024-02-01 00:30:00"
RUN_ID = "run_1706747400"

_SQL_TYPES = {"string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "timestamp": "TIMESTAMP"}


def _contract_sql(contract, known: dict[str, str]) -> str:
    """Select list of a contract: known expressions, typed NULLs for the rest."""
    return ",\n  ".join(
        f"CAST({known.get(f.name, 'NULL')} AS {_SQL_TYPES[f.dataType.simpleString()]}) AS {f.name}"
        for f in contract.fields
    )


_PAYLOAD_FIELDS = [
    "id", "symbol", "name", "current_price", "market_cap", "total_volume",
    "price_change_percentage_24h", "last_updated",
]


def _payload(spark, sf_dir):
    """Payload columns of the bronze history plus one that no contract knows."""
    event = F.col("event_id")
    return bronze(spark, sf_dir).select(
        *_PAYLOAD_FIELDS, event.alias("market_cap_rank"), event.alias("unknown_field")
    )


@query(
    "conform_bronze",
    "WITH"
    + BRONZE_CTE
    + "SELECT "
    + _contract_sql(
        BRONZE,
        {
            **{c: c for c in _PAYLOAD_FIELDS},
            "market_cap_rank": "event_id",
            "ingestion_timestamp": f"TIMESTAMP '{NOW}'",
            "pipeline_run_id": f"'{RUN_ID}'",
        },
    )
    + " FROM bronze",
)
def conform_bronze(spark, sf_dir):
    return plain(conform.conform_bronze(conform.stamp_batch(_payload(spark, sf_dir), moment(NOW), RUN_ID)))


@query(
    "stamp_batch",
    "WITH"
    + BRONZE_CTE
    + f"""
SELECT id, event_id, TIMESTAMP '{NOW}' AS ingestion_timestamp, pipeline_run_id FROM bronze""",
)
def stamp_batch(spark, sf_dir):
    """The run id is there already and stays; the ingestion time is added."""
    rows = bronze(spark, sf_dir).select("id", "event_id", "pipeline_run_id")
    return conform.stamp_batch(rows, moment(NOW), RUN_ID)


@query(
    "silver_transform",
    "WITH"
    + BRONZE_CTE
    + """,
shared AS (
  SELECT bronze.*, market_cap / NULLIF(CAST(SUM(CAST(market_cap AS DECIMAL(18,2)))
    OVER (PARTITION BY pipeline_run_id) AS DOUBLE), 0) * 100 AS market_dominance FROM bronze)
SELECT """
    + _contract_sql(
        SILVER,
        {
            "coin_id": "id",
            "symbol": "symbol",
            "name": "name",
            "current_price_usd": "current_price",
            "market_cap_usd": "market_cap",
            "market_cap_rank": "CASE WHEN name = 'click' THEN 7 ELSE -1 END",
            "market_dominance": "market_dominance",
            "total_volume_24h": "total_volume",
            "price_change_24h": "CASE WHEN name <> 'signup' THEN current_price END",
            "price_change_percentage_24h": "price_change_percentage_24h",
            "ath_date": "CASE WHEN name = 'view' THEN date_trunc('milliseconds', ingestion_timestamp) END",
            "last_updated": "date_trunc('milliseconds', ingestion_timestamp)",
            "silver_ingestion_time": f"TIMESTAMP '{NOW}'",
            "pipeline_run_id": "pipeline_run_id",
        },
    )
    + " FROM shared",
)
def silver_transform(spark, sf_dir):
    """Bad numbers, dates and ranks become NULL; market share is per run."""
    kind = F.col("name")
    rows = bronze(spark, sf_dir).withColumns(
        {
            "market_cap_rank": F.when(kind == "click", "7").otherwise("n/a"),
            "price_change_24h": F.when(kind == "signup", "n/a").otherwise(F.col("current_price").cast("string")),
            "ath_date": F.when(kind == "view", F.col("last_updated")).otherwise("never"),
        }
    )
    found = plain(conform.silver_transform(rows, instant(NOW), batch="pipeline_run_id"), utc=True)
    return found.withColumn("market_cap_rank", F.coalesce("market_cap_rank", F.lit(-1)))


# What breaks each rule, in SQL, over the faulty history.
_BREACHES = {
    "id": "id IS NULL",
    "symbol": "symbol IS NULL",
    "name": "name IS NULL",
    "current_price": "current_price < 0",
    "market_cap": "market_cap < 0",
    "total_volume": "total_volume < 0",
    "price_change_24h": "price_change_24h IS NOT NULL AND TRY_CAST(price_change_24h AS DOUBLE) IS NULL",
    "price_change_percentage_24h": "FALSE",
    "last_updated": "TRY_CAST(last_updated AS TIMESTAMP) IS NULL",
    "ath_date": "ath_date IS NOT NULL AND TRY_CAST(ath_date AS TIMESTAMP) IS NULL",
    "market_cap_rank": "market_cap_rank < 0 OR market_cap_rank <> floor(market_cap_rank)",
}
_RULED = [rule for rule in quality.RULES if rule.column in _BREACHES]

_REPORT = (
    DIRTY
    + ",\nreport AS ("
    + "\nUNION ALL\n".join(
        f"""SELECT '{r.column}' AS "column", '{r.rule}' AS rule, '{r.severity}' AS severity,
  COUNT(*) AS total_records, COUNT(*) FILTER (WHERE {_BREACHES[r.column]}) AS invalid_records FROM dirty"""
        for r in _RULED
    )
    + ")\n"
)


@query("validation_report", _REPORT + "SELECT * FROM report")
def validation_report(spark, sf_dir):
    return quality.validation_report(dirty(spark, sf_dir))


@query(
    "validation_summary",
    _REPORT
    + """
SELECT MAX(total_records) AS total_records,
  CAST(SUM(CASE WHEN severity = 'error' THEN invalid_records ELSE 0 END) AS BIGINT) AS errors,
  COUNT(*) FILTER (WHERE severity = 'warning' AND invalid_records > 0) AS warnings,
  SUM(CASE WHEN severity = 'error' THEN invalid_records ELSE 0 END) = 0 AS passed
FROM report""",
)
def validation_summary(spark, sf_dir):
    return quality.validation_summary(quality.validation_report(dirty(spark, sf_dir)))


@query(
    "quarantine_rows",
    DIRTY
    + ", flagged AS (SELECT event_id, concat_ws(',', "
    + ", ".join(
        f"CASE WHEN {_BREACHES[r.column]} THEN '{r.column}:{r.rule}' END" for r in _RULED if r.severity == "error"
    )
    + ") AS broken_rules FROM dirty)\nSELECT * FROM flagged WHERE broken_rules <> ''",
)
def quarantine_rows(spark, sf_dir):
    _, bad = quality.split_rows(dirty(spark, sf_dir))
    return bad.select("event_id", F.concat_ws(",", "broken_rules").alias("broken_rules"))


@query(
    "dedupe_snapshot",
    "WITH"
    + BRONZE_CTE
    + """,
ordered AS (
  SELECT pipeline_run_id, id, symbol, current_price, last_updated, event_id,
    ROW_NUMBER() OVER (PARTITION BY pipeline_run_id, id ORDER BY last_updated DESC NULLS LAST,
      symbol DESC NULLS LAST, current_price DESC NULLS LAST, event_id DESC) AS n,
    COUNT(*) OVER (PARTITION BY pipeline_run_id, id) AS copies
  FROM bronze)
SELECT pipeline_run_id, id, symbol, current_price, last_updated, event_id, copies FROM ordered WHERE n = 1""",
)
def dedupe(spark, sf_dir):
    rows = bronze(spark, sf_dir).select(
        "pipeline_run_id", "id", "symbol", "current_price", "last_updated", "event_id"
    )
    return dedupe_snapshot(rows, ["pipeline_run_id", "id"], copies="copies")


@query(
    "project_narrow_snapshot",
    "WITH"
    + BRONZE_CTE
    + f"""
SELECT id, upper(COALESCE(symbol, '')) AS symbol, COALESCE(name, '') AS name, current_price, market_cap,
  total_volume, price_change_percentage_24h, COALESCE(last_updated, '') AS last_updated,
  TIMESTAMP '{NOW}' AS ingestion_timestamp, '{RUN_ID}' AS pipeline_run_id
FROM bronze""",
)
def narrow_snapshot(spark, sf_dir):
    rows = _payload(spark, sf_dir)
    return plain(project_narrow_snapshot(rows, moment(NOW), RUN_ID, fill_text=True))
