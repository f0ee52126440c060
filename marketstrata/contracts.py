"""Column contracts of every layer.

Data is always read with a contract, never inferred. Timestamps are instants
(``TIMESTAMP``); the ISO strings of the feed stay strings until the silver layer.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "timestamp": T.TimestampType(),
    "map<string,string>": T.MapType(T.StringType(), T.StringType()),
    "array<double>": T.ArrayType(T.DoubleType()),
    "array<array<double>>": T.ArrayType(T.ArrayType(T.DoubleType())),
    "decimal(38,2)": T.DecimalType(38, 2),
    "decimal(38,10)": T.DecimalType(38, 10),
    "decimal(10,4)": T.DecimalType(10, 4),
    "date": T.DateType(),
    "binary": T.BinaryType(),
    "array<string>": T.ArrayType(T.StringType()),
    "array<date>": T.ArrayType(T.DateType()),
    "map<string,bigint>": T.MapType(T.StringType(), T.LongType()),
}


def struct_of(fields: Iterable[tuple[str, str]]) -> T.StructType:
    """Nullable struct from ``(name, type)`` pairs."""
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in fields])


# --- Fixed values: column names, order and types of the data contracts ---------------------

# One market payload object per coin.
_MARKET_FIELDS = [
    ("id", "string"),
    ("symbol", "string"),
    ("name", "string"),
    ("image", "string"),
    ("current_price", "double"),
    ("market_cap", "double"),
    ("market_cap_rank", "int"),
    ("fully_diluted_valuation", "double"),
    ("total_volume", "double"),
    ("high_24h", "double"),
    ("low_24h", "double"),
    ("price_change_24h", "double"),
    ("price_change_percentage_24h", "double"),
    ("market_cap_change_24h", "double"),
    ("market_cap_change_percentage_24h", "double"),
    ("circulating_supply", "double"),
    ("total_supply", "double"),
    ("max_supply", "double"),
    ("ath", "double"),
    ("ath_change_percentage", "double"),
    ("ath_date", "string"),
    ("atl", "double"),
    ("atl_change_percentage", "double"),
    ("atl_date", "string"),
    ("roi", "string"),
    ("last_updated", "string"),
    ("price_change_percentage_24h_in_currency", "double"),
    ("price_change_percentage_7d_in_currency", "double"),
]

_BATCH_FIELDS = [("ingestion_timestamp", "timestamp"), ("pipeline_run_id", "string")]

_NARROW_FIELDS = [
    ("id", "string"),
    ("symbol", "string"),
    ("name", "string"),
    ("current_price", "double"),
    ("market_cap", "double"),
    ("total_volume", "double"),
    ("price_change_percentage_24h", "double"),
    ("last_updated", "string"),
]

_SILVER_FIELDS = [
    ("coin_id", "string"),
    ("symbol", "string"),
    ("name", "string"),
    ("current_price_usd", "double"),
    ("market_cap_usd", "double"),
    ("market_cap_rank", "int"),
    ("market_dominance", "double"),
    ("total_volume_24h", "double"),
    ("high_24h", "double"),
    ("low_24h", "double"),
    ("price_change_24h", "double"),
    ("price_change_percentage_24h", "double"),
    ("market_cap_change_24h", "double"),
    ("market_cap_change_percentage_24h", "double"),
    ("circulating_supply", "double"),
    ("total_supply", "double"),
    ("max_supply", "double"),
    ("ath", "double"),
    ("ath_change_percentage", "double"),
    ("ath_date", "timestamp"),
    ("atl", "double"),
    ("atl_change_percentage", "double"),
    ("atl_date", "timestamp"),
    ("price_change_percentage_24h_in_currency", "double"),
    ("price_change_percentage_7d_in_currency", "double"),
    ("last_updated", "timestamp"),
    ("silver_ingestion_time", "timestamp"),
    ("pipeline_run_id", "string"),
]

_METRIC_FIELDS = [
    ("total_coins", "bigint"),
    ("total_market_cap_usd", "decimal(38,2)"),
    ("total_volume_24h_usd", "decimal(38,2)"),
    ("avg_price_change_24h", "decimal(10,4)"),
    ("market_cap_weighted_24h_return", "decimal(10,4)"),
    ("coins_positive_24h", "bigint"),
    ("coins_negative_24h", "bigint"),
    ("dominance_btc", "decimal(10,4)"),
    ("dominance_eth", "decimal(10,4)"),
    ("as_of_timestamp", "timestamp"),
]

_LEADER_FIELDS = [
    ("coin_id", "string"),
    ("name", "string"),
    ("symbol", "string"),
    ("market_cap_rank", "int"),
    ("market_cap_usd", "decimal(38,2)"),
    ("current_price_usd", "decimal(38,10)"),
    ("price_change_percentage_24h", "decimal(10,4)"),
    ("top_gainer_24h", "decimal(10,4)"),
    ("total_volume_24h", "decimal(38,2)"),
    ("market_dominance", "decimal(10,4)"),
    ("as_of_timestamp", "timestamp"),
]

_RUN_LOG_FIELDS = [
    ("run_id", "string"),
    ("pipeline_name", "string"),
    ("start_time", "timestamp"),
    ("end_time", "timestamp"),
    ("duration_seconds", "double"),
    ("status", "string"),
    ("records_processed", "bigint"),
    ("records_saved", "bigint"),
    ("api_status", "string"),
    ("processing_status", "string"),
    ("error_message", "string"),
    ("metadata", "map<string,string>"),
]

_ALERT_FIELDS = [
    ("level", "string"),
    ("check", "string"),
    ("subject", "string"),
    ("observed", "double"),
    ("threshold", "double"),
    ("message", "string"),
]

_CHART_FIELDS = [
    ("coin_id", "string"),
    ("prices", "array<array<double>>"),
    ("market_caps", "array<array<double>>"),
    ("total_volumes", "array<array<double>>"),
]

# Columns a payload must carry to be ingested at all.
REQUIRED_COLUMNS = ["id", "symbol", "name", "current_price", "market_cap"]

# Columns that may tell when a bronze row arrived, in order of preference.
ARRIVAL_COLUMNS = ["ingestion_timestamp", "timestamp", "created_at", "last_updated"]

# Bronze name -> silver name.
SILVER_NAMES = {
    "id": "coin_id",
    "current_price": "current_price_usd",
    "market_cap": "market_cap_usd",
    "total_volume": "total_volume_24h",
}

# --- end of fixed values --------------------------------------------------------------------

PAYLOAD = struct_of(_MARKET_FIELDS)
BRONZE = struct_of(_MARKET_FIELDS + _BATCH_FIELDS)
NARROW = struct_of(_NARROW_FIELDS + _BATCH_FIELDS)
SILVER = struct_of(_SILVER_FIELDS)
METRICS = struct_of(_METRIC_FIELDS)
LEADERS = struct_of(_LEADER_FIELDS)
RUN_LOG = struct_of(_RUN_LOG_FIELDS)
ALERTS = struct_of(_ALERT_FIELDS)
CHART = struct_of(_CHART_FIELDS)
SPARKLINE = T.StructType(
    PAYLOAD.fields + [T.StructField("sparkline_in_7d", struct_of([("price", "array<double>")]), True)]
)

MERGE_KEYS = ["coin_id", "last_updated"]

# What the layers store beside their contracts: the rules a row broke before it was typed, the month of a version,
# the run a gold row was computed for.
VERSION_MONTH = "version_month"
BRONZE_TABLE = T.StructType(BRONZE.fields + struct_of([("broken_rules", "array<string>")]).fields)
SILVER_TABLE = T.StructType(SILVER.fields + struct_of([(VERSION_MONTH, "date")]).fields)
METRICS_TABLE = T.StructType(METRICS.fields + struct_of([("pipeline_run_id", "string")]).fields)

# One row a run and rule: how many rows of the run broke it.
VALIDATION = struct_of(
    [
        ("pipeline_run_id", "string"),
        ("column", "string"),
        ("rule", "string"),
        ("severity", "string"),
        ("total_records", "bigint"),
        ("invalid_records", "bigint"),
    ]
)

# One row a layer, run and attempt: figures that add up over runs.
FIGURES = struct_of(
    [
        ("layer", "string"),
        ("pipeline_run_id", "string"),
        ("recorded_at", "timestamp"),
        ("row_count", "bigint"),
        ("first_record", "timestamp"),
        ("last_record", "timestamp"),
        ("coins", "binary"),
        ("price_sum", "decimal(38,10)"),
        ("price_count", "bigint"),
        ("cap_sum", "decimal(38,2)"),
        ("cap_count", "bigint"),
        ("nulls", "map<string,bigint>"),
        ("days", "array<date>"),
    ]
)

# Statistics of a layer, as the health report stores them.
STATISTICS = struct_of(
    [
        ("layer", "string"),
        ("row_count", "bigint"),
        ("first_record", "timestamp"),
        ("last_record", "timestamp"),
        ("unique_coins", "bigint"),
        ("avg_price", "double"),
        ("total_market_cap", "double"),
        ("avg_market_cap", "double"),
    ]
)
