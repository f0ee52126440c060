import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from marketstrata.contracts import RUN_LOG
from marketstrata.operators import monitor
from marketstrata.operators.monitor import Thresholds, bronze_layer, gold_layer, silver_layer
from tests.conftest import UTC

T0 = dt.datetime(2024, 1, 8, 12, tzinfo=UTC)
HOUR = dt.timedelta(hours=1)


def _bronze(spark, n=12, at=T0):
    rows = [(f"c{i}", at) for i in range(n)]
    return spark.createDataFrame(rows, "id string, ingestion_timestamp timestamp")


def _silver(spark, n=12, at=T0, price=1.0):
    rows = [(f"c{i}", at, price, 10.0, 5.0) for i in range(n)]
    columns = (
        "coin_id string, silver_ingestion_time timestamp, current_price_usd double, market_cap_usd double,"
        " total_volume_24h double"
    )
    return spark.createDataFrame(rows, columns)


def _gold(spark, total="120.00", at=T0):
    return spark.createDataFrame(
        [(at - HOUR, decimal.Decimal("1.00")), (at, decimal.Decimal(total))],
        "as_of_timestamp timestamp, total_market_cap_usd decimal(38,2)",
    )


def _runs(spark, *runs):
    rows = [
        (f"r{i}", "job", start, start + dt.timedelta(seconds=s) if s is not None else None, None, "OK", 0, 0, None, None, None, {})
        for i, (start, s) in enumerate(runs)
    ]
    return spark.createDataFrame(rows, RUN_LOG)


def _levels(alerts):
    return sorted((r["level"], r["check"], r["subject"]) for r in alerts.collect())


def test_healthy_layers_raise_nothing(spark):
    log = _runs(spark, (T0 - HOUR, 60), (T0, 61))
    report = monitor.health_report(_bronze(spark), _silver(spark), _gold(spark), log, T0 + HOUR, "job")
    assert report.count() == 0
    row = monitor.health_status(report).first()
    assert (row["status"], row["errors"], row["warnings"]) == (0, 0, 0)


def test_everything_wrong(spark):
    log = _runs(spark, (T0 - HOUR, 60), (T0, None))
    bronze, silver = _bronze(spark), _silver(spark, 5, price=None)
    report = monitor.health_report(bronze, silver, _gold(spark, "100.00"), log, T0 + 3 * HOUR, "job")
    assert _levels(report) == [
        ("ERROR", "run_duration", "r1"),
        ("WARNING", "cap_reconciliation", "gold/silver"),
        ("WARNING", "freshness", "bronze"),
        ("WARNING", "freshness", "silver"),
        ("WARNING", "nulls", "silver.current_price_usd"),
        ("WARNING", "retention", "silver/bronze"),
        ("WARNING", "row_count", "silver"),
    ]
    assert monitor.health_status(report).first()["status"] == 1
    assert all(r["message"] for r in report.collect())


def test_freshness_is_strict_and_empty_is_an_error(spark):
    layers = [bronze_layer(_bronze(spark)), silver_layer(_silver(spark, 0))]
    found = monitor.freshness_check(layers, T0 + 2 * HOUR).collect()
    assert [(r["level"], r["subject"]) for r in found] == [("ERROR", "silver")]
    late = monitor.freshness_check(layers[:1], T0 + 2 * HOUR + dt.timedelta(seconds=1)).first()
    assert (late["level"], late["observed"], late["threshold"]) == ("WARNING", 7201.0, 7200.0)


def test_row_count_floor_is_strict(spark):
    layer = bronze_layer(_bronze(spark, 10))
    assert monitor.row_count_check([layer]).count() == 0
    assert monitor.row_count_check([layer], Thresholds(min_rows={"bronze": 11})).count() == 1


def test_null_check_ignores_empty_tables(spark):
    assert monitor.null_check([silver_layer(_silver(spark, 0, price=None))]).count() == 0
    percents = {r["column"]: r["percent"] for r in monitor.null_percentage([silver_layer(_silver(spark, price=None))]).collect()}
    assert percents == {"current_price_usd": 100.0, "market_cap_usd": 0.0, "total_volume_24h": 0.0}


def test_retention_of_an_empty_bronze(spark):
    bronze = bronze_layer(_bronze(spark, 0))
    assert monitor.layer_retention(bronze, silver_layer(_silver(spark))).count() == 0


def test_reconciliation_uses_the_batch_of_the_newest_gold_row(spark):
    both = _silver(spark).unionByName(_silver(spark, at=T0 - HOUR))
    assert monitor.cap_reconciliation(both, _gold(spark)).count() == 0
    found = monitor.cap_reconciliation(both, _gold(spark, "118.00")).first()
    assert found["observed"] == pytest.approx(2 / 120 * 100)
    assert monitor.cap_reconciliation(both, _gold(spark).filter("false")).count() == 0


def test_slow_run(spark):
    # The average of 60, 60 and 240 is 120, and 240 > 180.
    log = _runs(spark, (T0 - 2 * HOUR, 60), (T0 - HOUR, 60), (T0, 240))
    found = monitor.run_duration_check(log, T0, "job").first()
    assert (found["level"], found["observed"], found["threshold"]) == ("WARNING", 240.0, 180.0)
    assert monitor.run_duration_check(log, T0, "other").count() == 0
    assert monitor.run_duration_check(log, T0 + 30 * 24 * HOUR, "job").count() == 0


def test_layer_stats(spark):
    layers = [bronze_layer(_bronze(spark)), silver_layer(_silver(spark)), gold_layer(_gold(spark))]
    found = {r["layer"]: r for r in monitor.layer_stats(layers).collect()}
    assert (found["bronze"]["row_count"], found["bronze"]["unique_coins"]) == (12, 12)
    assert (found["silver"]["avg_price"], found["silver"]["total_market_cap"]) == (1.0, 120.0)
    assert found["gold"]["avg_market_cap"] == 60.5


def test_failing_check_becomes_an_alert(spark):
    broken = monitor.guarded(spark, "freshness", lambda: _bronze(spark).select("absent"))
    assert _levels(broken) == [("ERROR", "freshness", "freshness")]
    late = monitor.guarded(spark, "late", lambda: _bronze(spark).select(F.raise_error(F.lit("boom"))))
    assert _levels(late) == [("ERROR", "late", "late")]
    fine = monitor.guarded(spark, "rows", lambda: monitor.row_count_check([bronze_layer(_bronze(spark, 1))]))
    assert _levels(fine) == [("WARNING", "row_count", "bronze")]
