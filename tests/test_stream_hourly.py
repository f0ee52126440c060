import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from marketstrata.contracts import SILVER_TABLE
from marketstrata.plans.hourly import LayerTables, hourly_run
from marketstrata.session import fresh_path
from marketstrata.streaming.incremental import landed_snapshots, run_incremental_silver
from tests.conftest import UTC, shape

NOW = dt.datetime(2024, 2, 1, 12, 30, tzinfo=UTC)


def _land(folder, run, coins):
    part = f"{folder}/pipeline_run_id={run}"
    os.makedirs(part, exist_ok=True)
    with open(f"{part}/page.json", "w") as out:
        out.writelines(json.dumps(c) + "\n" for c in coins)


def _coin(name, cap, updated, **more):
    return {"id": name, "symbol": name[:3], "name": name, "current_price": 1.0, "market_cap": cap, "last_updated": updated, **more}


T1, T2 = "2024-02-01T12:00:00.000Z", "2024-02-01T13:00:00.000Z"


def test_incremental_silver_is_exactly_once(spark, schema):
    folder = tempfile.mkdtemp(prefix="landing-")
    silver, quarantine, progress = f"{schema}.silver", f"{schema}.quarantine", fresh_path(spark, "progress")

    def advance(checkpoint=progress):
        run_incremental_silver(landed_snapshots(spark, folder), silver, quarantine, checkpoint, NOW)
        return spark.read.table(silver)

    _land(folder, "r1", [_coin("bitcoin", 75.0, T1), _coin("ethereum", 25.0, T1), _coin("broken", 5.0, "soon")])
    first = {r["coin_id"]: r["market_dominance"] for r in advance().collect()}
    assert first == {"bitcoin": 75.0, "ethereum": 25.0}
    assert shape(spark.read.table(silver).schema) == shape(SILVER_TABLE)

    # Nothing new; then an unchanged coin, a new version and a late one.
    assert advance().count() == 2
    _land(folder, "r2", [_coin("bitcoin", 80.0, T1), _coin("ethereum", 20.0, T2), _coin("late", 1.0, "2023-01-01T00:00:00Z")])
    assert advance().count() == 4
    assert spark.read.table(silver).filter("coin_id = 'bitcoin'").first()["market_cap_usd"] == 75.0

    # Losing all progress replays every file and still adds nothing.
    replayed = advance(fresh_path(spark, "progress"))
    assert replayed.count() == 4
    bad = spark.read.table(quarantine)
    assert [r["broken_rules"] for r in bad.collect()] == [["last_updated:is_valid_timestamp"]]

    # Rejects of another checkpoint stand beside the earlier ones.
    _land(folder, "r3", [_coin("worse", 5.0, "later")])
    advance(fresh_path(spark, "progress"))
    assert sorted(r["id"] for r in spark.read.table(quarantine).collect()) == ["broken", "worse"]


def _silver(spark, name):
    rows = spark.read.table(name).select("coin_id", "last_updated", "market_cap_usd", "market_dominance", "pipeline_run_id")
    return sorted(map(tuple, rows.collect()))


def test_a_run_landed_in_moves_equals_one_landed_at_once(spark, schema):
    """Shares, quarantine and the newest row of a coin are those of the whole run; other runs stay as they are."""
    first = [_coin("bitcoin", 60.0, T1), _coin("ethereum", 40.0, T1), _coin("broken", 5.0, "soon")]
    second = [_coin("bitcoin", 70.0, T2), _coin("tether", 90.0, "2023-07-01T00:00:00Z"), _coin("torn", 5.0, "late")]
    other = [_coin("bitcoin", 10.0, T1), _coin("dai", 30.0, T1)]
    found = {}
    for way in ("once", "moves"):
        folder = tempfile.mkdtemp(prefix="landing-")
        silver, quarantine, progress = f"{schema}.{way}", f"{schema}.{way}_aside", fresh_path(spark, "progress")
        moves = [("r1", "a", first + second), ("r0", "b", other)] if way == "once" else [("r1", "a", first), ("r0", "b", other), ("r1", "c", second)]
        steps = [moves] if way == "once" else [[m] for m in moves]
        for step in steps:
            for run, name, coins in step:
                part = f"{folder}/pipeline_run_id={run}"
                os.makedirs(part, exist_ok=True)
                with open(f"{part}/{name}.json", "w") as out:
                    out.writelines(json.dumps(c) + "\n" for c in coins)
            run_incremental_silver(landed_snapshots(spark, folder), silver, quarantine, progress, NOW)
        aside = sorted((r["pipeline_run_id"], r["id"]) for r in spark.read.table(quarantine).collect())
        found[way] = [(r[0], r[2], r[3], r[4]) for r in _silver(spark, silver) if r[4] == "r1"], aside
    assert found["once"] == found["moves"]
    assert found["moves"][0] == [("bitcoin", 70.0, 35.0, "r1"), ("ethereum", 40.0, 20.0, "r1"), ("tether", 90.0, 45.0, "r1")]
    assert found["moves"][1] == [("r1", "broken"), ("r1", "torn")]
    # The other run: its bitcoin came second in the moves, its share is over its own market.
    rows = {r[0]: r[3] for r in _silver(spark, f"{schema}.moves") if r[4] == "r0"}
    assert rows["dai"] == 75.0


def test_a_version_stays_with_the_run_that_brought_it(spark, schema):
    folder = tempfile.mkdtemp(prefix="landing-")
    silver, progress = f"{schema}.silver", fresh_path(spark, "progress")
    advance = lambda p=progress: run_incremental_silver(landed_snapshots(spark, folder), silver, f"{schema}.aside", p, NOW)
    _land(folder, "r1", [_coin("bitcoin", 75.0, T1), _coin("ethereum", 25.0, T1)])
    advance()
    _land(folder, "r2", [_coin("bitcoin", 80.0, T1), _coin("ethereum", 20.0, T2)])
    advance()
    before = _silver(spark, silver)
    assert [(r[0], r[2], r[3], r[4]) for r in before] == [("bitcoin", 75.0, 75.0, "r1"), ("ethereum", 25.0, 25.0, "r1"), ("ethereum", 20.0, 20.0, "r2")]
    # All files again, both runs in one micro-batch: versions, shares and owners stay.
    advance(fresh_path(spark, "progress"))
    assert _silver(spark, silver) == before


def _run(spark, coins, schema, run="r1", now=NOW, **options):
    tables = LayerTables.under(schema)
    return tables, hourly_run(spark, coins, tables, run, now, clock=lambda: now, **options)


def test_hourly_run_and_rerun(spark, schema, coins):
    for _ in range(2):
        tables, result = _run(spark, coins, schema)
        assert (result.status, result.processed, result.saved) == ("SUCCESS", 3, 2)
        assert result.metadata["duplicates_removed"] == "1"
        assert "roi" in result.metadata["missing_columns"]
        read = spark.read.table
        assert read(tables.bronze).count() == read(tables.silver).count() == 2
        assert read(tables.metrics).count() == 1
        assert read(tables.leaders).count() == 2
    metrics = read(tables.metrics).first()
    assert (metrics["total_coins"], float(metrics["total_market_cap_usd"])) == (2, 1e12)
    assert (float(metrics["dominance_btc"]), float(metrics["dominance_eth"])) == (76.0, 24.0)
    assert float(metrics["market_cap_weighted_24h_return"]) == pytest.approx(2.5 * 0.76 - 1.5 * 0.24)
    assert read(tables.run_log).count() == 2
    alerts = {r["check"] for r in read(tables.alerts).collect()}
    assert alerts == {"row_count"}


def test_second_hour_adds_only_new_versions(spark, schema, coins):
    _run(spark, coins, schema)
    later = coins.withColumn(
        "last_updated", F.when(F.col("id") == "bitcoin", "2024-02-01T13:00:00.000Z").otherwise(F.col("last_updated"))
    )
    tables, _ = _run(spark, later, schema, "r2", NOW + dt.timedelta(hours=1))
    read = spark.read.table
    assert read(tables.bronze).count() == 4
    assert read(tables.silver).count() == 3
    assert read(tables.metrics).count() == 2
    # Gold covers the whole market of the hour, also the coin whose version is already stored.
    assert {r["coin_id"] for r in read(tables.leaders).collect()} == {"bitcoin", "ethereum"}
    second = read(tables.metrics).orderBy("as_of_timestamp").collect()[1]
    assert (second["total_coins"], float(second["dominance_eth"])) == (2, 24.0)
    assert read(tables.alerts).filter("check = 'cap_reconciliation'").count() == 0


def test_late_run_is_refined_as_itself(spark, schema, coins):
    _run(spark, coins, schema, "r2", NOW + dt.timedelta(hours=1))
    early = coins.withColumn("last_updated", F.lit("2024-02-01T09:00:00.000Z")).withColumn("market_cap", F.col("market_cap") / 2)
    tables, result = _run(spark, early, schema, "r1", NOW)
    read = spark.read.table
    assert result.status == "SUCCESS" and read(tables.silver).count() == 4
    assert read(tables.metrics).count() == 2
    # Leaders stay those of the newer batch.
    assert float(read(tables.leaders).agg(F.max("market_cap_usd")).first()[0]) == 760e9


def test_rerun_of_a_mended_run_empties_its_quarantine(spark, schema, coins):
    bad = coins.withColumn("name", F.when(F.col("id") == "ethereum", None).otherwise(F.col("name")))
    tables, _ = _run(spark, bad, schema, "r1", strict=False)
    assert spark.read.table(tables.quarantine).count() == 1
    _run(spark, coins, schema, "r1", strict=False)
    assert spark.read.table(tables.quarantine).count() == 0
    assert spark.read.table(tables.silver).count() == 2


def test_one_broken_check_leaves_the_others(spark, schema, coins):
    from marketstrata.operators.monitor import guarded_report

    tables, _ = _run(spark, coins.filter("false"), schema)
    read = spark.read.table
    found = guarded_report(
        spark, lambda: read(f"{schema}.absent"), lambda: read(tables.silver), lambda: read(tables.metrics),
        lambda: read(tables.run_log), NOW,
    ).collect()
    assert {"bronze", "layer_retention"} <= {r["check"] for r in found if r["level"] == "ERROR"}
    assert any(r["subject"] == "silver" for r in found if r["check"] not in ("bronze", "layer_retention"))


def test_empty_payload_is_skipped(spark, schema, coins):
    tables, result = _run(spark, coins.filter("false"), schema)
    assert result.status == "SKIPPED"
    assert spark.read.table(tables.run_log).first()["status"] == "SKIPPED"
    assert spark.read.table(tables.alerts).filter("level = 'ERROR'").count() == 2


def test_errors_fail_or_are_quarantined(spark, schema, coins):
    bad = coins.withColumn("name", F.when(F.col("id") == "ethereum", None).otherwise(F.col("name")))
    with pytest.raises(ValueError, match="1 errors"):
        _run(spark, bad, schema)
    log = spark.read.table(LayerTables.under(schema).run_log).first()
    assert log["status"] == "FAILED" and "1 errors" in log["error_message"]
    tables, result = _run(spark, bad, schema, "r2", strict=False)
    assert result.status == "SUCCESS"
    assert [r["id"] for r in spark.read.table(tables.quarantine).collect()] == ["ethereum"]
    assert [r["coin_id"] for r in spark.read.table(tables.silver).collect()] == ["bitcoin"]


def test_missing_required_column_fails(spark, schema, coins):
    with pytest.raises(ValueError, match="symbol"):
        _run(spark, coins.drop("symbol"), schema)
    assert spark.read.table(LayerTables.under(schema).run_log).first()["status"] == "FAILED"
