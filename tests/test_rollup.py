"""Stored figures, runs repeated and repaired, and rules that see a payload before it is typed."""

import datetime as dt
import os
import urllib.parse

import pytest
from pyspark.sql import functions as F

from marketstrata.operators import monitor, quality, rollup
from marketstrata.plans.hourly import LayerTables, hourly_run
from marketstrata.sources.payloads import raw_market, scan_raw_market
from tests.conftest import UTC

NOW = dt.datetime(2024, 2, 1, 12, 30, tzinfo=UTC)
HOUR = dt.timedelta(hours=1)


def _run(spark, coins, schema, run="r1", now=NOW, **options):
    tables = LayerTables.under(schema)
    hourly_run(spark, coins, tables, run, now, clock=lambda: now, **options)
    return tables


def _later(coins, hour):
    return coins.withColumn("last_updated", F.lit(f"2024-02-01T{hour}:00:00.000Z"))


def test_a_run_reads_no_old_partition(spark, schema, coins):
    """The files of an earlier run in bronze and of an earlier month in silver are gone; later runs do not notice."""
    old = coins.withColumn("last_updated", F.lit("2020-01-05T00:00:00.000Z"))
    tables = _run(spark, old, schema, "r0", NOW - HOUR)
    for name in (tables.bronze, tables.silver):
        for file in spark.read.table(name).inputFiles():
            os.remove(urllib.parse.unquote(urllib.parse.urlparse(file).path))
    _run(spark, coins, schema, "r1")
    _run(spark, coins, schema, "r1", NOW + HOUR)
    stats = {r["layer"]: r for r in spark.read.table(tables.statistics).collect()}
    assert (stats["bronze"]["row_count"], stats["silver"]["row_count"], stats["gold"]["row_count"]) == (4, 4, 2)
    assert (stats["bronze"]["unique_coins"], stats["silver"]["unique_coins"], stats["gold"]["unique_coins"]) == (2, 2, None)
    assert {r["check"] for r in spark.read.table(tables.alerts).collect()} == {"row_count"}


def test_a_repeated_run_counts_once_with_any_clock(spark, schema, coins):
    """First one coin, then both with a later clock, then with an earlier one."""
    for now, rows in ((NOW, coins.filter("id = 'bitcoin'")), (NOW + HOUR, coins), (NOW - HOUR, coins)):
        tables = _run(spark, rows, schema, "r1", now)
        [row] = spark.read.table(tables.metrics).collect()
        assert row["total_coins"] == rows.select("id").distinct().count()
        assert row["as_of_timestamp"].astimezone(UTC) == now
        assert {r["as_of_timestamp"].astimezone(UTC) for r in spark.read.table(tables.leaders).collect()} == {now}
    assert spark.read.table(tables.silver).count() == 2
    stats = {r["layer"]: r["row_count"] for r in spark.read.table(tables.statistics).collect()}
    assert stats == {"bronze": 2, "silver": 2, "gold": 1}


def test_leaders_return_to_the_run_that_is_newest(spark, schema, coins):
    """r2 led; repeated with an earlier clock it no longer does, and r1's leaders are back."""
    _run(spark, _later(coins.filter("id = 'bitcoin'"), 10), schema, "r1")
    _run(spark, _later(coins, 11), schema, "r2", NOW + HOUR)
    tables = _run(spark, _later(coins, 11), schema, "r2", NOW - HOUR)
    leaders = spark.read.table(tables.leaders).collect()
    assert [(r["coin_id"], r["as_of_timestamp"].astimezone(UTC)) for r in leaders] == [("bitcoin", NOW)]


def test_a_run_emptied_by_repair_leaves_gold(spark, schema, coins):
    _run(spark, coins, schema, "r1", strict=False)
    broken = coins.withColumn("name", F.lit(None).cast("string"))
    tables = _run(spark, broken, schema, "r1", strict=False)
    assert spark.read.table(tables.metrics).count() == spark.read.table(tables.leaders).count() == 0
    assert spark.read.table(tables.quarantine).count() == 2


def test_figures_add_up_to_one_pass_over_the_history(spark, silver_rows):
    runs = silver_rows.withColumn("pipeline_run_id", F.concat(F.lit("r"), F.col("market_cap_usd") % 3))
    layer = monitor.silver_layer(runs)
    figures = rollup.run_figures(layer, NOW)
    assert figures.count() == 4  # the NULL cap has a run of its own
    added, whole = rollup.add_figures(figures, [layer]).first(), monitor.layer_figures(layer).first()
    assert {c: added[c] for c in whole.asDict()} == whole.asDict()


def test_the_last_attempt_counts_and_an_unknown_layer_is_empty(spark, silver_rows):
    layer = monitor.silver_layer(silver_rows)
    first = rollup.run_figures(layer, NOW, "r1")
    again = rollup.run_figures(monitor.silver_layer(silver_rows.limit(2)), NOW + HOUR, "r1")
    both = first.unionByName(again)
    found = {r["layer"]: r for r in rollup.add_figures(both, [monitor.bronze_layer(None), layer]).collect()}
    assert (found["silver"]["row_count"], found["bronze"]["row_count"], found["bronze"]["last_record"]) == (2, 0, None)
    newest = rollup.newest_run(both, "silver").first()
    assert newest["pipeline_run_id"] == "r1"


def test_one_broken_check_leaves_the_others(spark, silver_rows):
    layers = [monitor.bronze_layer(None), monitor.silver_layer(silver_rows), monitor.gold_layer(None)]
    log = spark.createDataFrame([], "start_time timestamp, run_id string, end_time timestamp, pipeline_name string")
    figures = rollup.run_figures(layers[1], NOW, "r1")

    def lost():
        return spark.read.table("nowhere.at_all")

    found = monitor.figures_report(spark, lambda: rollup.add_figures(figures, layers), lost, lambda: log, NOW).collect()
    assert {"batch_reconciliation", "freshness", "row_count"} <= {r["check"] for r in found}
    assert {r["subject"] for r in found if r["level"] == "ERROR"} == {"batch_reconciliation", "bronze"}


def test_sketches_of_many_coins_are_within_their_error(spark):
    rows = spark.range(200_000).selectExpr("cast(id % 50000 as string) as id", "cast(id % 40 as string) as pipeline_run_id", "timestamp'2024-01-01' as ingestion_timestamp")
    layer = monitor.bronze_layer(rows)
    found = rollup.add_figures(rollup.run_figures(layer, NOW), [layer]).first()
    assert found["row_count"] == 200_000
    assert abs(found["unique_coins"] - 50_000) <= 4 * rollup.COIN_ERROR * 50_000


def test_a_batch_missing_on_either_side_is_an_error(spark):
    side = lambda rows: spark.createDataFrame(rows, "batch string, total double")
    found = monitor.batch_reconciliation(
        side([("a", 100.0), ("b", 100.0), ("c", 100.0), ("z", 0.0), ("n", None)]),
        side([("b", 100.5), ("c", 103.0), ("d", 1.0), ("z", 0.0), ("n", None)]),
        "batch",
    )
    assert {(r["subject"], r["level"]) for r in found.collect()} == {("a", "ERROR"), ("d", "ERROR"), ("c", "WARNING")}


# --- rules before types -----------------------------------------------------------------------

TEXTS = [
    '[{"id": "a", "symbol": "a", "name": "A", "current_price": "12", "market_cap": 5, "market_cap_rank": 2, "last_updated": "2024-02-01T12:00:00Z"},'
    ' {"id": "b", "symbol": "b", "name": "B", "current_price": "n/a", "market_cap": 1e23, "market_cap_rank": 1.7, "last_updated": "2024-02-01T12:00:00Z"}]',
    '{"id": "c", "symbol": "c", "name": "C", "current_price": "Infinity", "market_cap": 7, "market_cap_rank": 3e9, "price_change_percentage_24h": 2e8,'
    ' "roi": {"times": 2}, "last_updated": "2024-02-01T12:00:00Z"}',
    "not json",
    "",
    None,
    "7",
]

EXPECTED = {
    ("current_price", "fits_double_or_null"): 1,
    ("current_price", "is_finite_or_null"): 1,
    ("market_cap", "fits_sums_or_null"): 1,
    ("market_cap_rank", "fits_integer_or_null"): 2,
    ("market_cap_rank", "is_positive_integer_or_null"): 1,
    ("price_change_percentage_24h", "fits_gold_or_null"): 1,
    ("id", "is_not_null"): 1,
    ("symbol", "is_not_null"): 1,
    ("name", "is_not_null"): 1,
    ("last_updated", "is_valid_timestamp"): 1,
}


def _raw(spark):
    return raw_market(spark.createDataFrame([(t,) for t in TEXTS], "text string"), "text")


def test_raw_rows_keep_what_was_written(spark):
    rows = {r["id"]: r for r in _raw(spark).collect()}
    assert set(rows) == {"a", "b", "c", None}
    assert (rows["a"]["current_price"], rows["b"]["market_cap_rank"], rows["c"]["roi"]) == ("12", "1.7", '{"times":2}')


def test_raw_files(spark, tmp_path):
    (tmp_path / "one.json").write_text(TEXTS[0])
    (tmp_path / "two.json").write_text(TEXTS[1])
    assert {r["id"] for r in scan_raw_market(spark, str(tmp_path)).collect()} == {"a", "b", "c"}


def test_the_run_counts_what_typing_would_hide(spark, schema):
    with pytest.raises(ValueError, match="errors"):
        _run(spark, _raw(spark), schema, "strict")
    tables = _run(spark, _raw(spark), schema, "r1", strict=False)
    counted = spark.read.table(tables.validation)
    found = {(r["column"], r["rule"]): r["invalid_records"] for r in counted.filter("pipeline_run_id = 'r1' and invalid_records > 0").collect()}
    assert found == EXPECTED
    assert counted.filter("pipeline_run_id = 'strict'").count() == len(quality.RUN_RULES)
    aside = {r["id"]: set(r["broken_rules"]) for r in spark.read.table(tables.quarantine).collect()}
    assert set(aside) == {"b", "c", None} and "market_cap:fits_sums_or_null" in aside["b"]
    # Only the fit coin is in silver and gold.
    assert [(r["coin_id"], r["current_price_usd"]) for r in spark.read.table(tables.silver).collect()] == [("a", 12.0)]
    assert spark.read.table(tables.metrics).first()["total_coins"] == 1


def test_a_huge_change_is_counted_and_does_not_fail_the_run(spark, schema, coins):
    rows = coins.withColumn("price_change_percentage_24h", F.when(F.col("id") == "bitcoin", 2e8).otherwise(F.lit(2.0)))
    tables = _run(spark, rows, schema)
    row = spark.read.table(tables.metrics).first()
    assert (row["total_coins"], float(row["avg_price_change_24h"])) == (2, 2.0)
    warned = spark.read.table(tables.validation).filter("invalid_records > 0").collect()
    assert [(r["rule"], r["invalid_records"]) for r in warned] == [("fits_gold_or_null", 1)]


def test_infinity_is_set_aside_by_name(spark, schema, coins):
    rows = coins.withColumn("market_cap", F.when(F.col("id") == "bitcoin", float("inf")).otherwise(F.col("market_cap")))
    tables = _run(spark, rows, schema, strict=False)
    assert spark.read.table(tables.quarantine).first()["broken_rules"] == ["market_cap:is_finite_or_null"]
    assert float(spark.read.table(tables.metrics).first()["total_market_cap_usd"]) == 240e9


def test_a_run_compacts_what_it_leaves_in_small_files(spark, schema, coins):
    for k in range(3):
        tables = _run(spark, _later(coins, 10 + k), schema, f"r{k}", NOW + k * HOUR, max_files=1)
    for name in (tables.silver, tables.run_log, tables.figures):
        assert len(spark.read.table(name).inputFiles()) <= 2
    assert (spark.read.table(tables.silver).count(), spark.read.table(tables.run_log).count()) == (6, 3)
    assert {r["row_count"] for r in spark.read.table(tables.statistics).collect()} == {6, 3}
