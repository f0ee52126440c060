import datetime as dt

from pyspark.sql import functions as F

from marketstrata.operators import batches
from marketstrata.operators.dedupe import dedupe_snapshot
from tests.conftest import UTC


def test_newest_version_survives(coins):
    found = {r["id"]: r for r in dedupe_snapshot(coins, ["id"], copies="copies").collect()}
    assert found["bitcoin"]["current_price"] == 40000.0
    assert (found["bitcoin"]["copies"], found["ethereum"]["copies"]) == (2, 1)
    assert dedupe_snapshot(coins, ["id"]).columns == coins.columns


def test_ties_go_to_the_greatest_row(spark):
    rows = spark.createDataFrame([("a", "t", 1), ("a", "t", 3), ("a", None, 9)], "id string, last_updated string, v int")
    assert dedupe_snapshot(rows, ["id"]).first()["v"] == 3


def test_rows_of_plain_keys(spark):
    rows = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "id string")
    pairs = rows.withColumn("v", F.lit(1))
    assert dedupe_snapshot(pairs, ["id"]).count() == 2


HISTORY = [
    ("r1", "2024-01-01 00:00:00", "a"),
    ("r2", "2024-01-02 00:00:00", "b"),
    ("r3", "2024-01-02 00:00:00", "c"),
    ("r3", "2024-01-01 12:00:00", "d"),
]


def _history(spark):
    rows = spark.createDataFrame(HISTORY, "pipeline_run_id string, at string, id string")
    return rows.withColumn("ingestion_timestamp", F.to_timestamp("at")).drop("at")


def test_latest_run_ties_go_to_the_greatest_run(spark):
    assert {r["id"] for r in batches.latest_run(_history(spark)).collect()} == {"c", "d"}


def test_latest_run_without_arrival_column(spark):
    rows = _history(spark).drop("ingestion_timestamp")
    assert {r["id"] for r in batches.latest_run(rows).collect()} == {"c", "d"}
    assert batches.latest_run(rows.filter("false")).count() == 0


def test_latest_run_falls_back_to_other_columns(spark):
    rows = _history(spark).withColumnRenamed("ingestion_timestamp", "created_at")
    assert {r["id"] for r in batches.latest_run(rows).collect()} == {"c", "d"}


def test_latest_batch_and_newest_rows(spark):
    rows = _history(spark)
    assert {r["id"] for r in batches.latest_batch(rows, "ingestion_timestamp").collect()} == {"b", "c"}
    assert [r["id"] for r in batches.newest_rows(rows, n=3).collect()] == ["b", "c", "d"]
    assert batches.distinct_runs(rows).count() == 3


def _log(spark):
    rows = [
        ("a", "job", "2024-01-08 00:00:00", "2024-01-08 00:01:00"),
        ("a", "job", "2024-01-08 01:00:00", None),
        ("b", "job", "2024-01-01 00:00:00", "2024-01-01 00:01:00"),
        ("c", "other", "2023-12-31 23:59:59", None),
    ]
    log = spark.createDataFrame(rows, "run_id string, pipeline_name string, s string, e string")
    stamped = log.withColumns({"start_time": F.to_timestamp("s"), "end_time": F.to_timestamp("e")})
    return stamped.drop("s", "e").withColumn("metadata", F.create_map(F.lit("k"), "run_id"))


def test_run_status_prefers_ended_rows(spark):
    log = _log(spark)
    assert batches.run_status(log, "a").first()["end_time"] == dt.datetime(2024, 1, 8, 0, 1)
    assert batches.run_status(log, "none").count() == 0
    every = {r["run_id"]: r for r in batches.run_statuses(log).collect()}
    assert every["a"]["end_time"] == dt.datetime(2024, 1, 8, 0, 1)
    assert every["c"]["end_time"] is None
    assert every["b"]["metadata"] == {"k": "b"}


def test_look_back_is_a_date_bound(spark):
    as_of = dt.datetime(2024, 1, 8, 18, tzinfo=UTC)
    found = batches.recent_runs(_log(spark), as_of, 7)
    assert sorted({r["run_id"] for r in found.collect()}) == ["a", "b"]
    assert batches.recent_runs(_log(spark), as_of, 30, "other").count() == 1
