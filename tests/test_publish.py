"""Version folders, compaction, merges by the days present, and the plans behind them."""

import datetime as dt
import os
import urllib.parse

import pytest
from pyspark.sql import functions as F

from marketstrata.operators import batches, publish, tables


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _paths(df):
    """Folders that a scan was pruned to."""
    return int(_plan(df).split("InMemoryFileIndex(")[1].split(" path")[0])


def _days(spark, n=10):
    return spark.range(n * 4).selectExpr("id", f"date_add(date'2024-01-01', cast(id % {n} as int)) as day")


def test_only_published_partitions_change_and_the_old_version_stays(spark, schema):
    name = f"{schema}.days"
    tables.create_from(_days(spark), name, ["day"])
    old = set(spark.read.table(name).inputFiles())
    changed = spark.read.table(name).filter("day < date'2024-01-03'").withColumn("id", F.col("id") + 100)
    assert publish.publish_partitions(changed, name) == 2
    found = {r["day"].day: r["s"] for r in spark.read.table(name).groupBy("day").agg(F.sum("id").alias("s")).collect()}
    assert (found[1], found[2], found[3]) == (60 + 400, 64 + 400, 68)
    assert spark.read.table(name).count() == 40
    assert all(os.path.exists(urllib.parse.unquote(urllib.parse.urlparse(f).path)) for f in old)


@pytest.mark.parametrize("partitioned", [True, False])
def test_a_failure_before_the_switch_leaves_the_old_rows(spark, schema, monkeypatch, partitioned):
    name = f"{schema}.safe"
    tables.create_from(_days(spark), name, ["day"] if partitioned else None)

    def fails(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(publish, "switch_partitions" if partitioned else "switch_table", fails)
    new = _days(spark).withColumn("id", F.lit(-1).cast("long"))
    with pytest.raises(RuntimeError):
        (publish.publish_partitions if partitioned else publish.publish_table)(new, name)
    assert sorted(r[0] for r in spark.read.table(name).select("id").collect()) == list(range(40))
    monkeypatch.undo()
    (publish.publish_partitions if partitioned else publish.publish_table)(new, name)
    assert {r[0] for r in spark.read.table(name).select("id").collect()} == {-1}
    # Appends go to the version that is current.
    tables.write_table(_days(spark), name, "append", stamp=False)
    assert spark.read.table(name).count() == 80


def test_partition_values_with_signs_and_nulls(spark, schema):
    name = f"{schema}.odd"
    values = ["plain", "a b", "x=1/2", "50%+1", "it's", "é", None]
    rows = spark.createDataFrame([(k, v, k % 2) for k, v in enumerate(values)], "n int, run string, half int")
    tables.create_typed_table(spark, name, rows.schema, ["run", "half"])
    for _ in range(2):
        assert publish.publish_partitions(rows, name) == len(values)
        assert {(r["n"], r["run"], r["half"]) for r in spark.read.table(name).collect()} == {(k, v, k % 2) for k, v in enumerate(values)}
    publish.publish_partitions(rows.filter("run = 'x=1/2'").withColumn("n", F.lit(9)), name)
    assert spark.read.table(name).filter("run = 'x=1/2'").first()["n"] == 9


def test_publishing_nothing_changes_nothing(spark, schema):
    name = f"{schema}.still"
    tables.create_from(_days(spark), name, ["day"])
    assert publish.publish_partitions(_days(spark).filter("false"), name) == 0
    assert spark.read.table(name).count() == 40
    with pytest.raises(ValueError):
        publish.publish_table(_days(spark), name)


@pytest.mark.parametrize("partitioned", [True, False])
def test_compaction_keeps_rows_and_bounds_files(spark, schema, partitioned):
    """24 hourly appends; a table read and written meanwhile keeps its rows."""
    name = f"{schema}.pieces"
    for hour in range(24):
        rows = spark.range(hour * 10, hour * 10 + 10).selectExpr("id", "if(id % 10 = 0, 'b', 'a') as part")
        tables.write_table(rows.coalesce(1), name, "append", partition_by=["part"] if partitioned else None, stamp=False)
    table = lambda: spark.read.table(name)
    assert len(table().inputFiles()) >= 24
    before = sorted(map(tuple, table().collect()))
    assert publish.compact_table(spark, name) == (2 if partitioned else 1)
    assert sorted(map(tuple, table().collect())) == before
    assert len(table().inputFiles()) == (2 if partitioned else 1)
    assert publish.compact_table(spark, name) == 0


def test_bins_hold_at_most_the_target_and_one_file(spark, schema):
    name = f"{schema}.sized"
    for k in range(12):
        tables.write_table(spark.range(k * 1000, k * 1000 + 500).selectExpr("id", "'a' as part").coalesce(1), name, "append", partition_by=["part"], stamp=False)
    sizes = [r["size"] for r in publish.file_bins(spark.read.table(name), ["part"], 1).collect()]
    target = 3 * max(sizes)
    binned = publish.file_bins(spark.read.table(name), ["part"], target).groupBy("bin").agg(F.sum("size").alias("s")).collect()
    assert all(r["s"] <= target + max(sizes) for r in binned) and len(binned) == -(-sum(sizes) // target)
    # Only a part of the table is looked at where asked.
    assert publish.compact_table(spark, name, where=F.col("part") == "other") == 0


# --- merge by the days present ----------------------------------------------------------------


def _versions(spark, days, offset=0):
    rows = [(f"c{k}", dt.datetime(*d, 12, tzinfo=dt.timezone.utc), k + offset) for k, d in enumerate(days)]
    return spark.createDataFrame(rows, "coin_id string, last_updated timestamp, v int")


KEYS = ["coin_id", "last_updated"]


def test_an_old_key_leaves_all_other_partitions_unread(spark, schema):
    name = f"{schema}.history"
    days = [(2020 + k // 300, 1 + (k // 25) % 12, 1 + k % 25) for k in range(1300)]
    tables.insert_only_merge(_versions(spark, days), name, KEYS, day="day")
    updates = _versions(spark, [(2020, 1, 1), (2024, 5, 1)], 5000).withColumn("day", tables.day_of("last_updated"))
    target = spark.read.table(name)
    assert target.select("day").distinct().count() > 1000
    assert _paths(target.filter(tables.on_days(updates, "day"))) <= 2
    plan = _plan(tables.new_versions(updates, target, KEYS, keep_null_keys=False, day="day"))
    assert "PartitionFilters: [day" in plan and "LeftSemi" in plan
    assert "day#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    tables.insert_only_merge(updates, name, KEYS, day="day")
    found = {r["v"] for r in spark.read.table(name).filter("v >= 5000").collect()}
    # c0 on the first day is stored already; c1 has no version of that day.
    assert found == {5001}


def test_merge_by_day_equals_merge_by_range(spark, schema):
    days = [(2021, 1 + k % 12, 1 + k % 28) for k in range(100)]
    for name, day in ((f"{schema}.a", None), (f"{schema}.b", "day")):
        tables.insert_only_merge(_versions(spark, days[:60]), name, KEYS, day=day)
        tables.insert_only_merge(_versions(spark, days, 1000), name, KEYS, day=day)
        tables.insert_only_merge(_versions(spark, days, 2000), name, KEYS, day=day)
    rows = [sorted(map(tuple, spark.read.table(f"{schema}.{t}").select("coin_id", "last_updated", "v").collect())) for t in "ab"]
    assert rows[0] == rows[1] and len(rows[0]) == 100


def test_many_days_are_bounded_by_their_span(spark, monkeypatch):
    monkeypatch.setattr(tables, "MAX_DAYS", 3)
    rows = _days(spark)
    assert "IN" in str(tables.on_days(rows.filter("day < date'2024-01-03'"), "day")).upper()
    kept = rows.filter(tables.on_days(rows.filter("id % 10 in (2, 4, 5, 7)"), "day")).select("day").distinct()
    assert sorted(r[0].day for r in kept.collect()) == [3, 4, 5, 6, 7, 8]
    assert rows.filter(tables.on_days(rows.filter("false"), "day")).count() == 0


def test_days_do_not_follow_the_session_time_zone(spark):
    instant = spark.sql("select timestamp'2024-02-29 23:30:00Z' as at, timestamp'1969-12-31 23:59:59Z' as early")
    for zone in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
        before = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            row = instant.select(tables.day_of("at"), tables.month_of("at"), tables.day_of("early")).first()
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)
        assert tuple(row) == (dt.date(2024, 2, 29), dt.date(2024, 2, 1), dt.date(1969, 12, 31))


def test_a_registered_run_is_looked_up_not_searched(spark, schema):
    name = f"{schema}.history"
    rows = spark.range(300).selectExpr("id", "cast(id % 30 as string) as pipeline_run_id", "id as ingestion_timestamp")
    tables.create_from(rows, name, ["pipeline_run_id"])
    registry = spark.createDataFrame([("3", 8), ("7", 9), ("5", None)], "pipeline_run_id string, last_record int")
    found = batches.latest_run(spark.read.table(name), registry=registry)
    assert _plan(found).count("FileScan") == 1 and "= Subquery" in _plan(found)
    assert {r["pipeline_run_id"] for r in found.collect()} == {"7"}
    newest = batches.latest_batch(spark.read.table(name), "ingestion_timestamp", registry=registry)
    assert [r["id"] for r in newest.collect()] == [9]
