"""The physical plans that matter at scale."""

import pytest
from pyspark.sql import functions as F

from marketstrata.operators import batches, leaders, tables
from marketstrata.operators.dedupe import dedupe_snapshot
from marketstrata.operators.monitor import row_count_check, silver_layer
from marketstrata.operators.quality import validation_report
from marketstrata.operators.shares import market_share
from marketstrata.session import fresh_path, shared_dir
from marketstrata.showcase import QUERIES, payloads, runs


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _files(spark, df):
    path = fresh_path(spark, "plan")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def test_share_of_one_batch_moves_no_rows(spark, silver_rows):
    plan = _plan(market_share(_files(spark, silver_rows)))
    outer = plan.split("Subquery")[0]
    assert "Exchange" not in outer and "Window" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_share_per_batch_aggregates_before_the_shuffle(spark, silver_rows):
    plan = _plan(market_share(_files(spark, silver_rows), batch="silver_ingestion_time"))
    assert "partial_sum" in plan and "Window" not in plan and "SinglePartition" not in plan


def test_rank_prunes_before_the_single_task(spark, silver_rows):
    plan = _plan(leaders.top_by_market_cap(_files(spark, silver_rows)))
    assert "TakeOrderedAndProject" in plan and "BroadcastHashJoin" in plan
    assert "SinglePartition" not in plan


def test_top_k_never_sorts_everything(spark, silver_rows):
    for plan in (_plan(leaders.top_gainers(silver_rows)), _plan(leaders.top_volume(silver_rows))):
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_dedupe_aggregates_before_the_shuffle(spark, coins):
    plan = _plan(dedupe_snapshot(_files(spark, coins), ["id"]))
    assert "partial_max" in plan.split("Exchange")[1] and plan.count("Exchange") == 1


def test_validation_reads_once(spark, coins):
    assert _plan(validation_report(_files(spark, coins))).count("FileScan") == 1


def test_latest_run_reads_one_partition(spark, schema):
    name = f"{schema}.history"
    rows = spark.range(300).selectExpr("id", "cast(id % 30 as string) as pipeline_run_id", "id as created_at")
    tables.create_from(rows, name, ["pipeline_run_id"])
    found = batches.latest_run(spark.read.table(name)).select("id")
    assert found.count() == 10
    plan = _plan(found)
    assert "PartitionFilters: [isnotnull(pipeline_run_id" in plan and "= Subquery" in plan


def test_a_check_reads_only_its_columns(spark, silver_rows):
    plan = _plan(row_count_check([silver_layer(_files(spark, silver_rows))]))
    assert "ReadSchema: struct<>" in plan


def test_merge_shuffles_each_side_once(spark):
    rows = spark.range(100).selectExpr("cast(id as string) as coin_id", "timestamp_micros(id) as last_updated", "1 as v")
    stored = _files(spark, rows)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(tables.new_versions(stored, stored, ["coin_id", "last_updated"], keep_null_keys=False))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange") == 2
    assert "partial_max" in plan


def test_partitioned_write_makes_few_files_and_splits_hot_partitions(spark, schema):
    """Eight tasks hold every day; one day holds most rows."""
    rows = spark.range(0, 80_000, 1, 8).selectExpr("id", "md5(cast(id as string)) as pad", "if(id % 10 = 0, 'b', 'a') as day")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        tables.write_table(rows, f"{schema}.days", partition_by=["day"], stamp=False)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    found = spark.read.table(f"{schema}.days")
    files = found.groupBy("day", F.input_file_name().alias("f")).count().groupBy("day").count().collect()
    files = {r["day"]: r["count"] for r in files}
    assert found.count() == 80_000
    assert files["b"] < 8 and files["a"] > 1


def test_shared_folder_follows_the_session(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        assert shared_dir(spark) == named.rstrip("/")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    assert fresh_path(spark, "x").startswith(shared_dir(spark))


def test_share_of_a_hot_run_runs_nothing_while_it_is_built(spark):
    """One run holds most rows; its rows are aggregated before the join, and no job runs to choose a plan."""
    rows = spark.range(0, 2000, 1, 16).selectExpr("if(id < 1900, 'hot', 'cold') as run", "cast(1 as double) as market_cap_usd")
    spark.sparkContext.setJobGroup("building", "building")
    found = market_share(rows, batch="run")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    hot = found.filter("run = 'hot'")
    assert hot.count() == 1900
    assert abs(hot.agg(F.sum("market_dominance")).first()[0] - 100) < 1e-6


@pytest.mark.parametrize(("module", "name"), [(payloads, "hourly_two_runs"), (runs, "hourly_rerun"), (runs, "hourly_late_run")])
def test_the_payload_of_several_runs_is_built_once(spark, coins, monkeypatch, module, name):
    built = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            built.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(module, "market_payload", lambda *_: coins.mapInArrow(counted, coins.schema))
    assert [r.total_coins for r in QUERIES[name](spark, "").collect()] == [2, 2]
    assert built.value == coins.count()
