import decimal
import math

import pytest
from pyspark.sql import functions as F

from marketstrata.contracts import LEADERS, METRICS
from marketstrata.operators import leaders, metrics, quantiles, shares
from marketstrata.operators.quantiles import exact_quantiles
from marketstrata.operators.shares import attach_by_key, market_share
from marketstrata.session import fresh_path
from tests.conftest import shape


def test_metrics_of_a_batch(silver_rows):
    row = metrics.market_metrics(market_share(silver_rows)).first()
    pairs = [(r["market_cap_usd"], r["price_change_percentage_24h"]) for r in silver_rows.collect()]
    total = sum(c for c, _ in pairs if c is not None)
    assert row["total_coins"] == 13
    assert float(row["total_market_cap_usd"]) == total
    changes = [p for _, p in pairs if p is not None]
    assert row["avg_price_change_24h"] == pytest.approx(sum(changes) / len(changes))
    weighted = sum(c * p for c, p in pairs if c is not None and p is not None) / total
    assert row["market_cap_weighted_24h_return"] == pytest.approx(weighted)
    assert (row["coins_positive_24h"], row["coins_negative_24h"]) == (6, 5)
    assert row["dominance_btc"] is None


def test_dominance_from_totals_equals_stored_share(silver_rows):
    anchors = {"btc": "k00", "eth": "k12"}
    stored = metrics.market_metrics(market_share(silver_rows), anchors=anchors).first()
    derived = metrics.market_metrics(silver_rows, anchors=anchors).first()
    assert stored == derived
    assert stored["dominance_btc"] == 900.0 / 5450.0 * 100


def test_empty_batch_gives_nulls(silver_rows):
    row = metrics.market_metrics(market_share(silver_rows.filter("false"))).first()
    assert (row["total_coins"], row["total_market_cap_usd"], row["market_cap_weighted_24h_return"]) == (0, None, None)


def test_gold_types(silver_rows):
    rows = market_share(silver_rows)
    assert shape(metrics.gold_metrics(rows).schema) == shape(METRICS)
    found = leaders.gold_leaders(rows)
    assert shape(found.schema) == shape(LEADERS)
    assert found.filter("coin_id = 'k00'").first()["market_cap_usd"] == decimal.Decimal("900.00")


def test_rank_keeps_ties_and_skips(silver_rows):
    found = {r["coin_id"]: r["rank"] for r in leaders.top_by_market_cap(silver_rows).collect()}
    # k09 and k10 share rank 10, so eleven coins make it.
    assert found["k01"] == found["k02"] == 2
    assert found["k03"] == 4
    assert found["k09"] == found["k10"] == 10
    assert len(found) == 11


def test_null_caps_rank_last(silver_rows):
    few = silver_rows.filter("coin_id in ('k00', 'k12')")
    found = {r["coin_id"]: r["rank"] for r in leaders.top_by_market_cap(few).collect()}
    assert found == {"k00": 1, "k12": 2}


def test_rank_per_batch_equals_single_batch(silver_rows):
    two = silver_rows.withColumn("b", F.lit("x")).unionByName(
        silver_rows.filter("market_cap_usd < 700").withColumn("b", F.lit(None).cast("string"))
    )
    found = leaders.top_by_market_cap(two, batch="b")
    alone = leaders.top_by_market_cap(silver_rows.filter("market_cap_usd < 700"))
    part = {(r["coin_id"], r["rank"]) for r in found.filter("b is null").collect()}
    assert part == {(r["coin_id"], r["rank"]) for r in alone.collect()}


def test_top_lists_break_ties_by_id(silver_rows):
    flat = silver_rows.withColumn("total_volume_24h", F.lit(1.0))
    assert [r["coin_id"] for r in leaders.top_volume(flat, 3).collect()] == ["k00", "k01", "k02"]
    assert [r["coin_id"] for r in leaders.top_gainers(silver_rows, 2).collect()] == ["k12", "k11"]


def test_top_performers_marks_only_shared_leaders(silver_rows):
    rows = {r["coin_id"]: r for r in leaders.top_performers(market_share(silver_rows)).collect()}
    gainers = {r["coin_id"] for r in leaders.top_gainers(silver_rows).collect()}
    assert set(rows) == {f"k{i:02d}" for i in range(11)}
    for coin, row in rows.items():
        assert (row["top_gainer_24h"] is not None) == (coin in gainers)


def test_batch_share_by_broadcast_and_by_shuffle_agree(spark, silver_rows):
    rows = silver_rows.withColumn("b", F.when(F.col("market_cap_usd") > 600, "x").when(F.col("market_cap_usd") > 90, "y"))
    totals = rows.groupBy("b").agg(F.count("*").alias("n"))
    small = sorted(map(str, attach_by_key(rows, F.broadcast(totals), ["b"]).collect()))
    merged = attach_by_key(rows, totals.hint("merge"), ["b"])
    assert small == sorted(map(str, merged.collect()))
    assert merged.filter("b is null").first()["n"] == 2


def test_batch_share_sums_to_hundred(silver_rows):
    rows = silver_rows.filter("market_cap_usd is not null").withColumn("b", F.col("market_cap_usd") > 500)
    sums = market_share(rows, batch="b").groupBy("b").agg(F.sum("market_dominance").alias("s")).collect()
    assert all(math.isclose(r["s"], 100.0) for r in sums)


def test_nan_ranks_last(spark, silver_rows):
    broken = silver_rows.withColumn("market_cap_usd", F.when(F.col("coin_id") == "k05", float("nan")).otherwise(F.col("market_cap_usd")))
    assert leaders.top_by(broken, "market_cap_usd", 1).first()["coin_id"] == "k00"
    ranks = {r["coin_id"]: r["rank"] for r in leaders.top_by_market_cap(broken, 13).collect()}
    assert ranks["k00"] == 1 and ranks["k05"] == ranks["k12"] == 12


def test_price_stats(coins):
    row = metrics.price_stats(coins).first()
    assert (row["total_records"], row["unique_coins"], row["min_price"], row["max_price"]) == (3, 2, 2000.0, 40000.0)
    assert row["avg_price"] == 27000.0
    assert metrics.price_stats(coins, approximate=True).first()["unique_coins"] == 2


@pytest.mark.parametrize("approximate", [False, True])
def test_profile_of_a_column(spark, approximate):
    rows = spark.range(1, 101).selectExpr("cast(id as double) as x", "cast(null as double) as y")
    rows = rows.unionByName(spark.sql("select cast('NaN' as double) as x, cast(null as double) as y"))
    found = {r["column"]: r for r in metrics.profile_columns(rows, ["x", "y"], approximate).collect()}
    x = found["x"]
    assert (x["count"], x["mean"], x["min"], x["p25"], x["p50"], x["p75"], x["max"]) == (100, 50.5, 1, 25, 50, 75, 100)
    assert x["stddev"] == pytest.approx(29.0114919758)
    assert (found["y"]["count"], found["y"]["p50"]) == (0, None)


def test_exact_quantiles_of_awkward_columns(spark):
    """Wide magnitudes, one value holding most rows, and few slots, against sorting."""
    wide = [10.0**k for k in range(-10, 15)] + [-(10.0**k) for k in range(5)] + [0.0]
    hot = [7.0] * 28 + [1.0, 7.000001, 9.0]
    rows = spark.createDataFrame(list(zip(wide, hot, strict=True)), "wide double, hot double")
    ps = [0.01, 0.25, 0.5, 0.75, 1.0]
    found = exact_quantiles(rows, ["wide", "hot"], ps, slots=64)
    for name, values in (("wide", wide), ("hot", hot)):
        ordered = sorted(values)
        assert found[name] == [ordered[max(1, math.ceil(p * len(ordered))) - 1] for p in ps]


def test_profile_with_nan_and_both_infinities(spark):
    """NaN is left out, infinities are values: their ranks count, and mean and deviation say so."""
    inf, nan = float("inf"), float("nan")
    values = [-inf, -inf, *range(10), nan, None, inf, inf, inf]
    rows = spark.createDataFrame([(None if v is None else float(v), float(i), inf, None) for i, v in enumerate(values)], "x double, y double, z double, w double")
    ordered = sorted(v for v in values if v is not None and v == v)
    for approximate in (False, True):
        found = {r["column"]: r for r in metrics.profile_columns(rows, ["x", "y", "z", "w"], approximate).collect()}
        x = found["x"]
        assert (x["count"], x["min"], x["max"]) == (15, -inf, inf) and math.isnan(x["mean"])
        assert [x["p25"], x["p50"], x["p75"]] == [ordered[math.ceil(p * 15) - 1] for p in (0.25, 0.5, 0.75)]
        assert [found["z"][c] for c in ("mean", "min", "p50", "max")] == [inf] * 4
        assert (found["w"]["count"], found["w"]["p50"], found["w"]["mean"]) == (0, None, None)


def test_quantiles_at_the_edges_of_the_infinities(spark):
    inf = float("inf")
    rows = spark.createDataFrame([(v,) for v in [-inf] * 3 + [1.0, 2.0] + [inf] * 5], "x double")
    ps = [0.0, 0.3, 0.31, 0.5, 0.51, 1.0]
    assert exact_quantiles(rows, ["x"], ps)["x"] == [-inf, -inf, 1.0, 2.0, inf, inf]


def test_a_profile_scans_its_input_twice(spark):
    """The second scan is left out where nothing is left to find."""
    seen = spark.sparkContext.accumulator(0)

    def tell(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(0, 30_000, 1, 4).selectExpr("cast((id * 7919) % 30011 as double) as x", "cast(id % 7 as double) as y")
    watched = rows.mapInArrow(tell, rows.schema)
    found = {r["column"]: r for r in metrics.profile_columns(watched, ["x", "y"]).collect()}
    assert seen.value == 60_000
    ordered = sorted((i * 7919) % 30011 for i in range(30_000))
    assert [found["x"][c] for c in ("p25", "p50", "p75")] == [ordered[math.ceil(p * 30_000) - 1] for p in (0.25, 0.5, 0.75)]
    assert [found["y"][c] for c in ("p25", "p50", "p75")] == [1.0, 3.0, 5.0]


def test_a_sketch_that_misses_is_made_good(spark, monkeypatch):
    """With bounds on the wrong side, all values are counted instead."""
    rows = spark.range(1000).selectExpr("cast(id as double) as x")
    first = {"n_0": 1000, "low_0": 0, "high_0": 0, "below0_0": 900.0, "above0_0": 950.0}
    assert quantiles.refine_quantiles(rows, ["x"], [0.5], first) == {(0, 0): 499.0}


def test_top_performers_read_the_batch_twice(spark, silver_rows):
    path = fresh_path(spark, "batch")
    silver_rows.withColumn("market_dominance", F.lit(1.0)).write.parquet(path)
    seen = spark.sparkContext.accumulator(0)

    def tell(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    stored = spark.read.parquet(path)
    rows = {r["coin_id"]: r for r in leaders.top_performers(stored.mapInArrow(tell, stored.schema)).collect()}
    assert seen.value == 2 * 13
    assert rows["k01"]["market_cap_rank"] == rows["k02"]["market_cap_rank"] == 2
    gains = sorted((r for r in silver_rows.collect()), key=lambda r: (r["price_change_percentage_24h"] is None, -(r["price_change_percentage_24h"] or 0), r["coin_id"]))
    leading = {r["coin_id"] for r in gains[:10]}
    assert all((r["top_gainer_24h"] is not None) == (c in leading) for c, r in rows.items())
