"""Rankings and top-k lists of a batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketstrata.contracts import LEADERS, SILVER
from marketstrata.operators.conform import fit_contract
from marketstrata.operators.shares import attach_by_key

# What a leader carries from silver as it is.
LEADER_COLUMNS = [c for c in LEADERS.fieldNames() if c in SILVER.fieldNames() and c not in ("market_cap_rank", "total_volume_24h")]


def top_by_market_cap(
    df: DataFrame, k: int = 10, batch: str | None = None, value: str = "market_cap_usd"
) -> DataFrame:
    """Rows with ``rank() <= k`` by descending ``value``; ties share a rank, NULL and NaN rank last.

    Rank only depends on the ``k`` greatest values, which every map task can prune to. Their
    ranks are worked out on at most ``k`` rows per batch and joined back, so that any number of
    tied rows stays spread over the cluster.
    """
    falling = F.col("_value").desc_nulls_last()
    if batch is None:
        df = df.withColumn("_rankable", number_or_null(df, value))
        values = df.select(F.col("_rankable").alias("_value")).orderBy(falling).limit(k)
        levels = values.withColumn("rank", F.rank().over(Window.orderBy(falling))).distinct()
        joined = df.join(F.broadcast(levels), F.col("_rankable").eqNullSafe(F.col("_value")))
        return joined.drop("_value", "_rankable")
    per_batch = Window.partitionBy("_batch").orderBy(falling)
    df = df.withColumn("_rankable", number_or_null(df, value))
    values = df.select(F.col(batch).alias("_batch"), F.col("_rankable").alias("_value"))
    values = values.withColumn("_n", F.row_number().over(per_batch)).filter(F.col("_n") <= k).drop("_n")
    levels = values.withColumn("rank", F.rank().over(per_batch)).distinct()
    small = levels.withColumnsRenamed({"_batch": batch, "_value": "_rankable"})
    return attach_by_key(df, small, [batch, "_rankable"], how="inner").drop("_rankable")


def number_or_null(df: DataFrame, value: str) -> Column:
    """The column with NaN as NULL: Spark would order NaN above every number."""
    floating = isinstance(df.schema[value].dataType, (T.FloatType, T.DoubleType))
    return F.when(~F.isnan(value), F.col(value)) if floating else F.col(value)


def top_by(df: DataFrame, value: str, k: int = 10, tie: str = "coin_id") -> DataFrame:
    """The ``k`` rows greatest by ``value``, NaN and NULL last; equal values are ordered by ``tie``."""
    return df.orderBy(number_or_null(df, value).desc_nulls_last(), F.col(tie).asc_nulls_last()).limit(k)


def top_gainers(df: DataFrame, k: int = 10) -> DataFrame:
    return top_by(df, "price_change_percentage_24h", k).select(
        "coin_id", "name", "symbol", "current_price_usd", "price_change_percentage_24h", "market_cap_usd"
    )


def top_volume(df: DataFrame, k: int = 10) -> DataFrame:
    return top_by(df, "total_volume_24h", k).select(
        "coin_id", "name", "symbol", "total_volume_24h", "market_cap_usd"
    )


_GAIN, _VOLUME = "price_change_percentage_24h", "total_volume_24h"


def _bests(df: DataFrame, k: int) -> DataFrame:
    """One row, one struct: ranks of the ``k`` greatest caps, and the coins that lead by gain and by volume.

    All three lists come from one pass, in which each task keeps ``k`` rows a measure.
    """
    measures = [F.struct(F.lit(m).alias("m"), number_or_null(df, c).alias("v")) for m, c in (("cap", "market_cap_usd"), ("gain", _GAIN), ("volume", _VOLUME))]
    order = Window.partitionBy("m").orderBy(F.col("v").desc_nulls_last(), F.col("coin_id").asc_nulls_last())
    first = df.select("coin_id", F.inline(F.array(*measures))).withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k)
    # Tied values share the rank of the first of them.
    ranked = first.withColumn("rank", F.min("n").over(Window.partitionBy("m", "v")))
    pick = lambda m: F.collect_list(F.when(F.col("m") == m, F.struct("coin_id", "v", "rank")))
    return ranked.agg(F.struct(*[pick(m).alias(m) for m in ("cap", "gain", "volume")]).alias("bests"))


def top_performers(df: DataFrame, as_of: str = "silver_ingestion_time", k: int = 10) -> DataFrame:
    """Cap leaders, with the gain and the volume of those that also lead by gain or by volume.

    ``df`` is one batch with a row a coin. It is read twice: once for the three lists of at most ``k`` entries, once to
    pick the rows whose cap is among the greatest, any number of ties included.
    """
    entry = lambda m, same: F.try_element_at(F.filter(F.col(f"_bests.{m}"), same), F.lit(1))
    own = lambda x: x["coin_id"] == F.col("coin_id")
    cap = number_or_null(df, "market_cap_usd")
    beside = df.withColumn("_bests", _bests(df, k).scalar())
    found = beside.withColumn("_rank", entry("cap", lambda x: x["v"].eqNullSafe(cap))["rank"]).filter("_rank is not null")
    named = {
        "market_cap_rank": F.col("_rank"),
        "top_gainer_24h": entry("gain", own)["v"],
        _VOLUME: entry("volume", own)["v"],
        "as_of_timestamp": F.col(as_of),
    }
    return found.select(*[named.get(c, F.col(c)).alias(c) for c in LEADERS.fieldNames()])


def gold_leaders(silver_batch: DataFrame) -> DataFrame:
    """Top performers in the types of the gold table."""
    return fit_contract(top_performers(silver_batch), LEADERS)
