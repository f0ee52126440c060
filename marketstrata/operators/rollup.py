"""Figures of each run and layer, stored once and added up, so that monitoring does not read the history again."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketstrata.contracts import FIGURES, STATISTICS
from marketstrata.functions import MONEY, PRICE, exact_sum, percentage, quoted, text_literal
from marketstrata.operators.conform import fit_contract
from marketstrata.operators.monitor import Layer

RUN = "pipeline_run_id"

#: Sketches have 2^14 registers: a relative standard error of 0.8 %; up to some thousand coins they are all but exact.
COIN_BITS = 14
COIN_ERROR = 1.04 / 2 ** (COIN_BITS / 2)


def run_figures(
    layer: Layer, recorded_at: dt.datetime | Column, run_id: str | None = None, days: list[dt.date] | None = None
) -> DataFrame:
    """Figures of the rows of ``layer`` as one row of run ``run_id``, or one row for each run among them.

    All of them are sums, extremes and sketches, so rows of any number of runs add up to the figures of their union.
    ``days`` are the partitions in which the run's rows lie. A run without rows gives a row of zeros and NULLs.
    """
    nulls = ", ".join(f"{text_literal(c)}, count_if({quoted(c)} is null)" for c in layer.nulls)
    cap = layer.cap or layer.average_cap
    moment = recorded_at if isinstance(recorded_at, Column) else F.lit(recorded_at)
    figures = [
        F.expr("count(1) as row_count"),
        F.expr(f"min({layer.time}) as first_record"),
        F.expr(f"max({layer.time}) as last_record"),
        F.expr(f"hll_sketch_agg(cast({layer.coin} as string), {COIN_BITS}) as coins" if layer.coin else "cast(null as binary) as coins"),
        F.expr(f"{exact_sum(layer.price, PRICE)} as price_sum" if layer.price else "cast(null as decimal(38,10)) as price_sum"),
        F.expr(f"count(try_cast({layer.price} as {PRICE})) as price_count" if layer.price else "0L as price_count"),
        F.expr(f"{exact_sum(cap)} as cap_sum" if cap else "cast(null as decimal(38,2)) as cap_sum"),
        F.expr(f"count(try_cast({cap} as {MONEY})) as cap_count" if cap else "0L as cap_count"),
        F.expr(f"map({nulls}) as nulls" if nulls else "cast(map() as map<string,bigint>) as nulls"),
    ]
    counted = layer.rows.agg(*figures).withColumn(RUN, F.lit(run_id)) if run_id else layer.rows.groupBy(RUN).agg(*figures)
    found = counted.withColumns({"layer": F.lit(layer.name), "recorded_at": moment, "days": F.lit(days or []).cast("array<date>")})
    return fit_contract(found, FIGURES)


def newest_attempts(figures: DataFrame) -> DataFrame:
    """Of rows that one run recorded for one layer the last; a repeated run replaces its own figures in this way."""
    order = Window.partitionBy("layer", RUN).orderBy(F.desc("recorded_at"), F.desc("row_count"))
    return figures.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def add_figures(figures: DataFrame, layers: list[Layer]) -> DataFrame:
    """One row a layer, over all its runs, in the columns of ``monitor.layer_figures``: figures and NULL percentages.

    ``unique_coins`` is estimated from the union of the runs' sketches, within ``COIN_ERROR`` (one standard error).
    A layer nobody recorded counts as empty.
    """
    wanted = figures.sparkSession.createDataFrame([(la.name, la.cap is not None, la.average_cap is not None) for la in layers], "layer string, sums boolean, means boolean")
    summed = newest_attempts(figures).groupBy("layer").agg(
        F.sum("row_count").alias("row_count"),
        F.min("first_record").alias("first_record"),
        F.max("last_record").alias("last_record"),
        F.expr("hll_sketch_estimate(hll_union_agg(coins)) as unique_coins"),
        F.expr("try_divide(cast(sum(price_sum) as double), cast(sum(price_count) as double)) as avg_price"),
        F.expr("cast(sum(cap_sum) as double) as cap"),
        F.expr("sum(cap_count) as caps"),
        *[F.expr(f"sum(nulls[{text_literal(c)}]) as {quoted(f'{la.name}.{c}'.replace('.', '_'))}") for la in layers for c in la.nulls],
    )
    columns = {la.name: [f"named_struct('column', {text_literal(c)}, 'percent', {percentage(quoted(f'{la.name}_{c}'), 'row_count')})" for c in la.nulls] for la in layers}
    kind = "array<struct<column:string,percent:double>>"
    lists = " ".join(f"when {text_literal(name)} then cast(array({', '.join(c)}) as {kind})" for name, c in columns.items())
    return wanted.join(F.broadcast(summed), "layer", "left").select(
        "layer",
        F.expr("coalesce(row_count, 0L) as row_count"),
        "first_record",
        "last_record",
        F.expr("coalesce(unique_coins, 0L) as unique_coins"),
        "avg_price",
        F.expr("case when sums then cap end as total_market_cap"),
        F.expr("case when means then try_divide(cap, caps) end as avg_market_cap"),
        F.expr(f"case layer {lists} end as nulls"),
    )


def statistics(figures: DataFrame, layers: list[Layer]) -> DataFrame:
    """The statistics half of the health report, from the stored figures."""
    return coined(add_figures(figures, layers), layers)


def coined(summed: DataFrame, layers: list[Layer]) -> DataFrame:
    """Added figures as statistics; layers without coins have no number of them."""
    names = [la.name for la in layers if la.coin]
    return fit_contract(summed.withColumn("unique_coins", F.when(F.col("layer").isin(names), F.col("unique_coins"))), STATISTICS)


def newest_run(figures: DataFrame, layer: str) -> DataFrame:
    """One row, ``pipeline_run_id, last_record, days``: the run whose rows of ``layer`` arrived last, ties to the greatest id."""
    seen = newest_attempts(figures).filter((F.col("layer") == layer) & (F.col("row_count") > 0))
    return seen.select("last_record", RUN, "days").orderBy(F.desc("last_record"), F.desc(RUN)).limit(1).select(RUN, "last_record", "days")
