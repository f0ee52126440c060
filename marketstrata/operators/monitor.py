"""Health checks over the layers, each a DataFrame of alerts.

Every layer is read once: its figures are one aggregate, and all checks are expressions over
the single row that joins those figures. Comparisons are strict. Alerts are
``level, check, subject, observed, threshold, message``.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketstrata.contracts import ALERTS
from marketstrata.functions import PRICE, exact_avg, exact_sum, percentage, quoted, text_literal
from marketstrata.operators.batches import recent_runs


@dataclass(frozen=True)
class Thresholds:
    # Default limits of the checks.
    min_rows: dict[str, int] = field(default_factory=lambda: {"bronze": 10, "silver": 10, "gold": 1})
    max_age_hours: float = 2.0
    max_null_percent: float = 10.0
    min_retention: float = 0.9
    max_cap_difference_percent: float = 1.0
    max_duration_ratio: float = 1.5
    look_back_days: int = 7


DEFAULTS = Thresholds()


@dataclass(frozen=True)
class Layer:
    """How to read the health of one layer from its table."""

    name: str
    rows: DataFrame | None
    time: str
    coin: str | None = None
    price: str | None = None
    cap: str | None = None
    average_cap: str | None = None
    nulls: tuple[str, ...] = ()


def bronze_layer(rows: DataFrame | None) -> Layer:
    return Layer("bronze", rows, "ingestion_timestamp", coin="id")


def silver_layer(rows: DataFrame | None) -> Layer:
    return Layer(
        "silver",
        rows,
        "silver_ingestion_time",
        coin="coin_id",
        price="current_price_usd",
        cap="market_cap_usd",
        nulls=("current_price_usd", "market_cap_usd", "total_volume_24h"),
    )


def gold_layer(rows: DataFrame | None) -> Layer:
    return Layer(
        "gold", rows, "as_of_timestamp", average_cap="total_market_cap_usd", nulls=("total_market_cap_usd",)
    )


_NULL_FIGURES = "array<struct<column:string,percent:double>>"


def layer_figures(layer: Layer, only: set[str] | None = None) -> DataFrame:
    """One row of figures of a layer in one pass over its table, all or just those in ``only``."""
    nulls = ", ".join(
        f"named_struct('column', {text_literal(name)}, "
        f"'percent', {percentage(f'count_if({quoted(name)} is null)', 'count(1)')})"
        for name in layer.nulls
    )
    figures = {
        "row_count": "count(1)",
        "first_record": f"min({layer.time})",
        "last_record": f"max({layer.time})",
        "unique_coins": f"count(distinct {layer.coin})" if layer.coin else "cast(null as bigint)",
        "avg_price": exact_avg(layer.price, PRICE) if layer.price else "cast(null as double)",
        "total_market_cap": f"cast({exact_sum(layer.cap)} as double)" if layer.cap else "cast(null as double)",
        "avg_market_cap": exact_avg(layer.average_cap, PRICE) if layer.average_cap else "cast(null as double)",
        "nulls": f"array({nulls})" if nulls else f"cast(null as {_NULL_FIGURES})",
    }
    wanted = [F.expr(f"{text} as {name}") for name, text in figures.items() if only is None or name in only]
    return layer.rows.agg(F.expr(f"{text_literal(layer.name)} as layer"), *wanted)


def layer_stats(layers: Sequence[Layer]) -> DataFrame:
    """One row of statistics per layer."""
    return _figures(layers, _STATISTICS)


def null_percentage(layers: Sequence[Layer]) -> DataFrame:
    """``layer, column, percent`` of NULLs; an empty table gives NULL."""
    return _figures(layers, {"nulls"}).select("layer", F.inline("nulls"))


_STATISTICS = {
    "row_count", "first_record", "last_record", "unique_coins", "avg_price", "total_market_cap", "avg_market_cap",
}


def _figures(layers: Sequence[Layer], only: set[str]) -> DataFrame:
    frames = [layer_figures(layer, only) for layer in layers]
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union


def _wide(layers: Sequence[Layer], only: set[str]) -> DataFrame:
    """Figures of all layers in one row, one struct column per layer."""
    return _in_one_row(_figures(layers, only), layers)


def _in_one_row(figures: DataFrame, layers: Sequence[Layer]) -> DataFrame:
    rest = ", ".join(c for c in figures.columns if c != "layer")
    picked = [
        F.expr(f"max_by(struct({rest}), case when layer = {text_literal(la.name)} then 1 end) as {quoted(la.name)}")
        for la in layers
    ]
    return figures.agg(*picked)


def _alert(level: str, check: str, subject: str, observed: str, threshold: str, message: str) -> str:
    """One possible alert as a SQL struct; a NULL level means that all is well."""
    values = [level, text_literal(check), subject, observed, threshold, message]
    pairs = zip(values, ALERTS.fields, strict=True)
    fields = ", ".join(f"'{f.name}', cast({v} as {f.dataType.simpleString()})" for v, f in pairs)
    return f"named_struct({fields})"


def _alerts(source: DataFrame, candidates: Sequence[str]) -> DataFrame:
    return source.selectExpr(f"inline(array({', '.join(candidates)}))").filter("level is not null")


def _moment(as_of: dt.datetime | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


# --- candidates: one struct per possible alert, with a NULL level where all is well -----------


def _freshness(layer: Layer, limits: Thresholds) -> list[str]:
    """Needs the column ``as_of``."""
    last = f"{quoted(layer.name)}.last_record"
    age = f"timestampdiff(second, {last}, as_of)"
    limit = f"{limits.max_age_hours * 3600!r}d"
    level = f"case when {last} is null then 'ERROR' when {age} > {limit} then 'WARNING' end"
    text = (
        f"case when {last} is null then '{layer.name} holds no rows' "
        f"else concat('newest row of {layer.name} came ', {age}, ' seconds ago') end"
    )
    return [_alert(level, "freshness", text_literal(layer.name), age, limit, text)]


def _row_count(layer: Layer, limits: Thresholds) -> list[str]:
    floor = str(limits.min_rows.get(layer.name, 1))
    rows = f"{quoted(layer.name)}.row_count"
    level = f"case when {rows} < {floor} then 'WARNING' end"
    text = f"concat('{layer.name} has only ', {rows}, ' rows')"
    return [_alert(level, "row_count", text_literal(layer.name), rows, floor, text)]


def _nulls(layer: Layer, limits: Thresholds) -> list[str]:
    limit, found = f"{limits.max_null_percent!r}d", []
    for i, name in enumerate(layer.nulls):
        subject = f"{layer.name}.{name}"
        percent = f"{quoted(layer.name)}.nulls[{i}].percent"
        level = f"case when {percent} > {limit} then 'WARNING' end"
        text = f"format_string('%.2f%% of {subject} are NULL', {percent})"
        found.append(_alert(level, "nulls", text_literal(subject), percent, limit, text))
    return found


def _retention(bronze: Layer, silver: Layer, limits: Thresholds) -> list[str]:
    before, after = (f"{quoted(layer.name)}.unique_coins" for layer in (bronze, silver))
    ratio, limit = f"try_divide(cast({after} as double), cast({before} as double))", f"{limits.min_retention!r}d"
    level = f"case when {ratio} < {limit} then 'WARNING' end"
    text = f"concat('coins lost between bronze and silver: ', {after}, '/', {before})"
    return [_alert(level, "retention", "'silver/bronze'", ratio, limit, text)]


# --- checks -----------------------------------------------------------------------------------


def freshness_check(layers: Sequence[Layer], as_of, limits: Thresholds = DEFAULTS) -> DataFrame:
    """No rows is an ERROR, a newest row older than the limit a WARNING."""
    found = [c for layer in layers for c in _freshness(layer, limits)]
    return _alerts(_wide(layers, {"last_record"}).withColumn("as_of", _moment(as_of)), found)


def row_count_check(layers: Sequence[Layer], limits: Thresholds = DEFAULTS) -> DataFrame:
    return _alerts(_wide(layers, {"row_count"}), [c for layer in layers for c in _row_count(layer, limits)])


def null_check(layers: Sequence[Layer], limits: Thresholds = DEFAULTS) -> DataFrame:
    """Key columns with too many NULLs; an empty table raises nothing here."""
    return _alerts(_wide(layers, {"nulls"}), [c for layer in layers for c in _nulls(layer, limits)])


def layer_retention(bronze: Layer, silver: Layer, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Too few of the bronze coins in silver; an empty bronze raises nothing here."""
    return _alerts(_wide([bronze, silver], {"unique_coins"}), _retention(bronze, silver, limits))


def cap_reconciliation(
    silver: DataFrame,
    gold: DataFrame,
    limits: Thresholds = DEFAULTS,
    time: str = "silver_ingestion_time",
    as_of: str = "as_of_timestamp",
) -> DataFrame:
    """Newest gold total against the silver batch it was computed from."""
    newest = gold.agg(F.max(as_of).alias("at")).scalar()
    reported = gold.agg(
        F.max_by(F.col("total_market_cap_usd").cast("double"), F.col(as_of)).alias("reported")
    ).scalar()
    batch = silver.filter(F.col(time) == newest)
    sums = batch.agg(F.expr(f"cast({exact_sum('market_cap_usd')} as double) as actual"))
    limit = f"{limits.max_cap_difference_percent!r}d"
    level = f"case when difference > {limit} then 'WARNING' end"
    text = "format_string('market cap differs between silver and gold by %.2f%%', difference)"
    compared = sums.withColumn("reported", reported).selectExpr(
        "abs(try_divide(actual - reported, actual) * 100d) as difference"
    )
    return _alerts(compared, [_alert(level, "cap_reconciliation", "'gold/silver'", "difference", limit, text)])


def batch_reconciliation(
    computed: DataFrame, reported: DataFrame, key: str, total: str = "total", limits: Thresholds = DEFAULTS
) -> DataFrame:
    """Totals of every batch on both sides, both unique on ``key``: a batch that one side lacks is an ERROR.

    A difference beyond the limit is a WARNING. One side with a NULL total where the other has one counts as lacking it.
    """
    held = lambda side, name: side.select(F.col(key).alias(name), F.col(total).cast("double").alias(f"{name}_total"))
    pairs = held(computed, "silver").join(held(reported, "gold"), F.expr("silver <=> gold"), "full_outer")
    limit = f"{limits.max_cap_difference_percent!r}d"
    difference = "abs(try_divide(silver_total - gold_total, silver_total) * 100d)"
    lacking = "silver_total is null and gold_total is not null or gold_total is null and silver_total is not null"
    level = f"case when {lacking} then 'ERROR' when {difference} > {limit} then 'WARNING' end"
    text = (
        "case when silver_total is null then 'gold has a total of a batch that silver lacks' "
        "when gold_total is null then 'gold lacks the total of a batch' "
        f"else format_string('totals of the batch differ by %.2f%%', {difference}) end"
    )
    subject = "coalesce(cast(silver as string), cast(gold as string))"
    return _alerts(pairs, [_alert(level, "batch_reconciliation", subject, difference, limit, text)])


def run_duration_check(
    runs: DataFrame, as_of, name: str | None = None, limits: Thresholds = DEFAULTS
) -> DataFrame:
    """Last run unfinished is an ERROR, much slower than the average a WARNING.

    Looks at runs started in the look-back range; the average includes the last run.
    """
    seconds = F.expr("timestampdiff(second, start_time, end_time) as _seconds")
    taken = recent_runs(runs, as_of, limits.look_back_days, name).select("start_time", "run_id", "end_time", seconds)
    figures = taken.agg(
        F.expr(f"{exact_avg('_seconds')} as average"),
        F.expr("max(struct(start_time, run_id, end_time, _seconds)) as last"),
    )
    ceiling = f"average * {limits.max_duration_ratio!r}d"
    unfinished = "last is not null and last.end_time is null"
    level = f"case when {unfinished} then 'ERROR' when last._seconds > {ceiling} then 'WARNING' end"
    text = (
        f"case when {unfinished} then 'the newest run has not ended' "
        "else format_string('run took %d s, average is %.0f s', last._seconds, average) end"
    )
    return _alerts(figures, [_alert(level, "run_duration", "last.run_id", "last._seconds", ceiling, text)])


def health_report(
    bronze: DataFrame,
    silver: DataFrame,
    gold: DataFrame,
    runs: DataFrame,
    as_of,
    name: str | None = None,
    limits: Thresholds = DEFAULTS,
) -> DataFrame:
    """All alerts. Three layers, one pass each, plus the newest silver batch and the run log."""
    layers = [bronze_layer(bronze), silver_layer(silver), gold_layer(gold)]
    candidates = [c for layer in layers[:2] for c in _freshness(layer, limits)]
    candidates += [c for layer in layers for c in _row_count(layer, limits)]
    candidates += [c for layer in layers for c in _nulls(layer, limits)]
    candidates += _retention(layers[0], layers[1], limits)
    wide = _wide(layers, {"last_record", "row_count", "nulls", "unique_coins"})
    return (
        _alerts(wide.withColumn("as_of", _moment(as_of)), candidates)
        .unionByName(cap_reconciliation(silver, gold, limits))
        .unionByName(run_duration_check(runs, as_of, name, limits))
    )


def figures_report(
    spark: SparkSession,
    figures: Callable[[], DataFrame],
    totals: Callable[[], tuple[DataFrame, DataFrame]],
    runs: Callable[[], DataFrame],
    as_of,
    name: str | None = None,
    limits: Thresholds = DEFAULTS,
) -> DataFrame:
    """All alerts from stored figures, one row a layer in the columns of ``layer_figures``; no layer's table is read.

    ``totals`` gives what each run's market added up to and what gold reports, as ``pipeline_run_id, total``. Each check
    is guarded by itself.
    """
    layers = [bronze_layer(None), silver_layer(None), gold_layer(None)]

    def layer_checks() -> DataFrame:
        candidates = [c for layer in layers[:2] for c in _freshness(layer, limits)]
        candidates += [c for layer in layers for c in (*_row_count(layer, limits), *_nulls(layer, limits))]
        candidates += _retention(layers[0], layers[1], limits)
        return _alerts(_in_one_row(figures(), layers).withColumn("as_of", _moment(as_of)), candidates)

    checks: dict[str, Callable[[], DataFrame]] = {
        "layers": layer_checks,
        "batch_reconciliation": lambda: batch_reconciliation(*totals(), "pipeline_run_id", limits=limits),
        "run_duration": lambda: run_duration_check(runs(), as_of, name, limits),
    }
    return reduce(DataFrame.unionByName, [guarded(spark, check, build) for check, build in checks.items()])


def health_status(alerts: DataFrame) -> DataFrame:
    """One row: ``status`` is 1 if any alert is an ERROR, else 0, with the alert counts."""
    return alerts.agg(
        F.expr("coalesce(max(case when level = 'ERROR' then 1 else 0 end), 0) as status"),
        F.expr("count_if(level = 'ERROR') as errors"),
        F.expr("count_if(level = 'WARNING') as warnings"),
    )


def guarded(spark: SparkSession, check: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Run a check now; a check that fails becomes an ERROR alert itself.

    A check has at most a few dozen alerts, so its rows are fetched and returned as a table.
    """
    try:
        return spark.createDataFrame(build().collect(), ALERTS)
    except (PySparkException, Py4JError, ValueError) as problem:
        row = ("ERROR", check, check, None, None, f"error in {check}: {problem}")
        return spark.createDataFrame([row], ALERTS)


def guarded_report(
    spark: SparkSession,
    bronze: Callable[[], DataFrame],
    silver: Callable[[], DataFrame],
    gold: Callable[[], DataFrame],
    runs: Callable[[], DataFrame],
    as_of,
    name: str | None = None,
    limits: Thresholds = DEFAULTS,
    batch: DataFrame | None = None,
) -> DataFrame:
    """All alerts, each check guarded by itself: one that fails is an ERROR beside the alerts of the others.

    Tables come as functions, so that a missing one fails only its own checks. ``batch`` is the rows the newest
    gold total was computed from; without it the reconciliation is left out.
    """

    def layer(make: Callable[[DataFrame], Layer], rows: Callable[[], DataFrame], fresh: bool) -> DataFrame:
        one = make(rows())
        wanted = [*(_freshness(one, limits) if fresh else []), *_row_count(one, limits), *_nulls(one, limits)]
        return _alerts(_wide([one], {"last_record", "row_count", "nulls"}).withColumn("as_of", _moment(as_of)), wanted)

    checks: dict[str, Callable[[], DataFrame]] = {
        "bronze": lambda: layer(bronze_layer, bronze, True),
        "silver": lambda: layer(silver_layer, silver, True),
        "gold": lambda: layer(gold_layer, gold, False),
        "layer_retention": lambda: layer_retention(bronze_layer(bronze()), silver_layer(silver()), limits),
        "run_duration": lambda: run_duration_check(runs(), as_of, name, limits),
    }
    if batch is not None:
        checks["cap_reconciliation"] = lambda: cap_reconciliation(batch, gold(), limits)
    return reduce(DataFrame.unionByName, [guarded(spark, check, build) for check, build in checks.items()])
