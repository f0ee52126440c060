"""Exact quantiles in two scans: a sketch bounds each of them, and one counting pass reads inside the bounds."""

from __future__ import annotations

import math
import sys
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstrata.functions import quoted
from marketstrata.session import stored

SLOTS = 4096

#: Size of the sketches, and their rank error (one in a hundred sketches is further off, as the sketch's authors state).
SKETCH_K = 4096
RANK_ERROR = 2.296 / SKETCH_K**0.9723
#: Bounds are taken three errors to each side; ranks that still lie outside are found by counting all values.
MARGIN = 3 * RANK_ERROR
MOST = sys.float_info.max


def column_value(name: str) -> str:
    """The column as a double, NaN as NULL."""
    return f"nanvl(cast({quoted(name)} as double), cast(null as double))"


def sketch_figures(value: str, tag: str, probabilities: Sequence[float]) -> dict[str, str]:
    """Aggregates that a first scan needs: counts of numbers and infinities, and the bounds of each quantile.

    ``n``, ``low``, ``high`` (infinities) and, for the k-th probability, ``below{k}``, ``near{k}`` and ``above{k}``.
    """
    sketch = f"kll_sketch_agg_double({value}, {SKETCH_K})"
    figures = {
        f"n{tag}": f"count({value})",
        f"low{tag}": f"count_if({value} = double('-Infinity'))",
        f"high{tag}": f"count_if({value} = double('Infinity'))",
    }
    for k, p in enumerate(probabilities):
        for name, rank in (("below", max(0.0, p - MARGIN)), ("near", p), ("above", min(1.0, p + MARGIN))):
            figures[f"{name}{k}{tag}"] = f"case when count({value}) > 0 then kll_sketch_get_quantile_double({sketch}, {rank!r}d) end"
    return figures


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], slots: int = SLOTS
) -> dict[str, list[float | None]]:
    """Smallest value of each column with at least ``p`` of the values at or below it; NULL and NaN are left out.

    Infinities are values like others. Two scans: the first sketches every column; the second counts the values below
    each quantile's bounds and gathers the distinct values inside them with their counts, combined on the map side, so
    neither size, skew nor copies of a value matter. Those are stored and narrowed by counting in ``slots`` equal
    parts, which reads a few thousandths of the data. Only ranges come to the driver.
    """
    figures = [F.expr(text).alias(name) for i, c in enumerate(columns) for name, text in sketch_figures(column_value(c), f"_{i}", probabilities).items()]
    first = df.agg(*figures).first()
    found = refine_quantiles(df, columns, probabilities, first.asDict(), slots)
    return {c: [found[i, k] for k in range(len(probabilities))] for i, c in enumerate(columns)}


def refine_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], first: Mapping, slots: int = SLOTS
) -> dict[tuple[int, int], float | None]:
    """The second scan: exact quantiles from the figures that ``sketch_figures`` gave, by column and probability."""
    answers: dict[tuple[int, int], float | None] = {}
    wanted = []
    for i in range(len(columns)):
        n, low, high = (first[f"{name}_{i}"] for name in ("n", "low", "high"))
        for k, p in enumerate(probabilities):
            rank = max(1, math.ceil(p * n)) if n else 0
            if not n:
                answers[i, k] = None
            elif rank <= low:
                answers[i, k] = -math.inf
            elif rank > n - high:
                answers[i, k] = math.inf
            else:
                # Among the finite values, so the bounds are made finite.
                bounds = (max(-MOST, min(MOST, first[f"{side}{k}_{i}"])) for side in ("below", "above"))
                wanted.append((i, k, *bounds, rank - low))
    if not wanted:
        return answers
    values = df.selectExpr(*[f"{column_value(c)} as v{i}" for i, c in enumerate(columns)])
    inside = stored(_inside(values, wanted), "quantile-bounds")
    below = {r["range"]: r["n"] for r in inside.filter("value is null").groupBy("range").agg(F.sum("n").alias("n")).collect()}
    held = {r["range"]: r for r in inside.filter("value is not null").groupBy("range").agg(F.sum("n").alias("n"), F.min("value").alias("a"), F.max("value").alias("b")).collect()}
    open_, missed = [], []
    for w, (i, k, low, high, rank) in enumerate(wanted):
        left = rank - below.get(w, 0)
        if w not in held or not 1 <= left <= held[w]["n"]:
            missed.append((i, k))
        else:
            open_.append((w, held[w]["a"], held[w]["b"], left))
    while open_:
        for w, low, *_ in open_:
            answers[wanted[w][0], wanted[w][1]] = low
        open_ = [o for o in open_ if o[1] < o[2]]
        open_ = _narrow(inside, open_, slots) if open_ else []
    for i, k in missed:
        # A sketch was further off than its margin. Bounds that hold all finite numbers cannot miss.
        every = {"below0_0": -MOST, "above0_0": MOST, **{f"{name}_0": first[f"{name}_{i}"] for name in ("n", "low", "high")}}
        answers[i, k] = refine_quantiles(df, [columns[i]], [probabilities[k]], every, slots)[0, 0]
    return answers


def _inside(values: DataFrame, wanted: Sequence[tuple]) -> DataFrame:
    """``range, value, n``: the distinct finite values inside each range with their counts; NULL stands for those below it."""
    parts = ", ".join(
        f"case when abs(v{i}) < double('Infinity') and v{i} <= {high!r}d then "
        f"named_struct('range', {w}, 'value', case when v{i} >= {low!r}d then v{i} end) end"
        for w, (i, _, low, high, _) in enumerate(wanted)
    )
    return values.selectExpr(f"inline(array_compact(array({parts})))").groupBy("range", "value").agg(F.count("*").alias("n"))


def _narrow(inside: DataFrame, open_: Sequence[tuple], slots: int) -> list[tuple]:
    """One counting pass over the gathered values: each wanted rank within the part of its range that holds it."""
    lows, highs = ({w: o[j] for w, *o in open_} for j in (0, 1))
    between = " or ".join(f"range = {w} and value between {lows[w]!r}d and {highs[w]!r}d" for w in lows)
    # Halves are subtracted, so that the width of a range of any finite numbers stays finite.
    slot = " ".join(
        f"when {w} then floor((value / 2d - {lows[w] / 2!r}d) / {max(highs[w] / 2 - lows[w] / 2, 5e-324)!r}d * {slots}d)" for w in lows
    )
    counted = (
        inside.filter(between)
        .selectExpr("range", f"case range {slot} end as slot", "value", "n")
        .groupBy("range", "slot")
        .agg(F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    )
    ranks = " ".join(f"when {w} then {rank}" for w, _, _, rank in open_)
    hits = (
        counted.selectExpr("*", "sum(n) over (partition by range order by slot) - n as before", f"case range {ranks} end as wanted")
        .filter("before < wanted and before + n >= wanted")
        .collect()
    )
    return [(h["range"], h["low"], h["high"], h["wanted"] - h["before"]) for h in hits]
