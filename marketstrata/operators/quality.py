"""Data-quality rules, compiled to one aggregate for the report and one filter for quarantine."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketstrata.contracts import PAYLOAD
from marketstrata.functions import iso_instant, number, quoted, text_literal


@dataclass(frozen=True)
class Rule:
    column: str
    rule: str
    severity: str


# Which rule guards which bronze column, and how severe a breach is.
RULES = (
    Rule("id", "is_not_null", "error"),
    Rule("symbol", "is_not_null", "error"),
    Rule("name", "is_not_null", "error"),
    Rule("current_price", "is_positive_or_null", "warning"),
    Rule("market_cap", "is_positive_or_null", "warning"),
    Rule("total_volume", "is_positive_or_null", "warning"),
    Rule("high_24h", "is_positive_or_null", "warning"),
    Rule("low_24h", "is_positive_or_null", "warning"),
    Rule("price_change_24h", "is_numeric_or_null", "warning"),
    Rule("price_change_percentage_24h", "is_numeric_or_null", "warning"),
    Rule("last_updated", "is_valid_timestamp", "error"),
    Rule("ath_date", "is_valid_timestamp_or_null", "warning"),
    Rule("atl_date", "is_valid_timestamp_or_null", "warning"),
    Rule("market_cap_rank", "is_positive_integer_or_null", "warning"),
)

# Columns of the payload by the number they become.
_DOUBLES = [f.name for f in PAYLOAD.fields if isinstance(f.dataType, T.DoubleType)]
_INTEGERS = [f.name for f in PAYLOAD.fields if isinstance(f.dataType, T.IntegerType)]
_AMOUNTS = ("current_price", "market_cap", "total_volume")

#: What typing or summing would lose in silence, judged on the values as they came: text in a number, a fraction or
#: an overflow in an integer, an infinity, an amount beyond the decimals of the sums, a change beyond those of gold.
FIT_RULES = (
    *(Rule(c, "fits_double_or_null", "warning") for c in _DOUBLES),
    *(Rule(c, "fits_integer_or_null", "warning") for c in _INTEGERS),
    *(Rule(c, "is_finite_or_null", "error") for c in (*_AMOUNTS, "price_change_percentage_24h")),
    *(Rule(c, "fits_sums_or_null", "error") for c in _AMOUNTS),
    Rule("price_change_percentage_24h", "fits_gold_or_null", "warning"),
)

#: The rules of a run, over the payload before it is typed.
RUN_RULES = RULES + FIT_RULES

# The first magnitude that the decimals of sums and of gold percentages do not hold.
_SUMS_LIMIT, _GOLD_LIMIT = "1e22d", "999999.99995d"


def broken(rule: Rule) -> str:
    """SQL condition that is true where a row breaks the rule, and never NULL."""
    value = quoted(rule.column)
    as_number, as_instant = number(value), iso_instant(f"cast({value} as string)")
    infinite = "double('Infinity')"
    breaches = {
        "is_not_null": f"{value} is null",
        "is_positive_or_null": f"{as_number} < 0 or isnan({as_number})",
        "is_numeric_or_null": f"{value} is not null and {as_number} is null or isnan({as_number})",
        "is_valid_timestamp": f"{as_instant} is null",
        "is_valid_timestamp_or_null": f"{value} is not null and {as_instant} is null",
        "is_positive_integer_or_null": f"{as_number} < 0 or isnan({as_number}) or {as_number} <> floor({as_number})",
        "fits_double_or_null": f"{value} is not null and {as_number} is null",
        "fits_integer_or_null": f"{value} is not null and (try_cast({as_number} as int) is null or {as_number} <> try_cast({as_number} as int))",
        "is_finite_or_null": f"abs({as_number}) = {infinite}",
        "fits_sums_or_null": f"abs({as_number}) >= {_SUMS_LIMIT} and abs({as_number}) < {infinite}",
        "fits_gold_or_null": f"abs({as_number}) >= {_GOLD_LIMIT} and abs({as_number}) < {infinite}",
    }
    if rule.rule not in breaches:
        raise ValueError(f"unknown rule: {rule.rule}")
    return f"coalesce({breaches[rule.rule]}, false)"


def rule_name(rule: Rule) -> str:
    return f"{rule.column}:{rule.rule}"


def applicable(df: DataFrame, rules: tuple[Rule, ...] = RULES) -> list[Rule]:
    """Rules whose column exists; the others are skipped."""
    present = set(df.columns)
    return [rule for rule in rules if rule.column in present]


def validation_report(df: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per rule: ``column, rule, severity, total_records, invalid_records``.

    Every rule is a counter of the same aggregate, so the data is read once.
    """
    active = applicable(df, rules)
    return _report(df, {rule: broken(rule) for rule in active})


def flagged_report(flagged: DataFrame, rules: tuple[Rule, ...] = RUN_RULES) -> DataFrame:
    """The report of rows that carry the names of their broken rules, as ``flag_rows(..., severity="any")`` adds them.

    Rows flagged before they were typed keep faults that typing hides; this counts them in one pass over one column.
    """
    named = {rule: f"coalesce(array_contains(broken_rules, {text_literal(rule_name(rule))}), false)" for rule in rules}
    return _report(flagged, named)


def _report(df: DataFrame, conditions: dict[Rule, str]) -> DataFrame:
    active = list(conditions)
    counters = [F.expr(f"count_if({condition}) as _{i}") for i, condition in enumerate(conditions.values())]
    counted = df.agg(F.expr("count(1) as total_records"), *counters)
    lines = ", ".join(
        f"named_struct('column', {text_literal(rule.column)}, 'rule', {text_literal(rule.rule)}, "
        f"'severity', {text_literal(rule.severity)}, 'total_records', total_records, 'invalid_records', _{i})"
        for i, rule in enumerate(active)
    )
    return counted.selectExpr(f"inline(array({lines}))")


def validation_summary(report: DataFrame) -> DataFrame:
    """One row: ``errors`` adds up invalid rows of error rules, ``warnings`` counts broken warning rules."""
    return report.agg(
        F.expr("coalesce(max(total_records), 0) as total_records"),
        F.expr("coalesce(sum(case when severity = 'error' then invalid_records end), 0) as errors"),
        F.expr("count_if(severity <> 'error' and invalid_records > 0) as warnings"),
    ).withColumn("passed", F.expr("errors = 0"))


def require_valid(summary: DataFrame) -> None:
    """Raise ``ValueError`` when the summary counts any error; reads its single row."""
    row = summary.first()
    if row["errors"] > 0:
        raise ValueError(f"validation failed with {row['errors']} errors")


def flag_rows(df: DataFrame, rules: tuple[Rule, ...] = RULES, severity: str = "error") -> DataFrame:
    """Add ``broken_rules``: names ``column:rule`` of the rules of that severity a row breaks."""
    names = ", ".join(
        f"case when {broken(rule)} then {text_literal(rule_name(rule))} end"
        for rule in applicable(df, rules)
        if severity in (rule.severity, "any")
    )
    return df.withColumn("broken_rules", F.expr(f"cast(array_compact(array({names})) as array<string>)"))


def split_rows(
    df: DataFrame, rules: tuple[Rule, ...] = RULES, severity: str = "error"
) -> tuple[DataFrame, DataFrame]:
    """``(good, quarantined)``: together exactly the input; quarantined rows name their rules."""
    flagged = flag_rows(df, rules, severity)
    good = flagged.filter(F.size("broken_rules") == 0).drop("broken_rules")
    return good, flagged.filter(F.size("broken_rules") > 0)


def split_flagged(flagged: DataFrame, rules: tuple[Rule, ...] = RUN_RULES, severity: str = "error") -> tuple[DataFrame, DataFrame]:
    """``(good, quarantined)`` of rows that carry the names of their broken rules; only those of ``severity`` count."""
    names = F.array(*[F.lit(rule_name(rule)) for rule in rules if rule.severity == severity])
    bad = F.coalesce(F.arrays_overlap("broken_rules", names), F.lit(False))
    return flagged.filter(~bad).drop("broken_rules"), flagged.filter(bad)
