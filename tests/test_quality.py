import pytest

from marketstrata.operators.quality import (
    Rule,
    broken,
    require_valid,
    split_rows,
    validation_report,
    validation_summary,
)

SHAPE = (
    "id string, symbol string, current_price double, price_change_24h string, last_updated string,"
    " ath_date string, market_cap_rank double"
)
OK_TIME = "2023-05-01T12:00:00.000Z"
ROWS = [
    ("a", "A", 1.0, "1.5", OK_TIME, None, 1.0),
    ("b", None, -1.0, "n/a", OK_TIME, "never", 2.5),
    (None, "C", 0.0, None, None, OK_TIME, -3.0),
    ("d", "D", None, "-2", "soon", OK_TIME, None),
]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, SHAPE)


def test_report_counts_each_rule_once(rows):
    found = {r["column"]: r["invalid_records"] for r in validation_report(rows).collect()}
    assert found == {
        "id": 1,
        "symbol": 1,
        "current_price": 1,
        "price_change_24h": 1,
        "last_updated": 2,
        "ath_date": 1,
        "market_cap_rank": 2,
    }


def test_summary_counts_error_rows_and_warning_rules(rows):
    row = validation_summary(validation_report(rows)).first()
    assert (row["total_records"], row["errors"], row["warnings"], row["passed"]) == (4, 4, 4, False)
    with pytest.raises(ValueError, match="4 errors"):
        require_valid(validation_summary(validation_report(rows)))


def test_warnings_alone_pass(rows):
    summary = validation_summary(validation_report(rows.filter("id = 'a'")))
    require_valid(summary)
    assert summary.first()["passed"]


def test_empty_input_passes(rows):
    row = validation_summary(validation_report(rows.filter("false"))).first()
    assert (row["total_records"], row["errors"], row["passed"]) == (0, 0, True)


def test_split_is_a_partition_of_the_input(rows):
    good, bad = split_rows(rows)
    assert [r["id"] for r in good.collect()] == ["a"]
    names = {r["id"]: r["broken_rules"] for r in bad.collect()}
    assert names["b"] == ["symbol:is_not_null"]
    assert names[None] == ["id:is_not_null", "last_updated:is_valid_timestamp"]
    assert names["d"] == ["last_updated:is_valid_timestamp"]


def test_split_on_any_severity(rows):
    _, bad = split_rows(rows, severity="any")
    names = {r["id"]: r["broken_rules"] for r in bad.collect()}
    assert "current_price:is_positive_or_null" in names["b"]


def test_unknown_rule():
    with pytest.raises(ValueError):
        broken(Rule("id", "is_lucky", "error"))
