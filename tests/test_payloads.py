import datetime as dt
import json
import tempfile

import pytest
from pyspark.sql import functions as F

from marketstrata.contracts import PAYLOAD, SPARKLINE
from marketstrata.sources import payloads
from tests.conftest import UTC

COINS = [
    {"id": "alpha", "symbol": "alp", "name": "Alpha", "current_price": 12.5, "market_cap": 7400,
     "market_cap_rank": 1, "roi": None, "unknown": 1},
    {"id": "beta", "symbol": "bet", "name": "Beta", "current_price": 4, "market_cap": 2600,
     "market_cap_rank": 2, "roi": {"times": 1.75}, "unknown": 2},
]


@pytest.fixture
def landing():
    folder = tempfile.mkdtemp(prefix="landing-")
    with open(f"{folder}/list.json", "w") as out:
        json.dump(COINS, out, indent=1)
    with open(f"{folder}/single.json", "w") as out:
        json.dump({**COINS[0], "id": "solo"}, out)
    return folder


def test_scan_lists_and_single_objects(spark, landing):
    found = {r["id"]: r for r in payloads.scan_market_payload(spark, landing).collect()}
    assert set(found) == {"alpha", "beta", "solo"}
    assert (found["beta"]["current_price"], found["beta"]["market_cap"]) == (4.0, 2600.0)
    assert json.loads(found["beta"]["roi"]) == {"times": 1.75}
    assert found["alpha"]["roi"] is None


def test_unreadable_documents_are_kept_aside(spark, landing):
    with open(f"{landing}/bad.json", "w") as out:
        out.write("<html>")
    found = payloads.scan_market_payload(spark, landing, keep_rejected=True).cache()
    assert found.filter(F.col(payloads.REJECTED).isNotNull()).count() == 1
    assert found.filter("id is not null").count() == 3


def test_decode_text_column(spark):
    texts = spark.createDataFrame([(json.dumps(COINS),), (json.dumps(COINS[0]),)], "body string")
    assert payloads.decode_market_payload(texts, "body", PAYLOAD).count() == 3
    bad = spark.createDataFrame([("<html>",), (None,), ('[{"id": "a"',)], "body string")
    both = texts.unionByName(bad)
    assert payloads.decode_market_payload(both, "body").filter("symbol is not null").count() == 3
    assert payloads.rejected_payloads(both, "body").count() == 3


def test_empty_payload_raises(spark, coins):
    with pytest.raises(ValueError):
        payloads.require_rows(coins.filter("false"))
    assert payloads.require_rows(coins) is coins


def test_pages_are_disjoint_and_complete(spark):
    rows = spark.range(25).selectExpr(
        "concat('c', lpad(id, 2, '0')) as id", "cast(id % 4 as double) as market_cap", "1.0 as total_volume", "'eur' as vs_currency"
    )
    pages = [[r["id"] for r in payloads.market_page(rows, per_page=10, page=p).collect()] for p in (1, 2, 3)]
    assert [len(p) for p in pages] == [10, 10, 5]
    assert len({i for p in pages for i in p}) == 25
    assert pages[0][0] == "c03"
    assert [r["id"] for r in payloads.market_page(rows, ids=["c07", "c01"], order="id_asc").collect()] == ["c01", "c07"]
    assert payloads.market_page(rows, vs_currency="usd").count() == 0
    assert payloads.market_page(rows, category="defi").count() == 25
    for bad in ({"order": "luck_desc"}, {"order": "id"}, {"page": 0}):
        with pytest.raises(ValueError):
            payloads.market_page(rows, **bad)


def test_page_keeps_requested_periods(spark):
    page = payloads.market_page(spark.createDataFrame([], PAYLOAD), price_change_percentage="7d")
    assert "price_change_percentage_7d_in_currency" in page.columns
    assert "price_change_percentage_24h_in_currency" not in page.columns
    assert "price_change_percentage_24h" in page.columns


def test_narrow_snapshot(spark):
    rows = spark.createDataFrame([("a", "abc", None, 1.0, None)], "id string, symbol string, name string, current_price double, last_updated string")
    now = dt.datetime(2024, 1, 1, tzinfo=UTC)
    kept = payloads.project_narrow_snapshot(rows, now, "r").first()
    assert (kept["symbol"], kept["name"], kept["last_updated"], kept["pipeline_run_id"]) == ("abc", None, None, "r")
    filled = payloads.project_narrow_snapshot(rows, now, "r", fill_text=True).first()
    assert (filled["symbol"], filled["name"], filled["last_updated"]) == ("ABC", "", "")
    assert len(filled) == 10


DAY = 86_400_000
START = 1706745600000


def _charts(spark):
    def chart(shift=0):
        times = [START, START + DAY, START + DAY + 3_600_000]
        return json.dumps(
            {
                "prices": [[t, 640 + i] for i, t in enumerate(times)],
                "market_caps": [[t + shift, 81e6 + i] for i, t in enumerate(times)],
                "total_volumes": [[t, 5e6 + i] for i, t in enumerate(times)],
            }
        )

    rows = [("alpha", chart()), ("shifted", chart(1)), ("broken", "{"), ("short", '{"prices": [[1, 2]]}')]
    return payloads.decode_chart(spark.createDataFrame(rows, "coin_id string, body string"), "body")


def test_chart_points_and_rejects(spark):
    charts = _charts(spark)
    points = payloads.explode_market_chart(charts).orderBy("ts").collect()
    assert [(p["coin_id"], p["price"], p["market_cap"]) for p in points] == [
        ("alpha", 640.0 + i, 81e6 + i) for i in range(3)
    ]
    assert points[0]["ts"] == dt.datetime(2024, 2, 1)
    good, rejected = payloads.split_charts(charts)
    assert good.count() == 1
    assert sorted(r["coin_id"] for r in rejected.collect()) == ["broken", "shifted", "short"]


def test_malformed_points_are_rejected_or_null(spark):
    def chart(*points):
        return json.dumps({name: points for name in ("prices", "market_caps", "total_volumes")})

    rows = [("no_value", chart([START])), ("no_time", chart([])), ("null_time", chart([None, 1])), ("far", chart([1e300, 1]))]
    charts = payloads.decode_chart(spark.createDataFrame(rows, "coin_id string, body string"), "body")
    assert [(p["coin_id"], p["price"]) for p in payloads.explode_market_chart(charts).collect()] == [("no_value", None)]
    _, rejected = payloads.split_charts(charts)
    assert sorted(r["coin_id"] for r in rejected.collect()) == ["far", "no_time", "null_time"]


def test_chart_days_and_daily(spark):
    charts = _charts(spark)
    daily = payloads.explode_market_chart(charts, interval="daily").orderBy("ts").collect()
    assert [(p["ts"].day, p["price"]) for p in daily] == [(1, 640.0), (2, 642.0)]
    as_of = dt.datetime(2024, 2, 2, 12, tzinfo=UTC)
    assert payloads.explode_market_chart(charts, days=1, as_of=as_of).count() == 2
    assert payloads.explode_market_chart(charts, days="max").count() == 3
    with pytest.raises(ValueError):
        payloads.explode_market_chart(charts, days=1)
    with pytest.raises(ValueError):
        payloads.explode_market_chart(charts, interval="hourly")


def test_sparkline(spark):
    body = '{"id": "alpha", "symbol": "alp", "sparkline_in_7d": {"price": [7, 9, 8.5]}}'
    rows = payloads.decode_sparkline(spark.createDataFrame([(body,)], "body string"), "body")
    assert rows.columns == SPARKLINE.names
    found = payloads.explode_sparkline(rows).collect()
    assert [(r["position"], r["price"]) for r in found] == [(0, 7.0), (1, 9.0), (2, 8.5)]
