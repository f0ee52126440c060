"""Properties that must hold for any input."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketstrata.operators import leaders
from marketstrata.operators.quality import split_rows
from marketstrata.operators.shares import market_share
from marketstrata.operators.tables import new_versions

FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

caps = st.one_of(st.none(), st.integers(0, 50).map(float))


@FEW
@given(values=st.lists(caps, min_size=1, max_size=40))
def test_shares_add_up(spark, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "coin_id int, market_cap_usd double")
    total = market_share(rows).agg(F.sum("market_dominance")).first()[0]
    known = sum(v for v in values if v is not None)
    assert total is None if known == 0 else abs(total - 100.0) < 1e-6


@FEW
@given(values=st.lists(caps, min_size=1, max_size=60), k=st.integers(1, 12))
def test_rank_equals_brute_force(spark, values, k):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "coin_id int, market_cap_usd double")
    key = [-1.0 if v is None else v for v in values]
    expected = {(i, 1 + sum(o > v for o in key)) for i, v in enumerate(key)}
    expected = {(i, r) for i, r in expected if r <= k}
    found = {(r["coin_id"], r["rank"]) for r in leaders.top_by_market_cap(rows, k).collect()}
    assert found == expected


keys = st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(1, 4)))


@FEW
@given(stored=st.lists(keys, max_size=8), updates=st.lists(keys, max_size=12))
def test_new_versions_equal_brute_force(spark, stored, updates):
    shape = "coin_id string, last_updated timestamp"

    def frame(rows):
        return spark.createDataFrame([(c, d and dt.datetime(2024, 1, d)) for c, d in rows], shape)

    found = new_versions(frame(updates), frame(stored), ["coin_id", "last_updated"]).collect()
    seen = [(r["coin_id"], r["last_updated"] and r["last_updated"].day) for r in found]
    whole = {u for u in updates if None not in u} - set(stored)
    assert sorted(u for u in seen if None not in u) == sorted(whole)
    assert len([u for u in seen if None in u]) == len([u for u in updates if None in u])


texts = st.one_of(st.none(), st.sampled_from(["2024-01-01T00:00:00Z", "soon", "", "7"]))


@FEW
@given(rows=st.lists(st.tuples(texts, texts), max_size=20))
def test_split_keeps_every_row(spark, rows):
    frame = spark.createDataFrame(rows, "id string, last_updated string")
    good, bad = split_rows(frame)
    assert good.unionByName(bad.drop("broken_rules")).exceptAll(frame).count() == 0
    assert good.count() + bad.count() == len(rows)
