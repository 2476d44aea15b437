from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from panelprep.operators import calendar, drift


def d(day, month=1):
    return dt.date(2024, month, day)


@pytest.fixture(scope="module")
def cal(spark):
    """Weekdays from January to April 2024, without Wednesday 31 January."""
    days = [d(1) + dt.timedelta(days=i) for i in range(121)]
    return spark.createDataFrame([(x,) for x in days if x.weekday() < 5 and x != d(31)], "trade_date date")


def test_month_ends(cal, rows):
    assert rows(calendar.month_end_dates(cal), "trade_date") == [(d(30),), (d(29, 2),), (d(29, 3),), (d(30, 4),)]


def test_keep_month_ends(spark, cal, rows):
    df = spark.createDataFrame([("20240130", 1), ("20240131", 2), ("20240229", 3), ("bad", 4)], "t string, v int")
    assert rows(calendar.keep_month_ends(df, "t", cal), "v") == [(1,), (3,)]


@pytest.mark.parametrize("days, shape", [
    ([d(30), d(29, 2), d(29, 3)], "monthly_snapshot"), ([d(x) for x in range(1, 31)], "daily"),
    ([d(2), d(30), d(15, 2), d(29, 2)], "mixed"),
])
def test_snapshot_shape(spark, cal, days, shape):
    row = calendar.snapshot_shape(spark.createDataFrame([(x,) for x in days], "t date"), "t", cal).first()
    assert row["shape"] == shape and row["n_dates"] == len(days)


def test_previous_anchor(spark, rows):
    df = spark.createDataFrame([("i", d(1), "a", 1), ("i", d(5), "a", 2), ("i", d(5), "b", 3), ("i", d(20), "a", 4), ("j", d(9), "a", 5),
                                ("i", d(28), "a", 6)], "index_code string, trade_date date, c string, w int")
    assert rows(calendar.with_previous_anchor(df, d(10), d(25)), "w") == [(2,), (3,), (4,), (5,)]


def test_offset(spark, cal):
    ahead = {r[0]: r[1] for r in calendar.trading_offset(cal, 1).collect()}
    back = {r[0]: r[1] for r in calendar.trading_offset(cal, -2).collect()}
    assert ahead[d(30)] == d(1, 2) and ahead[d(30, 4)] is None
    assert back[d(1, 2)] == d(29) and back[d(2)] is None


def test_assign_anchor(spark, cal, rows):
    anchors = spark.createDataFrame([("i", d(30)), ("i", d(30)), ("i", d(3, 2)), ("j", d(6, 2))], "index_code string, trade_date date")
    days = spark.createDataFrame([("i", x) for x in (d(29), d(30), d(1, 2), d(2, 2), d(5, 2), d(30, 4))] + [("j", d(6, 2)), ("k", d(1, 2))],
                                 "index_code string, trade_date date")
    got = {(r[0], r[1]): (r[2], r[3]) for r in calendar.assign_anchor(days, anchors, cal).select(
        "index_code", "trade_date", "anchor_date", "days_since_anchor").collect()}
    # The second anchor of i is a Saturday: it's in force from Monday, one trading day on.
    assert got[("i", d(29))] == (None, None) and got[("i", d(30))] == (d(30), 0)
    assert got[("i", d(1, 2))] == (d(30), 1) and got[("i", d(2, 2))] == (d(30), 2)
    assert got[("i", d(5, 2))] == (d(3, 2), 1) and got[("j", d(6, 2))] == (d(6, 2), 0) and got[("k", d(1, 2))] == (None, None)
    assert got[("i", d(30, 4))][0] == d(3, 2)


def test_returns(spark, rows):
    df = spark.createDataFrame([("a", d(1), 10.0, None), ("a", d(2), 12.0, 11.0), ("a", d(5), 0.0, None), ("a", d(6), 3.0, None)],
                               "con_code string, trade_date date, close double, adj double")
    out = {r["trade_date"]: r["ret"] for r in drift.return_from_price(df, adj_price="adj").collect()}
    assert out[d(1)] is None and out[d(2)] == pytest.approx(0.2) and out[d(5)] == -1.0 and out[d(6)] is None


def test_returns_stay_within_one_price_series(spark):
    df = spark.createDataFrame([("a", d(1), 100.0, 50.0), ("a", d(2), 101.0, None), ("a", d(3), 102.0, 51.0), ("a", d(4), 103.0, 52.02)],
                               "con_code string, trade_date date, close double, adj double")
    out = {r["trade_date"]: r["ret"] for r in drift.return_from_price(df, adj_price="adj").collect()}
    assert [out[d(i)] for i in (2, 3, 4)] == [pytest.approx(0.01), pytest.approx(102 / 101 - 1), pytest.approx(0.02)]


ANCHORS = [("i", "a", d(2), 60.0), ("i", "b", d(2), 30.0), ("i", "q", d(2), 10.0), ("i", "a", d(8), 50.0), ("i", "c", d(8), 50.0),
           ("j", "a", d(4), 1.0)]
RETURNS = [("a", d(2), 9.0), ("a", d(3), 0.1), ("a", d(5), 0.5), ("b", d(3), -1.0), ("b", d(4), 0.3), ("c", d(9), -0.5), ("a", d(8), 0.2),
           ("a", d(9), None)]
FLOWS = [("a", d(3), 100.0), ("b", d(3), 10.0), ("a", d(4), 8.0), ("a", d(9), 7.0), ("x", d(3), 1e9)]


@pytest.fixture(scope="module")
def week(spark):
    return spark.createDataFrame([(d(x),) for x in (1, 2, 3, 4, 5, 8, 9, 10)], "trade_date date")


@pytest.fixture(scope="module")
def inputs(spark):
    return (spark.createDataFrame(ANCHORS, "index_code string, con_code string, trade_date date, weight double"),
            spark.createDataFrame(RETURNS, "con_code string, trade_date date, ret double"),
            spark.createDataFrame(FLOWS, "con_code string, trade_date date, flow double"))


def brute_drift(through_next=False):
    """Plain loops over the definition."""
    days = [d(x) for x in (1, 2, 3, 4, 5, 8, 9, 10)]
    rets = {(c, t): r for c, t, r in RETURNS}
    out = {}
    for i, c, tau, w in ANCHORS:
        later = sorted({t for j, _, t, _ in ANCHORS if j == i and t > tau})
        stop = later[0] if later else None
        raw = w
        for t in days:
            if t < tau or (stop and (t > stop or (t == stop and not through_next))):
                continue
            if t > tau:
                raw *= 1 + (rets.get((c, t)) or 0.0)
            out[(i, c, tau, t)] = raw
    return out


@pytest.mark.parametrize("through_next", [False, True])
def test_drift_against_loops(inputs, week, through_next):
    anchors, returns, _ = inputs
    out = drift.drift_weights(anchors, returns, week, through_next=through_next).collect()
    got = {(r["index_code"], r["con_code"], r["anchor_date"], r["trade_date"]): r["raw_weight"] for r in out}
    want = brute_drift(through_next)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    assert {r["con_code"] for r in out if not r["has_quotes"]} == {"q"}


def test_zero_returns_keep_anchor_weights(spark, inputs, week):
    anchors, returns, _ = inputs
    out = drift.drift_weights(anchors, returns.withColumn("ret", F.lit(0.0)), week)
    assert out.where("raw_weight <> anchor_weight").count() == 0


def test_normalised_and_lost_weights(inputs, week, rows):
    anchors, returns, _ = inputs
    drifted = drift.drift_weights(anchors, returns, week)
    live = drift.drop_unquoted(drifted)
    sums = drift.normalize_weights(live).groupBy("index_code", "trade_date").agg(F.sum("weight").alias("s")).collect()
    assert sums and all(r["s"] == pytest.approx(1.0) for r in sums)
    loss = {(r["index_code"], r["trade_date"]): (r["lost_weight"], r["lost_share"], r["lost_constituents"])
            for r in drift.coverage_loss(drifted).collect()}
    assert loss[("i", d(2))] == (0.0, 0.0, 0) and loss[("i", d(3))] == (10.0, 0.1, 1)


@pytest.mark.parametrize("carried", [False, True])
def test_index_flow(inputs, week, carried):
    anchors, returns, flow = inputs
    carry = drift.next_day_flow(flow, week) if carried else None
    live = drift.drop_unquoted(drift.drift_weights(
        anchors.withColumn("anchor_weight_source", F.lit("official")), returns, week, carry=carry))
    out = drift.index_flow(live, None if carried else flow, week, start="2024-01-02", end="20240109")
    got = {(r["index_code"], r["trade_date"]): r.asDict() for r in out.collect()}
    assert len(got) == 6 + 4  # an index starts with its first anchor
    first = got[("i", d(2))]
    assert first["weight_mode"] == "missing" and first["index_flow"] is None and first["constituent_count"] == 0
    third = got[("i", d(3))]  # official weights of the 2nd: 60, 30, 10
    assert third["index_flow"] == pytest.approx((60 * 100 + 30 * 10) / 100) and third["weight_mode"] == "official"
    assert third["moneyflow_weight_coverage_ratio"] == pytest.approx(0.9) and third["anchor_weight_source"] == "official"
    fourth = got[("i", d(4))]  # drifted: a 66, b 0, q unquoted
    assert fourth["index_flow"] == pytest.approx(8.0) and fourth["weight_mode"] == "drifted"
    assert (fourth["constituent_count"], fourth["weighted_constituent_count"], fourth["days_since_anchor"]) == (3, 2, 1)
    eighth = got[("i", d(8))]  # an anchor day still uses the weights of the period before
    assert eighth["anchor_weight_date"] == d(2) and eighth["index_flow"] is None
    assert got[("i", d(9))]["weight_mode"] == "official" and got[("j", d(4))]["weight_mode"] == "missing"


def test_drift_error(spark, rows):
    est = [("i", d(8), "a", 0.5), ("i", d(8), "b", 0.3), ("i", d(8), "c", 0.2), ("i", d(9), "a", 1.0)]
    off = [("i", d(8), "a", 0.4), ("i", d(8), "c", 0.4), ("i", d(8), "x", 0.2), ("i", d(1), "a", 1.0)]
    cols = "index_code string, trade_date date, con_code string, weight double"
    out = drift.drift_error(spark.createDataFrame(est, cols), spark.createDataFrame(off, cols), 2).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["trade_date"], r["union_count"], r["top_overlap"]) == (d(8), 4, 0.5)
    assert r["mae_union"] == pytest.approx((0.1 + 0.3 + 0.2 + 0.2) / 4) and r["max_abs_error"] == pytest.approx(0.3)
    assert r["coverage"] == pytest.approx(0.8)


def test_point_in_time_against_loops(spark):
    from panelprep.operators import joins
    rng = random.Random(5)
    facts = [(rng.choice("abc"), d(1) + dt.timedelta(days=rng.randrange(90)), d(1) - dt.timedelta(days=30 * rng.randrange(5)), i)
             for i in range(200)]
    asked = [(k, d(1) + dt.timedelta(days=x)) for k in "abcz" for x in range(-2, 95)]
    out = joins.point_in_time(
        spark.createDataFrame(asked, "k string, trade_date date"),
        spark.createDataFrame(facts, "k string, ann_dt date, report_period date, v int"), "k", bucket_days=8).collect()
    assert len(out) == len(asked)
    for r in out:
        known = [(p, a, v) for k, a, p, v in facts if k == r["k"] and a <= r["trade_date"]]
        assert (r["report_period"], r["ann_dt"], r["v"]) == (max(known) if known else (None, None, None))
