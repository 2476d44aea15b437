from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from panelprep.operators import codes, joins, quality


def d(day, month=1, year=2024):
    return dt.date(year, month, day)


def test_hierarchy_join(spark, rows):
    df = spark.createDataFrame([("s1", "760d010200"), ("s2", "b104020100"), ("s3", "zzzz000000")], "code string, ind string")
    dictionary = spark.createDataFrame([
        ("760d000000000000", 2, "transport"), ("760d010000000000", 3, "logistics"), ("760d010000000000", 2, "wrong level"),
        ("b104020000000000", 3, "utilities")], "code string, levelnum int, name string")
    out = joins.hierarchy_join(df, dictionary, 2, "ind")
    assert rows(out, "code", "hierarchy_code", "name", "hierarchy_level", "prefix_len") == [
        ("s1", "760d010000000000", "logistics", 2, 6), ("s2", "b104020000000000", "utilities", 2, 6),
        ("s3", "zzzz000000000000", None, 2, 6)]
    assert rows(joins.hierarchy_join(df, dictionary, 1, "ind"), "code", "name")[0] == ("s1", "transport")


MEMBERS = [("a", d(1), d(10), "x"), ("a", d(11), None, "y"), ("b", d(5), d(5), "z"), ("c", d(20), d(2), "bad")]
FACTS = [("a", d(10)), ("a", d(11)), ("a", d(1, 6, 2030)), ("b", d(5)), ("b", d(6)), ("c", d(20)), ("n", d(1)), ("a", None)]


@pytest.mark.parametrize("bucket_days", [1, 7, 64, 100000])
@pytest.mark.parametrize("inclusive, want", [
    (True, [("a", d(10), "x"), ("a", d(11), "y"), ("a", d(1, 6, 2030), "y"), ("b", d(5), "z")]),
    (False, [("a", d(11), "y"), ("a", d(1, 6, 2030), "y")]),
])
def test_interval_join(spark, rows, inclusive, want, bucket_days):
    facts = spark.createDataFrame(FACTS, "code string, trade_date date")
    members = spark.createDataFrame(MEMBERS, "code string, entry_dt date, remove_dt date, status string")
    args = (facts, members, "code", "trade_date", "entry_dt", "remove_dt")
    out = joins.interval_join(*args, end_inclusive=inclusive, bucket_days=bucket_days)
    assert rows(out, "code", "trade_date", "status") == sorted(want)
    left = joins.interval_join(*args, end_inclusive=inclusive, how="left", bucket_days=bucket_days)
    assert left.count() == len(FACTS)
    semi = joins.interval_join(*args, end_inclusive=inclusive, how="left_semi", bucket_days=bucket_days)
    anti = joins.interval_join(*args, end_inclusive=inclusive, how="left_anti", bucket_days=bucket_days)
    assert semi.count() + anti.count() == len(FACTS)


def test_inclusive_is_exclusive_with_the_next_day(spark, rows):
    facts = spark.createDataFrame(FACTS, "code string, trade_date date")
    members = spark.createDataFrame(MEMBERS, "code string, entry_dt date, remove_dt date, status string")
    shifted = members.withColumn("remove_dt", F.date_add("remove_dt", 1))
    a = joins.interval_join(facts, members, "code", "trade_date", "entry_dt", "remove_dt", end_inclusive=True)
    b = joins.interval_join(facts, shifted, "code", "trade_date", "entry_dt", "remove_dt", end_inclusive=False)
    assert rows(a, "code", "trade_date", "status") == rows(b, "code", "trade_date", "status")


def test_overlapping_memberships_all_match(spark):
    facts = spark.createDataFrame([("a", d(5))], "code string, trade_date date")
    members = spark.createDataFrame([("a", d(1), d(9)), ("a", d(5), None), ("a", d(5), d(5))], "code string, s date, e date")
    assert joins.interval_join(facts, members, "code", "trade_date", "s", "e", end_inclusive=True).count() == 3


def test_interval_semantics(spark):
    spans = [("a", d(1), d(4)), ("a", d(5), d(9)), ("a", d(9), d(12)), ("a", d(20), None), ("a", d(25), d(26)),
             ("b", d(1), d(1)), ("b", d(1), d(8)), ("b", d(3), d(4)), ("c", d(9), d(1))]
    got = joins.interval_semantics(spark.createDataFrame(spans, "k string, s date, e date"), "k", "s", "e").first()
    # a: next day, same day, gap, open then another; b: zero-length then same start, overlap.
    assert got.asDict() == {"transitions": 6, "next_day": 1, "same_day": 2, "gaps": 1, "overlaps": 2,
                            "inclusive_share": 1 / 6, "exclusive_share": 2 / 6}


def test_point_in_time(spark, rows):
    facts = spark.createDataFrame([
        ("a", d(10), d(31, 12, 2022), 1.0), ("a", d(20), d(31, 3, 2023), 2.0),
        ("a", d(25), d(31, 12, 2022), 9.0),  # a late restatement of the older period
        ("a", d(28), d(31, 3, 2023), 3.0), ("a", d(28), None, 4.0)],
        "code string, ann_dt date, report_period date, eps double")
    days = [d(9), d(10), d(19), d(20), d(26), d(28), d(1, 1, 2030)]
    queries = spark.createDataFrame([("a", x) for x in days] + [("z", d(10)), ("a", d(26))], "code string, trade_date date")
    out = joins.point_in_time(queries, facts, "code")
    assert rows(out.where("code = 'a'"), "trade_date", "eps") == [
        (days[0], None), (days[1], 1.0), (days[2], 1.0), (days[3], 2.0), (days[4], 2.0), (days[4], 2.0), (days[5], 3.0), (days[6], 3.0)]
    assert out.where("code = 'z'").first()["report_period"] is None


def test_universe_and_gap(spark, rows):
    master = spark.createDataFrame([
        ("a", d(1), None, "L"), ("b", d(1), d(10), "D"), ("c", d(10), d(20), None), ("e", d(5), d(5), "D"), ("f", None, None, "L")],
        "code string, listdate date, delistdate date, list_status string")
    dates = spark.createDataFrame([(x,) for x in (d(1), d(9), d(10), d(31), d(31, 12, 2023))], "trade_date date")
    for inclusive, tenth in ((False, ["a", "c"]), (True, ["a", "b", "c"])):
        out = joins.as_of_universe(master, dates, end_inclusive=inclusive)
        assert sorted(r["code"] for r in out.where(F.col("trade_date") == d(10)).collect()) == tenth
        gap = joins.survivorship_gap(master, dates, end_inclusive=inclusive)
        counts = dict(rows(out.groupBy("trade_date").count()))
        assert {r["trade_date"]: r["members"] for r in gap.collect() if r["members"]} == counts
        assert rows(gap.where(F.col("trade_date") == d(10)), "members", "dropped") == [(len(tenth), len(tenth) - 1)]


def test_status_and_suspensions(spark, rows):
    quotes = spark.createDataFrame([
        ("a", d(2), 0, "停牌"), ("a", d(3), 1, "交易"), ("b", d(2), 0, "停牌"), ("b", d(3), 0, "停牌"), ("b", d(4), 1, "DR"),
        ("c", d(1), 1, "交易"), ("c", d(3), 0, "交易"), ("c", d(4), None, None)],
        "code string, trade_date date, tradestatuscode int, tradestatus string")
    marked = joins.tradeable(quotes)
    assert marked.where("is_tradeable").count() == 3
    odd = joins.status_disagreement(quotes).where("NOT agrees")
    assert rows(odd, "tradestatuscode", "tradestatus", "n_rows") == [(0, "交易", 1)]
    stops = spark.createDataFrame([("a", d(2), None), ("b", d(2), None), ("c", d(2), None), ("a", d(1), d(2)), ("z", d(1), None)],
                                  "code string, suspend_date date, resump_date date")
    out = joins.suspension_check(stops, marked, "code")
    assert rows(out, "code", "suspend_date", "next_trade_date", "suspension_status") == [
        ("a", d(1), None, "resumed"), ("a", d(2), d(3), "one_day"), ("b", d(2), d(4), "resumed"),
        ("c", d(2), None, "open_ended"), ("z", d(1), None, "open_ended")]


def test_routing(spark, rows):
    members = spark.createDataFrame([(c, d(1)) for c in ("000001.SZ", "00700.HK", "0005.HK", "Au9999.SGE", "??")],
                                    "con_code string, trade_date date")
    a = spark.createDataFrame([("000001.SZ", d(1), 1.0), ("0700.HK", d(1), 9.0)], "con_code string, trade_date date, close double")
    hk = spark.createDataFrame([("0700.HK", d(1), 2.0)], "con_code string, trade_date date, close double")
    from panelprep.functions import hk_default
    out = joins.route_by_market(members, {"suffixed": a, "hk": hk}, normalize=hk_default)
    assert rows(out, "con_code", "route", "close") == [
        ("000001.SZ", "joined", 1.0), ("0005.HK", "no_quote", None), ("00700.HK", "joined", 2.0),
        ("??", "unroutable", None), ("Au9999.SGE", "unroutable", None)]


def test_first_available(spark, rows):
    one = spark.createDataFrame([("i", d(1), 1), (None, d(1), 5)], "k string, t date, w int")
    two = spark.createDataFrame([("i", d(1), 2), ("j", d(1), 3), ("j", d(1), 3), (None, d(1), 6)], "k string, t date, w int")
    three = spark.createDataFrame([("j", d(1), 4), ("m", d(1), 7)], "k string, t date, w int")
    out = joins.first_available([("one", one), ("two", two), ("three", three)], ["k", "t"])
    assert rows(out, "k", "w", "source") == [(None, 5, "one"), ("i", 1, "one"), ("j", 3, "two"), ("j", 3, "two"), ("m", 7, "three")]


def test_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "x int, y string")
    assert joins.assert_unique(df, ["x", "y"]).count() == 3
    repeated = joins.assert_unique(df, "x")  # no job yet
    with pytest.raises(Exception, match="is not unique"):
        repeated.collect()
    with pytest.raises(Exception, match="is not unique"):
        repeated.select("y").collect()  # not pruned away with the key


def test_observed_uniqueness(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (None, "c")], "x int, y string")
    rows, check = joins.observe_unique(df, "x")
    assert rows.columns == df.columns and rows.count() == 4 and check.excess_rows == 2
    with pytest.raises(ValueError, match="not unique"):
        check.verify()
    rows, check = joins.observe_unique(df.distinct(), ["x", "y"])
    assert len(rows.collect()) == 3
    check.verify()


def test_first_available_reads_each_source_twice(spark, tmp_path):
    sources = []
    for i in range(4):
        spark.range(50).selectExpr("id AS k", f"{i} AS v").write.parquet(str(tmp_path / str(i)))
        sources.append((str(i), spark.read.parquet(str(tmp_path / str(i)))))
    plan = joins.first_available(sources, "k")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet", plan)) <= 8


def test_facts_are_read_once(spark, tmp_path):
    spark.range(50).selectExpr("id % 5 AS k", "date_add(DATE '2020-01-01', CAST(id * 40 AS INT)) AS d").write.parquet(str(tmp_path / "f"))
    facts = spark.read.parquet(str(tmp_path / "f"))
    members = spark.createDataFrame([(0, d(1), None), (1, d(1), dt.date(9999, 12, 31)), (2, d(5), d(6))], "k long, s date, e date")
    out = joins.interval_join(facts, members, "k", "d", "s", "e", end_inclusive=True, how="left")
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    assert [r for r in out.collect() if (r["s"] is None) != (r["k"] > 1 or r["d"] < d(1))] == []
    # an open or distant end is repeated over some buckets only, however far it reaches
    again = joins.interval_join(members.select("k", F.lit(dt.date(2500, 1, 1)).alias("d")), members, "k", "d", "s", "e", end_inclusive=True)
    assert sorted(r["k"] for r in again.collect()) == [0, 1]


def test_hk_normalisation(spark, rows):
    df = spark.createDataFrame([("00700.HK",), ("2892.HK",), ("5.HK",), ("000300",), ("000001.SZ",)], "code string")
    seen = spark.createDataFrame([("0700.HK",), ("80700.HK",), ("02892.HK",), ("000001.SZ",)], "code string")
    assert dict(rows(codes.normalize_hk(df, seen, "code"))) == {
        "00700.HK": "0700.HK", "2892.HK": "02892.HK", "5.HK": "0005.HK", "000300": "000300", "000001.SZ": "000001.SZ"}


def test_align_columns(spark):
    df = spark.createDataFrame([(1, 2)], "Date int, CODE int")
    assert codes.align_columns(df, {"date": "trade_date"}).columns == ["trade_date", "CODE"]
    with pytest.raises(ValueError):
        codes.align_columns(df, {"date": "code"})


def test_family_profile(spark, rows):
    df = spark.createDataFrame([("000001.SZ",), ("000001.SZ",), ("0700.HK",)], "code string")
    assert rows(quality.family_profile(df, "code")) == [("hk", 1, 1, True), ("suffixed", 2, 1, True)]
    assert quality.family_profile(df.limit(0), "code").count() == 0
