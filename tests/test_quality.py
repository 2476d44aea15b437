from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from panelprep.operators import quality
from panelprep.sources import Between


def d(day):
    return dt.date(2024, 1, day)


def panel(spark):
    return spark.createDataFrame([
        ("000001.SZ", d(2), 1.0, None), ("000001.SZ", d(2), 2.0, None), ("0700.HK", d(3), None, 5), ("000300", None, 4.0, None)],
        "con_code string, trade_date date, close double, `odd.name` int")


def test_basics(spark, rows):
    df = panel(spark)
    assert tuple(quality.shape(df).first()) == (4, 4, "con_code, trade_date, close, odd.name")
    assert tuple(quality.date_span(df, "trade_date").first()) == (d(2), d(3), 2, 4)
    text = df.withColumn("t", F.date_format("trade_date", "yyyyMMdd"))
    assert tuple(quality.date_span(text, "t").first()) == (d(2), d(3), 2, 4)
    assert rows(quality.date_span(df, "trade_date", "con_code"), "con_code", "n_dates") == [
        ("000001.SZ", 1), ("000300", 0), ("0700.HK", 1)]
    assert rows(quality.duplicate_keys(df, ["con_code", "trade_date"])) == [("000001.SZ", d(2), 2, 1)]
    assert rows(quality.null_profile(df, 0.5)) == [
        ("close", 1, 0.25, False), ("con_code", 0, 0.0, False), ("odd.name", 3, 0.75, True), ("trade_date", 1, 0.25, False)]
    empty = quality.null_profile(df.limit(0)).first()
    assert (empty["null_count"], empty["null_ratio"], empty["null_heavy"]) == (0, None, False)


def test_filter_violations(spark, rows):
    out = quality.filter_violations(panel(spark), {"close": Between(1, 2), "con_code": ["000001.SZ", "0700.HK"], "trade_date": "20240102"})
    assert rows(out) == [("close", 4, 2, False), ("con_code", 4, 1, False), ("trade_date", 4, 2, False)]


def test_coverage(spark, rows):
    asked = spark.createDataFrame([("000001.SZ",), ("000001.SZ",), ("9.HK",), ("0700.HK",)], "con_code string")
    cov = quality.code_coverage(asked, panel(spark), "con_code")
    assert rows(cov) == [("000001.SZ", "suffixed", 2, True), ("0700.HK", "hk", 1, True), ("9.HK", "hk", 0, False)]
    assert rows(quality.coverage_by_family(cov)) == [("hk", 2, 1, 1, 0.5), ("suffixed", 1, 1, 2, 1.0)]


def test_contract_diff(spark, rows):
    contracts = spark.createDataFrame([("daily", ["Con_Code", "close", "gone"])], "api_name string, output_fields array<string>")
    assert rows(quality.contract_diff(contracts, panel(spark).drop("odd.name")), "documented", "present", "status") == [
        (None, "trade_date", "present_undocumented"), ("Con_Code", "con_code", "case_only"), ("close", "close", "match"),
        ("gone", None, "documented_absent")]


def test_page_limits(spark, rows):
    pages = spark.createDataFrame([
        ("a", "r1", 1, 5000), ("a", "r1", 2, 5000), ("b", "r1", 1, 100), ("b", "r1", 2, 40), ("c", "r1", 1, 7), ("c", "r2", 1, 7)],
        "api_name string, request string, page int, rows int")
    limits = spark.createDataFrame([("a", "单次最大5,000行"), ("b", "限量：80条"), ("c", "none")], "api_name string, limit_text string")
    out = quality.page_limit_check(pages, limits)
    assert rows(out, "api_name", "documented_limit", "limit_observed", "limit_exceeded", "suspicious") == [
        ("a", 5000, True, False, True), ("b", 80, False, True, False), ("c", None, None, False, False)]


def test_failures(spark, rows):
    log = [("a", "1", None, 5), ("a", "2", "HTTP Error 503", None), ("a", "2", "IncompleteRead(3 bytes read)", None), ("a", "2", None, 9),
           ("a", "3", "接口不存在", None), ("a", "3", "HTTP Error 503", None), ("a", "4", None, 0), ("a", "5", "no such filter 5031", None),
           ("a", "5", "HTTP Error 503", None), ("a", "6", "", 3)]
    out = quality.failure_verdict(spark.createDataFrame(log, "api string, request string, error string, rows long"))
    assert rows(out, "request", "verdict") == [
        ("1", "ok"), ("2", "flaky"), ("3", "missing"), ("4", "zero_rows"), ("5", "structural"), ("6", "ok")]


def test_sources_and_completeness(spark, rows):
    a = spark.createDataFrame([("x", d(1)), ("x", d(5)), ("y", d(2))], "k string, t date")
    b = spark.createDataFrame([("y", d(9)), ("z", d(3))], "k string, t date")
    assert rows(quality.compare_sources(a, b, "k", "t")) == [("a", 3, 2, d(1), d(5), 1), ("b", 2, 2, d(3), d(9), 1)]
    counts = {1: 10, 2: 10, 3: 9, 4: 3}
    df = spark.createDataFrame([(f"c{i}", d(day)) for day, n in counts.items() for i in range(n)], "k string, t date")
    assert tuple(quality.latest_complete_date(df, "t", "k", 0.9).first()) == (d(3), 9, 3)


def test_report(spark, rows):
    df = panel(spark).drop("odd.name")
    spec = quality.ReportSpec(
        key=["con_code", "trade_date"], date_col="TRADE_DATE", params={"close": Between(0, 9)},
        requested=spark.createDataFrame([("000300",), ("zz",)], "con_code string"))
    got = {(r["check_name"], r["subject"]): (r["value"], r["status"]) for r in quality.validation_report(df, spec).collect()}
    assert got[("row_count", "*")] == ("4", "ok") and got[("column_count", "*")] == ("3", "info")
    assert got[("filter_violations", "close")] == ("1", "warn") and got[("min_date", "TRADE_DATE")] == ("2024-01-02", "info")
    assert got[("duplicate_keys", "con_code,trade_date")] == ("1", "warn") and got[("zero_row_codes", "con_code")] == ("1", "warn")
    none = quality.validation_report(df.limit(0), quality.ReportSpec())
    assert {r["status"] for r in none.where("check_name = 'row_count'").collect()} == {"warn"}
