from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelprep import functions as fn
from panelprep.functions import dates


def one(spark, value, fn_of, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(fn_of(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("raw, text, kind", [
    ("000300", "000300", "string"), ("20260309", "20260309", "int"), ("-0", "-0", "int"), ("1.0", "1.0", "float"),
    ("1e5", "1e5", "float"), ("NaN", "NaN", "float"), ("-Infinity", "-Infinity", "float"), ("true", "true", "bool"),
    ("True", "True", "string"), ("null", "null", "null"), ('"a\\"b"', 'a"b', "string"), ("[1, 2]", "[1, 2]", "array"),
    ('{"a": 1}', '{"a": 1}', "object"), ("{a}", "{a}", "string"), ("", "", "string"), (" 7 ", "7", "int"),
    ("510300.SH", "510300.SH", "string"), ("+5", "+5", "string"), ("[1,", "[1,", "string"),
])
def test_literal_type(spark, raw, text, kind):
    got = one(spark, raw, fn.literal_type)
    assert (got["text"], got["kind"]) == (text, kind)


def test_literal_of_null(spark):
    assert one(spark, None, fn.literal_type) is None


@pytest.mark.parametrize("raw, strict, want", [
    ("a=b=c", False, ("a", "b=c", True)), (" a = b ", False, ("a", " b ", True)), (" a = b ", True, ("a", "b", True)),
    ("ab", False, (None, None, False)), (" =b", False, ("", "b", False)), ("a= ", True, ("a", "", False)),
    ("a=", False, ("a", "", True)), ("=", True, ("", "", False)),
])
def test_key_value(spark, raw, strict, want):
    assert tuple(one(spark, raw, lambda c: fn.key_value(c, strict))) == want


@pytest.mark.parametrize("raw, want", [
    ("  a \t\n b 　c\x1cd ", "a b c d"), (" ", ""), ("x", "x"),
])
def test_normalize_ws(spark, raw, want):
    assert one(spark, raw, fn.normalize_ws) == want == " ".join(raw.split())


@pytest.mark.parametrize("raw", ["", "a", "a\n", "a\n\n", "\n", "a\r\nb\rc", "a\x0bb\x0cc\x1cd\x1de\x1ef\x85g h ", "\r\n", "\r\n\n"])
def test_split_lines(spark, raw):
    assert one(spark, raw, fn.split_lines) == raw.splitlines()


@pytest.mark.parametrize("raw, want", [
    ("10303", "10303"), ("https://x.org/d/2?doc_id=7", "7"), ("https://x.org/d/2?a=1&doc_id=7&doc_id=8#f", "7"),
    ("https://x.org/d?doc_id=&doc_id=9", "9"), ("https://x.org/d?q=接口 x&doc_id=a%20b+c", "a b c"), ("x.org/?doc_id=7", None),
    ("https://x.org/d", None), ("", None), ("https:///d?doc_id=7", None),
])
def test_doc_id(spark, raw, want):
    assert one(spark, raw, fn.doc_id) == want


def test_doc_url(spark):
    assert one(spark, "12", lambda c: fn.doc_url(c, "https://r")) == "https://r?doc_id=12"
    assert one(spark, "https://r/x", lambda c: fn.doc_url(c, "https://r")) == "https://r/x"


@pytest.mark.parametrize("raw, want", [
    (" A-Share Risk: Model! ", "a-share-risk-model"), ("中文", "runtime-note"), ("--a..b_--", "a..b_"), ("", "runtime-note"),
])
def test_slug(spark, raw, want):
    assert one(spark, raw, fn.slug) == want


def test_meta_map(spark):
    text = "接口：daily\n\n描述: a：b\nplain\n 限量 :  5 : 6 \n接口： weekly"
    assert one(spark, text, fn.meta_map) == {"接口": "weekly", "描述: a": "b", "限量": "5 : 6"}
    assert one(spark, None, fn.meta_map) is None


@pytest.mark.parametrize("code, family", [
    ("000001.SZ", "suffixed"), ("510300.SH", "suffixed"), ("000300.SH", "suffixed"), ("000300", "raw_index"),
    ("0700.HK", "hk"), ("2892.HK", "hk"), ("80700.HK", "hk"), ("Au9999.SGE", "venue"), ("SHAU.SGE", "venue"),
    ("CN5001.CI", "suffixed_index"), ("881001.MI", "suffixed_index"), ("159901.OF", "fund"), ("??", "unknown"),
])
def test_code_family(spark, code, family):
    assert one(spark, code, fn.code_family) == family


def test_raw_and_hk(spark):
    assert one(spark, "000300.SH", fn.to_raw_code) == "000300"
    assert [one(spark, c, fn.hk_default) for c in ("00700.HK", "700.HK", "80700.HK", "000001.SZ")] == [
        "0700.HK", "0700.HK", "80700.HK", "000001.SZ"]
    assert one(spark, "000001.SZ", fn.hk_key) is None


@pytest.mark.parametrize("code, keys", [
    ("760d010200", ["760d000000000000", "760d010000000000", "760d010200000000"]),
    ("b104020100", ["b104000000000000", "b104020000000000", "b104020100000000"]),
])
def test_hierarchy_key(spark, code, keys):
    assert [one(spark, code, lambda c, n=n: fn.hierarchy_key(c, n)) for n in (1, 2, 3)] == keys
    with pytest.raises(ValueError):
        fn.hierarchy_key("c", 4)


def test_dates(spark):
    assert dates.parse_date("20260309") == dates.parse_date(20260309) == dt.date(2026, 3, 9)
    data = [("20260131", dt.datetime(2026, 1, 31, 15)), ("20260201", dt.datetime(2026, 2, 1)), (None, None)]
    df = spark.createDataFrame(data, "d string, t timestamp_ntz")
    assert df.where(fn.date_between(df, "d", "2026-01-01", "20260131")).count() == 1
    assert df.where(fn.date_between(df, "t", "2026-01-31", "2026-01-31")).count() == 1
    assert df.where(fn.date_between(df, "t", None, "2026-02-01")).count() == 2
    with pytest.raises(TypeError):
        fn.date_between(spark.range(1), "id", "2026-01-01", None)
