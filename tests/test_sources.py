from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from panelprep.operators import sets
from panelprep.sources import (
    Between, head, interval_scan, merge_params, parse_value_list, read_values, resolve_format, scan, split_log,
    split_read_paths, split_read_table, split_scan, split_summary, typed_values, values_to_intervals, with_inline, write,
)


def values(df):
    return [r["value"] for r in df.orderBy("pos").collect()]


def test_text_values(spark, tmp_path):
    path = tmp_path / "v.txt"
    path.write_text("000300\n\n  510300.SH \n\t\n7\n", encoding="utf-8")
    assert values(read_values(spark, str(path))) == ["000300", "510300.SH", "7"]
    with pytest.raises(AnalysisException):
        read_values(spark, str(tmp_path / "missing.txt"))


def test_table_values(spark, tmp_path):
    csv = tmp_path / "v.csv"
    csv.write_text("﻿code,date\n000300,1\n ,2\n000905,3\n", encoding="utf-8")
    assert values(read_values(spark, str(csv))) == ["000300", "000905"]
    assert values(read_values(spark, str(csv), "date")) == ["1", "2", "3"]
    with pytest.raises(ValueError, match="available: code, date"):
        read_values(spark, str(csv), "nope")
    tsv = tmp_path / "v.tsv"
    tsv.write_text("000300\tx\n000905\ty\n", encoding="utf-8")
    assert values(read_values(spark, str(tsv), header=False)) == ["000300", "000905"]


@pytest.mark.parametrize("doc, column, want", [
    (["000300", 5, None, True], None, ["000300", "5", None, "true"]),
    ([{"code": "a", "n": 1}, {"code": "b"}], "code", ["a", "b"]),
    ({"values": ["x", "y"]}, None, ["x", "y"]),
    ({"code": ["x", 2]}, "code", ["x", "2"]),
    ([], None, []),
])
def test_json_values(spark, tmp_path, doc, column, want):
    path = tmp_path / "v.json"
    path.write_text(json.dumps(doc), encoding="utf-8")
    assert values(read_values(spark, str(path), column)) == want


@pytest.mark.parametrize("text, column", [
    ('[{"code": 1}]', None), ('[{"code": 1}, 2]', "code"), ('[{"a": 1}]', "code"), ('{"a": 1}', "b"), ('"x"', None), ("[1,", None),
])
def test_bad_json_values(spark, tmp_path, text, column):
    path = tmp_path / "v.json"
    path.write_text(text, encoding="utf-8")
    with pytest.raises(PySparkException):
        read_values(spark, str(path), column).collect()


def test_json_lines_values(spark, tmp_path):
    path = tmp_path / "v.jsonl"
    path.write_text('{"code": "000300"}\n\n{"code": 7}\n', encoding="utf-8")
    assert values(read_values(spark, str(path), "code")) == ["000300", "7"]


def test_inline_list(spark):
    data = [(1, " "), (2, "a, ,20260309,000300"), (3, '["a", 1, 2.5, null, [1]]'), (4, "[1,")]
    df = spark.createDataFrame(data, "id int, v string")
    got = {r["id"]: r["x"] for r in df.select("id", parse_value_list("v", strict=False).alias("x")).collect()}
    assert got[1] == [] and got[4] is None
    assert [tuple(x) for x in got[2]] == [("a", "string"), ("20260309", "int"), ("000300", "string")]
    assert [tuple(x) for x in got[3]] == [
        ("a", "string"), ("1", "int"), ("2.5", "float"), ("null", "null"), ("[1]", "array")]
    with pytest.raises(PySparkException):
        df.select(parse_value_list("v")).collect()


def test_merge_params(spark):
    def settings(*texts):
        return spark.createDataFrame(list(enumerate(texts)), "pos int, text string")

    base = {"a": 1, "d": None}
    got = merge_params(base, settings("a=2", " b =x=y", 'c=["q"]', "e=1.50", "f=true", "g=000300", "a=3"))
    assert got == {"a": 3, "d": None, "b": "x=y", "c": ["q"], "e": 1.5, "f": True, "g": "000300"}
    assert base == {"a": 1, "d": None} and merge_params(base) == base
    for text in ("novalue", "=x"):
        with pytest.raises(ValueError):
            merge_params({}, settings(text))


def test_scan(spark, rows):
    data = [("000001.SZ", dt.date(2026, 3, 9), 1.0), ("000001.SZ", dt.date(2026, 3, 10), 2.0), ("x", None, None)]
    df = spark.createDataFrame(data, "ts_code string, trade_date date, close double")
    assert scan(df, {"trade_date": 20260309}).count() == 1
    assert scan(df, {"TS_CODE": ["000001.SZ", "x"], "trade_date": Between("20260309", None)}, "CLOSE, ts_code").columns == [
        "close", "ts_code"]
    assert scan(df, {"close": Between(1.5, 2.5)}).count() == 1
    assert scan(df, {"close": None}).count() == 1
    with pytest.raises(ValueError, match="available"):
        scan(df, {"nope": 1})


def test_split_scan(spark, rows):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("b", 1, 30)], "code string, day int, v int")
    requests = spark.createDataFrame([(1, "1"), (2, "9"), (3, "1"), (4, "zz")], "pos int, value string")
    out = split_scan(df, requests, "day", {"code": "a", "day": 2})
    assert rows(out, "request_pos", "code", "day", "v") == [(1, "a", 1, 10), (3, "a", 1, 10)]
    log = split_log(df, requests, "day", {"code": "a"})
    assert [r["n_rows"] for r in log.orderBy("request_pos").collect()] == [1, 0, 1, 0]
    assert out.count() == log.agg(F.sum("n_rows")).first()[0]
    assert tuple(split_summary(log).first()) == (4, 2, 2)


def test_split_by_date_text(spark):
    df = spark.createDataFrame([(dt.date(2026, 3, 9), 1), (dt.date(2026, 3, 10), 2)], "trade_date date, v int")
    requests = spark.createDataFrame([(1, "20260310"), (2, "2026-03-09")], "pos int, value string")
    assert sorted(r["v"] for r in split_scan(df, requests, "trade_date").collect()) == [1, 2]


def test_split_by_day_of_times(spark, rows):
    df = spark.createDataFrame([(dt.datetime(2026, 3, 9, 10), 1), (dt.datetime(2026, 3, 9, 23), 2), (dt.datetime(2026, 3, 10), 3)], "t timestamp, v int")
    requests = spark.createDataFrame([(1, "20260309"), (2, "not a day")], "pos int, value string")
    assert rows(split_scan(df, requests, "t"), "request_pos", "v") == [(1, 1), (1, 2)]
    log = rows(split_log(df, requests, "t"))
    assert log == [(1, "20260309", dt.date(2026, 3, 9), 2), (2, "not a day", None, 0)]


def test_corrupt_slice_is_logged(spark, tmp_path):
    for name in ("good", "bad"):
        spark.range(5).selectExpr("CAST(id AS INT) AS v").coalesce(1).write.parquet(str(tmp_path / name))
    part = next((tmp_path / "bad").glob("part-*.parquet"))
    part.write_bytes(part.read_bytes()[:40])
    (tmp_path / "bad" / f".{part.name}.crc").unlink()
    out, log = split_read_paths(spark, [str(tmp_path / n) for n in ("good", "bad")], "v int", continue_on_error=True)
    assert out.count() == 5
    assert [r["status"] for r in log.orderBy("request_pos").collect()] == ["ok", "failed"]


def test_slices_of_a_table_of_requests(spark, tmp_path):
    root = tmp_path / "slices"
    for name, value in (("a", 1), ("b c", 2), ("cut", 3), ("text", 4)):
        column = "CAST(id AS STRING) AS v" if name == "text" else f"CAST({value} AS INT) AS v"
        spark.range(3).selectExpr(column, "id AS w").coalesce(1).write.parquet(str(root / name))
    part = next((root / "cut").glob("part-*.parquet"))
    part.write_bytes(part.read_bytes()[:60])
    (root / "cut" / f".{part.name}.crc").unlink()
    spark.range(2).selectExpr("CAST(7 AS INT) AS v").coalesce(1).write.parquet(str(tmp_path / "one"))
    next((tmp_path / "one").glob("part-*.parquet")).rename(root / "single.parquet")
    asked = spark.createDataFrame([(k, p) for k, p in enumerate(["a", "gone", "cut", "b c/", "text", "single.parquet", "a"])], "pos int, path string")
    rows, log = split_read_table(spark, str(root), asked, "v int")
    got = [(r["status"], r["n_rows"]) for r in log.orderBy("pos").collect()]
    assert got == [("ok", 3), ("missing", 0), ("failed", 0), ("ok", 3), ("failed", 0), ("ok", 2), ("ok", 3)]
    assert sorted(r["v"] for r in rows.collect()) == [1, 1, 1, 2, 2, 2, 7, 7]
    none, log = split_read_table(spark, str(root), asked.where("pos = 1"), "v int")
    assert none.count() == 0 and none.columns == ["v"] and log.first()["status"] == "missing"
    assert split_read_table(spark, str(root), asked.limit(0), "v int")[1].count() == 0


def test_values_follow_files_and_quotes(spark, tmp_path):
    folder = tmp_path / "v.txt"
    folder.mkdir()
    (folder / "part-0.txt").write_text("first\n")
    (folder / "part-1.txt").write_text("".join(f"v{i}\n" for i in range(50)))
    assert values(read_values(spark, str(folder), fmt="txt")) == ["first", *(f"v{i}" for i in range(50))]
    path = write(spark.createDataFrame([('a "b" c',), ("x, y",)], "name string"), str(tmp_path / "q.csv"))
    assert sorted(values(read_values(spark, path))) == ['a "b" c', "x, y"]
    (tmp_path / "m.csv").write_text('name\n"two\nlines"\n"say ""x"""\n')
    assert values(read_values(spark, str(tmp_path / "m.csv"), multi_line=True)) == ["two\nlines", 'say "x"']


def test_typed_and_inline_values(spark, tmp_path):
    (tmp_path / "v.txt").write_text("000300\n7\n1.50\n")
    typed = typed_values(read_values(spark, str(tmp_path / "v.txt")))
    both = with_inline(typed, "8,[x").orderBy("part", "pos")
    assert [(r["text"], r["kind"]) for r in both.collect()] == [
        ("000300", "string"), ("7", "int"), ("1.50", "float"), ("8", "int"), ("[x", "string")]


def test_inline_numbers_keep_their_kind(spark):
    got = spark.sql("SELECT '[1.0, 100.0, 1.50, 2, 1e3, \"1.0\"]' AS v").select(parse_value_list("v").alias("x")).first()["x"]
    assert [tuple(x) for x in got] == [
        ("1.0", "float"), ("100.0", "float"), ("1.5", "float"), ("2", "int"), (got[4]["text"], "float"), ("1.0", "string")]


def test_slices(spark, tmp_path):
    for name, value in (("a", 1), ("b", 2)):
        spark.createDataFrame([(value,)], "v int").write.parquet(str(tmp_path / name))
    paths = [str(tmp_path / n) for n in ("a", "missing", "b")]
    out, log = split_read_paths(spark, paths, "v int", continue_on_error=True)
    assert sorted(r["v"] for r in out.collect()) == [1, 2]
    assert [r["status"] for r in log.orderBy("request_pos").collect()] == ["ok", "failed", "ok"]
    with pytest.raises(AnalysisException):
        split_read_paths(spark, paths, "v int")
    with pytest.raises(ValueError, match="all slices failed"):
        split_read_paths(spark, paths[1:2], "v int", continue_on_error=True)
    assert split_read_paths(spark, [], "v int")[0].count() == 0


def test_interval_scan_pushes_down(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.sql("SELECT timestamp_ntz'2026-01-01 10:00:00' + make_interval(0, 0, 0, CAST(id AS INT)) AS t, id FROM range(40)").write.parquet(path)
    out = interval_scan(spark.read.parquet(path), "t", "2026-01-05", "2026-01-06")
    assert sorted(r["id"] for r in out.collect()) == [4, 5]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t," in plan and "LessThan(t," in plan


def test_values_to_intervals(spark, rows):
    days = [dt.date(2026, 3, d) for d in (5, 6, 9, 10, 11)]
    calendar = spark.createDataFrame([(d,) for d in days], "trade_date date")
    asked = spark.createDataFrame([("20260306",), ("20260309",), ("20260311",), ("20260307",), ("20260309",)], "trade_date string")
    assert rows(values_to_intervals(asked, calendar)) == [(days[1], days[2], 2), (dt.date(2026, 3, 7), dt.date(2026, 3, 7), 1), (days[4], days[4], 1)]


def test_head(spark):
    assert [r["id"] for r in head(spark.range(9), 2, [F.col("id").desc()]).collect()] == [8, 7]
    assert head(spark.range(9), 0).count() == 0


@pytest.mark.parametrize("path, explicit, want", [
    (None, None, "csv"), ("a.CSV", None, "csv"), ("x/a.json", None, "json"), ("a.Parquet", None, "parquet"), ("a.txt", "json", "json"),
])
def test_resolve_format(path, explicit, want):
    assert resolve_format(path, explicit) == want


def test_resolve_format_errors(spark, tmp_path):
    for path in ("a.txt", "dir.csv/a"):
        with pytest.raises(ValueError):
            resolve_format(path)
    with pytest.raises(ValueError):
        write(spark.range(1), str(tmp_path / "x"), "orc")


def test_write_json_keeps_nulls(spark, tmp_path):
    path = write(spark.createDataFrame([("中", None)], "a string, b string"), str(tmp_path / "deep" / "x.json"))
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "deep" / "x.json").glob("part-*"))
    assert json.loads(text) == {"a": "中", "b": None} and "中" in text and path.endswith("x.json")


def test_sets(spark, rows):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3.5, "q")], "x double, z string")
    assert rows(sets.stack([a, b]), "x", "z") == [(1.0, None), (3.5, "q")]
    with pytest.raises(ValueError):
        sets.stack([])
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), ("j", 5, "c")], "key string, o int, v string")
    assert rows(sets.dedupe_first(df, ["key"], ["o"]), "key", "v") == [("j", "c"), ("k", "a")]
    assert rows(sets.top_k(df, ["key"], ["o"], 2, "r"), "key", "r") == [("j", 1), ("k", 1), ("k", 2)]


def test_numbered_over_a_hot_key(spark):
    # Nine rows in ten share a key, one key is null; ids aren't dense.
    df = spark.range(5000).select(
        F.when(F.col("id") % 10 > 0, "hot").when(F.col("id") % 100 > 0, F.col("id").cast("string")).alias("key"),
        (F.col("id") * F.col("id") + 7).alias("seq"))
    got = {}
    for r in sets.numbered(df, ["key"], "seq", "n").collect():
        got.setdefault(r["key"], []).append((r["seq"], r["n"]))
    for pairs in got.values():
        assert [n for _, n in sorted(pairs)] == list(range(1, len(pairs) + 1))
    assert len(got["hot"]) == 4500 and len(got[None]) == 50
