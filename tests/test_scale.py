"""Plans that have to hold at scale, and results on badly skewed keys."""

from __future__ import annotations

import contextlib
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from panelprep.operators import drift, joins, sets
from panelprep.plans import registry
from panelprep.sources import Between, scan

SF_DIR = "/root/testdata/sf0.001"


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


BIG = {"spark__sql__autoBroadcastJoinThreshold": "-1"}
SKEW = {
    **BIG, "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10KB", "spark__sql__shuffle__partitions": "16",
    "spark__sql__adaptive__coalescePartitions__enabled": "false", "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
}


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_no_cross_join_when_nothing_is_small(spark, name):
    with settings(spark, **BIG):
        text = plan(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # The number of tasks follows the input's bytes, but where pages are parsed, which costs far more than their bytes say.
    assert ("REPARTITION_BY_NUM" in text) == ("_read_elements" in text)
    # Python runs once per page, and only where HTML has to be read.
    assert len(re.findall(r"ArrowEvalPython \[", text)) <= 1 and "BatchEvalPython" not in text
    # Only frames of distinct days are broadcast by hint, keyed by one date or its position, and dictionaries whose size was measured.
    if not name.startswith("hierarchy_join"):
        for mode in re.findall(r"BroadcastExchange HashedRelationBroadcastMode\(List\(([^)]*\)*)", text):
            assert "," in mode and "string" not in mode


def test_scan_reaches_parquet(spark):
    df = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    with settings(spark, spark__sql__maxMetadataStringLength="1000"):
        text = plan(scan(df, {"l_shipdate": Between("1996-01-01", "1996-12-31"), "l_returnflag": ["A", "R"]}, "l_orderkey"))
    assert "GreaterThanOrEqual(l_shipdate" in text and "In(l_returnflag" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string,l_shipdate:timestamp_ntz>" in text


def test_top_k_is_limited_before_the_shuffle(spark):
    text = plan(sets.dedupe_first(spark.range(9).withColumn("k", F.col("id") % 2), ["k"], ["id"]))
    assert re.search(r"WindowGroupLimit .* Partial", text)


def test_ranked_contracts_are_parsed_once(spark):
    """Finding a sort's ranges runs what is below its exchange once more: that has to be another exchange, not the parsing."""
    lines = plan(entry.queries()["similar_contracts"](spark, SF_DIR)).splitlines()
    ranges = next(i for i, line in enumerate(lines) if "Exchange rangepartitioning" in line)
    assert "Exchange RoundRobinPartitioning" in lines[ranges + 1] and "_read_elements" in "".join(lines[ranges + 2:])


def test_rows_of_tables_are_made_once(spark):
    assert len(re.findall(r"map_from_arrays", plan(entry.queries()["page_tables"](spark, SF_DIR)))) == 1


def test_grep_and_links_do_not_shuffle(spark):
    for name in ("grep", "lines", "html_to_text", "page_links", "search_titles"):
        assert "Exchange" not in plan(entry.queries()[name](spark, SF_DIR)), name


def test_flow_panel_is_hash_aggregated_before_the_shuffle(spark):
    with settings(spark, **BIG):
        text = plan(entry.queries()["index_flow"](spark, SF_DIR))
    assert re.search(r"HashAggregate\(keys=\[index_code.*partial_sum\(\(raw_weight", text)


def test_panel_is_not_shuffled_before_its_sums(spark):
    """Days of an anchor period become rows last: between that and the partial sums there's no exchange."""
    with settings(spark, **BIG, spark__sql__adaptive__enabled="false"):
        for name in ("index_flow", "index_flow_by_source"):
            lines = plan(entry.queries()[name](spark, SF_DIR)).splitlines()
            exploded = next(i for i, line in enumerate(lines) if "Generate posexplode" in line)
            summed = max(i for i, line in enumerate(lines[:exploded]) if "partial_sum((raw_weight" in line)
            assert not [line for line in lines[summed:exploded] if "Exchange hashpartitioning" in line]
            assert not [line for line in lines if "Window [product" in line]


def scans(df) -> int:
    """Table scans of the plan that ran, without those whose exchange another one reads."""
    return len(re.findall(r"FileScan parquet", final_plan_of(df).split("== Initial Plan ==")[0]))


def test_partitions_are_pruned_by_days_as_the_query_runs(spark):
    df = entry.queries()["interval_scan_partitioned"](spark, SF_DIR)
    assert "dynamicpruning" in plan(df) and 0 < df.count() < 1500


def test_hot_prefix_and_hot_day_without_adaptive_execution(spark, tmp_path):
    path = str(tmp_path / "hot")
    hot(spark).repartition(8).write.parquet(path)
    facts = spark.read.parquet(path)
    days = facts.select("code", "trade_date").distinct().withColumn("q", F.lit(1))
    off = {**BIG, "spark__sql__adaptive__enabled": "false", "spark__sql__shuffle__partitions": "16"}
    with settings(spark, **off):
        out = joins.spread_join(facts, days, ["code", "trade_date"], salts=16, least=1000)
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("q").alias("n")).collect()]
        assert sum(sizes) == 60000 and max(sizes) < 15000 and out.where("q IS NULL").count() == 0
        together = facts.join(days, ["code", "trade_date"], "left").groupBy(F.spark_partition_id()).agg(F.count("q").alias("n"))
        assert max(r["n"] for r in together.collect()) >= 20000
        nulls = facts.withColumn("code", F.when(F.col("code") != "hot", F.col("code")))
        codes = days.select("code").distinct().withColumn("q", F.lit(1))
        out = joins.spread_join(nulls, codes, ["code"], salts=16, least=1000).groupBy(F.spark_partition_id()).agg(
            F.count(F.lit(1)).alias("n"), F.count("q").alias("hits")).collect()
        assert sum(r["n"] for r in out) == 60000 and max(r["n"] for r in out) < 15000 and sum(r["hits"] for r in out) == 20000
        coded = facts.select(F.concat(F.lit("760d01"), F.lpad((F.col("v") % 3).cast("string"), 4, "0")).alias("ind_code"), "v")
        dictionary = spark.createDataFrame([("760d010000000000", 3, "logistics")], "code string, levelnum int, name string")
        text = plan(joins.hierarchy_join(coded, dictionary, 2))
        assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
        assert joins.is_small(dictionary) and not joins.is_small(dictionary, 10)


def hot(spark, n=60000):
    """Rows of which two thirds belong to one code, a third to one (code, day)."""
    start = F.lit("2020-01-01").cast("date")
    return spark.range(n).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 500).cast("string"))).alias("code"),
        F.when(F.col("id") % 3 == 0, start).otherwise(F.date_add(start, (F.col("id") % 900).cast("int"))).alias("trade_date"),
        F.col("id").alias("v"))


def final_plan_of(df):
    # Runs this very plan, so the adaptive result can be read off it.
    df._jdf.queryExecution().toRdd().count()
    return plan(df)


def test_hot_day_is_split_in_weight_normalisation(spark, tmp_path):
    path = str(tmp_path / "hot")
    hot(spark).repartition(8).write.parquet(path)
    df = spark.read.parquet(path).select(F.lit("i").alias("index_code"), "trade_date", F.col("v").cast("double").alias("raw_weight"), "code")
    with settings(spark, **SKEW):
        out = drift.normalize_weights(df)
        assert "skew=true" in final_plan_of(out)
        assert out.count() == 60000
        sums = out.groupBy("index_code", "trade_date").agg(F.sum("weight").alias("s"))
        assert sums.where("abs(s - 1) > 1e-9").count() == 0


def test_hot_code_interval_join(spark, tmp_path):
    path = str(tmp_path / "hot")
    hot(spark).repartition(8).write.parquet(path)
    facts = spark.read.parquet(path)
    day = F.lit("2019-12-01").cast("date")
    members = facts.select("code").distinct().select("code", F.explode(F.sequence(F.lit(0), F.lit(990), F.lit(3))).alias("o")).select(
        "code", F.date_add(day, F.col("o")).alias("s"), F.date_add(day, F.col("o") + 2).alias("e"))
    with settings(spark, **SKEW):
        out = joins.interval_join(facts, members, "code", "trade_date", "s", "e", end_inclusive=True)
        assert "skew=true" in final_plan_of(out)
        assert out.count() == 60000
        assert out.where("trade_date NOT BETWEEN s AND e").count() == 0


def test_repeated_rows_are_not_broadcast(spark):
    """Rows that a sequence repeats count for Spark as few as before, so neither a grid of days nor bucketed memberships may be gathered."""
    start = F.lit("2020-01-01").cast("date")
    grid = spark.range(500).select(F.col("id").alias("code"), F.explode(F.sequence(start, F.date_add(start, 89))).alias("trade_date"))
    members = spark.range(500).select(F.col("id").alias("code"), start.alias("s"), F.date_add(start, (F.col("id") % 90).cast("int")).alias("e"))
    for how, want in (("inner", sum(i % 90 + 1 for i in range(500))), ("left", 45000)):
        out = joins.interval_join(grid, members, "code", "trade_date", "s", "e", end_inclusive=True, how=how)
        assert "Broadcast" not in final_plan_of(out) and "SortMergeJoin" in plan(out)
        assert out.count() == want


def test_hot_key_point_in_time_and_fallback(spark):
    facts = hot(spark, 3000).select(
        "code", F.col("trade_date").alias("ann_dt"), F.trunc("trade_date", "MM").alias("report_period"), "v")
    asked = hot(spark, 3000).select("code", "trade_date")
    with settings(spark, **SKEW):
        out = joins.point_in_time(asked, facts, "code")
        assert out.count() == 3000
        best = {}
        rows = [(r["code"], r["ann_dt"], r["report_period"], r["v"]) for r in facts.collect()]
        for code, ann, period, v in rows:
            best.setdefault(code, []).append((period, ann, v))
        for r in out.distinct().where(F.col("trade_date") == dt.date(2020, 1, 1)).collect():
            want = max(x for x in best[r["code"]] if x[1] <= r["trade_date"])
            assert (r["report_period"], r["ann_dt"], r["v"]) == want
        one, two = hot(spark, 3000).where("v % 2 = 0"), hot(spark, 3000)
        picked = joins.first_available([("one", one), ("two", two)], ["code", "trade_date"])
        keys = {(r[0], r[1]) for r in one.select("code", "trade_date").collect()}
        late = [r for r in two.collect() if (r["code"], r["trade_date"]) not in keys]
        assert picked.where("source = 'two'").count() == len(late)
        assert picked.where("source = 'one'").count() == one.count()
