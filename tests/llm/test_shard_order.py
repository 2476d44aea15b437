from __future__ import annotations

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from panelprep.llm import shard_order as s


@pytest.mark.parametrize("rows", [1, 2, 3, 10, 97, 1000])
def test_permutation(spark, rows):
    df = s.permuted(spark.range(rows).withColumnRenamed("id", "number"), "number", rows, seed=5)
    order = [r["position"] for r in df.orderBy("number").collect()]
    assert sorted(order) == list(range(rows))
    if rows >= 97:
        assert order != list(range(rows)) and order != [r["position"] for r in s.permuted(
            spark.range(rows).withColumnRenamed("id", "number"), "number", rows, seed=6).orderBy("number").collect()]


def test_cycle_walk_leaves_the_domain_in_time(spark):
    left, right = s.halves(97)
    assert left * right > 97
    images = [r[0] for r in spark.range(left * right).select(s.feistel(F.col("id"), left, right, 5)).collect()]
    assert sorted(images) == list(range(left * right))


def test_plan_is_gapless_even_and_repeatable(odd_docs):
    rows, df = odd_docs
    plan = s.shard_plan(df, 7)
    got = [tuple(r) for r in plan.collect()]
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter(g[:3] for g in got) == want
    slots = {}
    for r in plan.collect():
        assert r["law"] == "rows" and r["grown_shard"] is None
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) == set(range(7)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted((tuple(r) for r in s.shard_plan(df.repartition(5, "size"), 7).collect()), key=key)


def test_empty_table(no_docs):
    assert s.shard_plan(no_docs, 7).count() == 0


def test_main_path_is_native(odd_docs):
    plan = s.shard_plan(odd_docs[1], 7)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan
