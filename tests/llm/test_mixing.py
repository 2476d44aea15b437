from __future__ import annotations

import re
from collections import defaultdict

import pytest

from panelprep.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, most=3):
    """By sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, open_, out = sum(sizes.values()), set(names), {}
    while open_:
        left = total - sum(out.values())
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > most * sizes[s]}
        out |= {s: most * sizes[s] for s in full} if full else {s: level * weight[s] for s in open_}
        open_ -= full or set(open_)
    return out


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1000, "b": 1, "c": 2, "d": 5, None: 7}, {"x": 5, "y": 0}, {"only": 3}])
def test_targets(spark, sizes):
    got = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    assert {r["source"]: pytest.approx(r["target"]) for r in got.collect()} == targets(sizes)


def test_mix_of_odd_documents(odd_docs):
    rows, df = odd_docs
    got = [r.asDict() for r in mixing.mixed_rows(mixing.mix_plan(df)).collect()]
    assert len(got) == len(rows)
    size = lambda t: len(WORD.findall(t or ""))
    sizes = defaultdict(int)
    for _, t, _, s, *_ in rows:
        sizes[s] += size(t)
    want = targets(sizes)
    assert sorted(r["size"] for r in got) == sorted(size(t) for _, t, *_ in rows)
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]


def test_sources_come_near_their_targets_and_reruns_agree(spark):
    rows = [(i, "w " * (20 + i * 37 % 300), f"s{i % 5 if i % 3 else 0}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixed_rows(mixing.mix_plan(df)).collect()
    taken, target = defaultdict(int), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(taken[s] == pytest.approx(target[s], rel=0.01) for s in target)
    again = mixing.mixed_rows(mixing.mix_plan(df.repartition(7))).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in got) == sorted((r["doc_id"], r["taken"]) for r in again)


def test_documents_are_repeated_as_planned(odd_docs):
    _, df = odd_docs
    plan = mixing.mix_plan(df)
    mixed = mixing.mixed_documents(df, plan)
    assert mixed.columns == df.columns
    assert mixed.count() == sum(r["copies"] for r in plan.collect())


def test_empty_table_and_native_path(no_docs, odd_docs):
    assert mixing.mixed_rows(mixing.mix_plan(no_docs)).count() == 0
    plan = mixing.mixed_rows(mixing.mix_plan(odd_docs[1]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
