from __future__ import annotations

import zlib

import numpy as np
import pytest

from panelprep.llm import quality_trees as q


def test_flat_trees_score_like_a_walk():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    trees = q.grow(x, y, rounds=20, depth=3)
    score = trees.score(x)
    assert ((score > 0.5) == y).mean() > 0.98
    for row, got in zip(x[:50], score):
        total = trees.base
        for feature, threshold, leaf in zip(trees.feature, trees.threshold, trees.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + bool(row[feature[node]] > threshold[node])
            total += leaf[node - len(feature)]
        assert got == pytest.approx(1 / (1 + np.exp(-total)))


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = q.scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert len(got) > 50 and np.mean([r["predicted"] == r["quality"] for r in got]) > 0.95


def test_held_out_labels_do_not_matter(spark, odd_docs):
    _, df = odd_docs
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 0]
    rows = [(i, i % 2, 0) for i in range(60) if i not in held] + [(3, None, 0), (None, 1, 0), (3, 1, 1)]
    schema = "doc_id long, quality int, toxic int"
    a = q.scores(df, spark.createDataFrame(rows, schema)).collect()
    b = q.scores(df, spark.createDataFrame(rows + [(i, 1, 0) for i in held], schema)).collect()
    key = lambda r: (str(r["doc_id"]), r["score"])
    assert sorted(a, key=key) == sorted(b, key=key) and len(a) == df.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in a)


def test_empty_tables(spark, no_docs, odd_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert q.scores(no_docs, labels).count() == 0
    assert {r["score"] for r in q.scores(odd_docs[1], labels).collect()} == {0.5}
