"""Each stage of the pipeline on its own input."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from panelprep.llm import fm_decontam, minhash, mixing, quality_trees
from panelprep.llm.queries import tokenizer_path
from tests.llm.test_fm_decontam import brute
from tests.oracle_compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for _, stage in pipeline.STAGES:
        after = stage(spark, docs, SF_DIR).cache()
        out.append((docs, after))
        docs = after
    return out


def test_columns_stay(stages):
    for before, after in stages[:-1]:
        assert after.schema.simpleString() == before.schema.simpleString()


def test_quality(spark, stages):
    before, after = stages[0]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in after.collect()}
    known = [r["doc_id"] for r in before.collect() if r["doc_id"] in labels]
    assert np.mean([(i in kept) == (labels[i] == 1) for i in known]) > 0.97


def test_one_of_each_class(stages):
    before, after = stages[1]
    found = minhash.near_duplicates(before).collect()
    assert sorted(r["doc_id"] for r in after.collect()) == sorted({r["class_id"] for r in found})
    assert after.count() == after.select("text").distinct().count()


def test_no_benchmark_passage_stays(spark, stages):
    before, after = stages[2]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    kept = {r["doc_id"] for r in after.collect()}
    assert all((r["doc_id"] in kept) == (not brute(r["text"], items)[4]) for r in before.collect())


def test_mix(stages):
    before, after = stages[3]
    plan = Counter()
    for r in mixing.mixed_rows(mixing.mix_plan(before)).collect():
        plan[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in after.collect()) == +plan


def test_tokens(stages):
    from tokenizers import Tokenizer

    before, after = stages[4]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for r in before.collect():
        ids = [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 1]
        want[r["doc_id"], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in after.collect()) == want


@pytest.mark.parametrize("name", [name for name, _ in pipeline.STAGES])
def test_odd_documents(spark, odd_docs, name):
    """Nulls, empty and long texts, repeated rows and clashing columns: rows come through a stage whole or not at all."""
    rows, docs = odd_docs
    after = dict(pipeline.STAGES)[name](spark, docs, SF_DIR)
    got, given = after.collect(), Counter(map(tuple, rows))
    if name == "tokens":
        assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
        return
    assert after.schema == docs.schema and set(map(tuple, got)) <= set(given)
    kept = Counter(map(tuple, got))
    if name == "mix":
        assert all(n <= 3 * given[row] for row, n in kept.items())
        return
    assert kept <= given
    if name == "near_duplicates":
        texts = Counter((r[1] or "") for r in rows)
        assert {(r["text"] or "") for r in got} <= set(texts) and len(got) == len({(r["text"] or "") for r in got})
        assert {r["doc_id"] for r in got} >= {i for i in range(3, 60)} | {102, 103}
    if name == "decontaminate":
        assert kept == given  # none has a passage, without words or with


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", ["op1_url_filters", "op10_decontamination"])
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_all_are_registered():
    names = entry.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 14)}
    assert quality_trees.SAMPLE and fm_decontam.WINDOW == 10
