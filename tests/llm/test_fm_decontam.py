from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from panelprep.llm import fm_decontam as f

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, contaminated string"


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    w, hit, names = words(text), set(), set()
    for item_id, item in items:
        q = words(item)
        for window in [q[i : i + 10] for i in range(len(q) - 9)] if len(q) >= 10 else [q] if q else []:
            for i in range(len(w) - len(window) + 1):
                if w[i : i + len(window)] == window:
                    hit |= set(range(i, i + len(window)))
                    if item_id is not None:
                        names.add(str(item_id))
    return len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


def test_equals_plain_search(spark):
    rng = random.Random(1)
    word = lambda: rng.choice(["Éa", "the", "b1", "x", "fou", "Zoo", "q", "7", "über", "mm"])
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([3, 9, 10, 11, 14, 30, 30, 0, 25])]
    items += [(20, items[5][1]), (21, None), (22, "..."), (None, "Alone, here it is"), (23, "b1 b1 b1")]
    texts = [None, "", "the", "b1 b1 b1 b1 b1", "alone here IT is now", items[5][1], items[6][1] + "-" + items[6][1]]
    for _ in range(80):
        parts = [" ".join(word() for _ in range(rng.randint(0, 30))) for _ in range(3)]
        q = words(rng.choice(items)[1])
        start = rng.randint(0, 5)
        parts.insert(1, rng.choice([" ", ", ", "\n"]).join(q[start : start + rng.randint(2, 30)]))
        texts.append(" new ".join(parts))
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], SCHEMA)
    bench = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, n_words string")
    got = {r["doc_id"]: r for r in f.report(docs, bench).collect()}
    for i, t in enumerate(texts):
        assert tuple(got[i])[1:6] == brute(t, items), t
        assert sum(s["end"] - s["start"] for s in got[i]["spans"]) == got[i]["n_hit"]
    sliced = f.decontaminate(docs, bench, slice_windows=20).select("doc.doc_id", "found.*").collect()  # some searches for several slices
    assert sorted(tuple(r)[:6] for r in sliced) == sorted(tuple(r)[:6] for r in got.values())
    assert f.phrase_slices(bench, slice_windows=20).count() > 3
    kept = f.decontaminate(docs, bench).select("doc.*", "found.items")
    assert kept.columns == [*docs.columns, "items"] and kept.count() == len(texts)


@pytest.mark.parametrize("seed", range(5))
def test_index_locates_all_occurrences(seed):
    rng = np.random.default_rng(seed)
    symbols = np.where(rng.random(500) < 0.1, 0, rng.integers(1, 5, 500))
    symbols[-1] = 0
    index = f.FmIndex(symbols)
    phrases = np.zeros((30, 4), np.int64)
    length = rng.integers(1, 5, 30)
    for i, n in enumerate(length):
        phrases[i, :n] = rng.integers(1, 7, n)
    low, high = index.search(phrases, length)
    for p, n, a, b in zip(phrases, length, low, high):
        want = [i for i in range(len(symbols) - n + 1) if (symbols[i : i + n] == p[:n]).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_empty_tables(spark, no_docs, odd_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert f.report(no_docs, bench).count() == 0
    assert {r["n_hit"] for r in f.report(odd_docs[1], bench).collect()} == {0}
