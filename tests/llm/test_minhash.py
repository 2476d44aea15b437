from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from panelprep.llm import minhash as m

SCHEMA = "doc_id long, text string, key string, n_links string"


def plain_classes(texts, threshold=0.8):
    """Weighted similarity of all pairs, and components of those at or above the threshold."""
    words = [(t or "").encode().split() for t in texts]
    n = len(texts)
    df = Counter(w for ws in words for w in set(ws))
    idf = {w: 1 + math.log((n + 1) / (c + 1)) for w, c in df.items()}
    sets = []
    for ws in words:
        grams = [tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))] if ws else []
        sets.append({g: c * sum(idf[w] for w in g) / len(g) for g, c in Counter(grams).items()})
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for g in s:
            where.setdefault(g, set()).add(i)
    close = {}
    for i, s in enumerate(sets):
        for j in {j for g in s for j in where[g] if j > i}:
            both = sum(min(w, sets[j][g]) for g, w in s.items() if g in sets[j])
            close[i, j] = both / (sum(s.values()) + sum(sets[j].values()) - both)
    for i in range(n):
        for j in range(i):
            if (texts[i] or "") == (texts[j] or "") or close.get((j, i), 0) >= threshold:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    classes = {}
    for i in range(n):
        classes.setdefault(root(i), []).append(i)
    return {i: min(c) for c in classes.values() for i in c}, close


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
    word = lambda: rng.choice(vocabulary)
    texts = [None, "", " \n", "one two", "one two", "one two three", "same " * 400, "same " * 390]
    passage = [word() for _ in range(60)]
    for _ in range(60):
        base = [word() for _ in range(rng.randint(20, 250))]
        if rng.random() < 0.4:
            base[10:10] = passage
        texts.append(" ".join(base))
        for _ in range(rng.choice([0, 0, 1, 2, 8])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 4, 9])):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed,bounds", [(1, {}), (2, {"chunk_bytes": 4000, "block_words": 500})])
def test_classes_equal_all_pairs(spark, seed, bounds):
    texts = corpus(seed)
    want, close = plain_classes(texts)
    docs = spark.createDataFrame([(i, t, "clash", None) for i, t in enumerate(texts)], SCHEMA)
    found = m.near_duplicates(docs, **bounds)
    got = {r["doc_id"]: r for r in found.collect()}
    assert len(got) == len(texts)
    clear = [p for p, s in close.items() if s >= 0.8]
    assert sum(got[a]["class_id"] == got[b]["class_id"] for a, b in clear) >= 0.99 * len(clear)
    assert sum(got[i]["class_id"] == want[i] for i in want) >= 0.98 * len(want)
    for i, r in got.items():  # no class joins what all pairs keep apart
        assert want[i] == want[r["class_id"]]
    sizes = Counter(r["class_id"] for r in got.values())
    assert all(r["n_class"] == sizes[r["class_id"]] for r in got.values())
    kept = m.one_of_each(docs, found)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(sizes)


def family(seed, n):
    """Variants of one text with six of sixty edits each: similar if they share four, and every edit is in a tenth of them."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(300)]
    edits = [(4 * i + 10, f"e{i}") for i in range(60)]
    texts = []
    for _ in range(n):
        words = list(base)
        for at, word in rng.sample(edits, 6):
            words[at] = word
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("n,bounds", [(400, {"block": 60, "block_shingles": 8000}), (2500, {})])
def test_all_similar_texts_of_a_family(spark, n, bounds):
    texts = family(n, n)
    words = [t.split() for t in texts]
    df = Counter(w for ws in words for w in set(ws))
    idf = {w: 1 + math.log((n + 1) / (c + 1)) for w, c in df.items()}
    number, worth = {}, []
    sets = np.zeros((n, 20_000), np.float32)
    for i, ws in enumerate(words):
        for g in zip(*(ws[k:] for k in range(5))):
            if g not in number:
                number[g] = len(number)
                worth.append(sum(idf[w] for w in g) / 5)
            sets[i, number[g]] = 1
    sets = sets[:, : len(worth)].astype(float)
    both = (sets * worth) @ sets.T
    total = np.diag(both)
    close = np.argwhere(np.triu(both / (total[:, None] + total - both) >= 0.8, 1)).tolist()
    want = list(range(n))
    for _ in range(n):  # smallest number of the component
        before = list(want)
        for a, b in close:
            want[a] = want[b] = min(want[a], want[b])
        if want == before:
            break
    assert len(close) > 30 and len(set(want)) > n / 4
    got = {r["doc_id"]: r["class_id"] for r in m.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), **bounds).collect()}
    assert sum(got[a] == got[b] for a, b in close) >= 0.98 * len(close)
    assert all(want[i] == want[c] for i, c in got.items())


def test_common_weights_equal_plain_sums():
    rng = np.random.default_rng(6)
    sets = []
    for _ in range(30):
        codes = np.sort(rng.choice(60, rng.integers(1, 40), replace=False)).astype(np.uint64)
        sets.append((codes, rng.integers(1, 4, len(codes)) * (1 + codes / 7)))
    plain = np.array([[sum(min(w, v) for c, w in zip(*a) for d, v in zip(*b) if c == d) for b in sets] for a in sets])
    for second in (np.zeros(30, bool), rng.random(30) < 0.4):
        right = second if second.any() else ~second
        got = m._common_weights(sets, second)
        same = np.equal.outer(np.flatnonzero(~second), np.flatnonzero(right))  # a text with itself isn't asked for
        assert np.allclose(got[~same], plain[~second][:, right][~same])


def test_samples_agree_as_often_as_texts_are_similar():
    rng = np.random.default_rng(0)
    row = lambda s, w: (np.array(sorted(s)), w)
    texts = m.Texts.__new__(m.Texts)
    a = rng.choice(1 << 48, 400, replace=False).astype(np.uint64)
    weight = {int(x): w for x, w in zip(a, rng.random(400) * 5 + 0.1)}
    left, right = np.sort(a[:300]), np.sort(a[100:])
    wl, wr = (np.array([weight[int(x)] for x in s]) for s in (left, right))
    wr = wr * 1.5
    texts.docs, texts.shingle, texts.weight = np.arange(2), np.concatenate((left, right)), np.concatenate((wl, wr))
    texts.starts, texts.ends = np.array([0, 300]), np.array([300, 600])
    got = texts.samples(2000)
    both = sum(min(weight[int(x)], 1.5 * weight[int(x)]) for x in a[100:300])
    want = both / (wl.sum() + wr.sum() - both)
    assert abs((got[0] == got[1]).mean() - want) < 0.05


def test_components_of_a_path(spark):
    names = [f"k{i:03d}" for i in range(60)]
    links = spark.createDataFrame(list(zip(names, names[1:])) + [("x", "y")], "a string, b string")
    got = {r["key"]: r["label"] for r in m.components(links).collect()}
    assert {got[n] for n in names} == {"k000"} and got["y"] == got["x"] == "x"


def test_links_of_a_hub_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(m, "HUB", 8)
    links = spark.range(1, 2001).selectExpr("'a' AS a", "concat('b', lpad(id, 5, '0')) AS b").unionByName(
        spark.createDataFrame([("x", "y"), ("y", "z"), ("b00007", "c")], "a string, b string"))
    thin = m._thinned(m._thinned(links, 1), 2)
    assert max(r["count"] for r in thin.groupBy("a").count().collect()) < 100
    got = {r["key"]: r["label"] for r in m.components(links).collect()}
    assert len(got) == 2005 and {got[k] for k in got if k[0] in "abc"} == {"a"} and {got[k] for k in "xyz"} == {"x"}


def test_odd_documents(odd_docs, no_docs):
    rows, df = odd_docs
    got = m.near_duplicates(df).collect()
    assert len(got) == len(rows)
    classes = {}
    for r in got:
        classes.setdefault(r["class_id"], []).append(r["doc_id"])
    assert sorted(classes[0]) == [0, 104, 104, 104, 104] and sorted(classes[1]) == [1, 105] and sorted(classes[2]) == [2, 105]
    assert sorted(classes[100]) == [100, 101] and classes[103] == [103] and classes[None] == [None]
    assert m.near_duplicates(no_docs).count() == 0


def test_result_claims_no_degree(no_docs):
    assert m.near_duplicates(no_docs).columns == ["doc_id", "key", "class_id", "class_key", "n_class", "n_copies"]  # not all links are looked for
