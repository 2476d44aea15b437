from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from panelprep.llm import merkle, queries

COLUMNS = ["doc_id", "source", "lang", "text"]


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values) -> str:
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes: list[str]) -> tuple[str, list[list[str]]]:
    """The root of a list of nodes, and each node's siblings on the way to it."""
    places, siblings = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for k, p in enumerate(places):
            siblings[k].append(["".join(nodes[p // 3 * 3 : p]), "".join(nodes[p + 1 : p // 3 * 3 + 3])])
        nodes = [h("".join(nodes[s : s + 3])) for s in range(0, len(nodes), 3)]
        places = [p // 3 for p in places]
    return nodes[0], siblings


def plain(rows: list[tuple]) -> list[tuple]:
    """(doc_id, leaf, subroot, root, proof, folded, verified) of rows (doc_id, source, values, values as found)."""
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append((r[0], leaf(r[2]), leaf(r[3])))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by_source[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[s] = plain_tree([r[1] for r in by_source[s]])
    root, above = plain_tree([trees[s][0] for s in sources])
    out = []
    for s, up in zip(sources, above):
        for (doc_id, own, found), steps in zip(by_source[s], trees[s][1]):
            folded = found
            for left, right in steps + up:
                folded = h(left + folded + right)
            out.append((doc_id, own, trees[s][0], root, h("".join(a + b for a, b in steps + up)), folded, folded == root))
    return out


def key(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)


def even(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0


def tampered():
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_odd_documents(odd_docs, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 3**levels)
    rows, df = odd_docs
    docs = [(r[0], r[3], (r[0], r[3], r[2], r[1]), (r[0], r[3], r[2], r[1].replace("\n", "") if r[1] and even(r[0]) else r[1])) for r in rows]
    got = merkle.proofs(merkle.build(df, COLUMNS, {"text": tampered()}), versions=True).collect()
    assert sorted((tuple(r)[:7] for r in got), key=key) == sorted(plain(docs), key=key)
    for r in got:
        assert (r["version"] is None) == r["verified"]
        if r["version"]:
            assert r["version"][-1] == r["folded_root"] and r["version"][0] != r["leaf"]
    assert not all(r["verified"] for r in got)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 82])
def test_group_sizes(spark, monkeypatch, n):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "BLOCK", 9)
    rows = [(i, "a", f"text {i}\n") for i in range(n)] + [(i, None, None) for i in range(n // 4)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = merkle.proofs(merkle.build(df, ["doc_id", "text"], {"text": tampered()})).collect()
    want = plain([(i, s, (i, t), (i, t.replace("\n", "") if t and even(i) else t)) for i, s, t in rows])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_empty_table(no_docs):
    assert merkle.proofs(merkle.build(no_docs, COLUMNS)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    docs = []
    for r in rows:
        text = r["text"].replace("\n", "") if r["text"] and even(r["doc_id"]) else r["text"]
        docs.append((r["doc_id"], r["source"], *((r["doc_id"], r["source"], r["lang"], r["n_chars"], t) for t in (r["text"], text))))
    got = queries.op13_merkle(spark, sf).collect()
    assert sorted(map(tuple, got), key=key) == sorted(plain(docs), key=key)
