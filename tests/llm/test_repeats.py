"""Repeated strings against a count of all windows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from panelprep.llm import repeats
from panelprep.llm.chunks import ROW_BYTES, write_chunks

SCHEMA = "doc_id long, text string, n_bytes string"


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    count = Counter(t[i : i + length] for t in data for i in range(len(t) - length + 1))
    out = []
    for t in data:
        covered = [False] * len(t)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                covered[i : i + length] = [True] * length
        spans = sum(c and not (i and covered[i - 1]) for i, c in enumerate(covered))
        kept = bytes(b for b, c in zip(t, covered) if not c)
        out.append((len(t), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeinrstéß") for _ in range(rng.randint(1, 7)))
    passage = " ".join(word() for _ in range(90))
    base = " ".join(word() for _ in range(300))
    texts = [None, "", "short", "x" * 900, "ab" * 300, base, base, base + " tail"]
    for _ in range(40):
        words = [word() for _ in range(rng.randint(0, 200))]
        if rng.random() < 0.6:
            start = rng.randint(0, 200)
            words.insert(rng.randint(0, len(words)), passage[start : start + rng.randint(0, 500)])
        if rng.random() < 0.3:
            near = base.split()
            for _ in range(5):
                near[rng.randrange(len(near))] = word()
            words += near
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("seed,bounds", [(1, {}), (2, {"chunk_bytes": 3000, "block_anchors": 50, "range_bytes": 20000}), (3, {"chunk_bytes": 2000, "many": 3})])
def test_equals_count_of_windows(spark, seed, bounds):
    texts = corpus(seed)
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: tuple(r)[1:] for r in repeats.remove_repeats(docs, **bounds).collect()}
    want = brute(texts, repeats.LENGTH)
    assert len(got) == len(texts)
    for i, row in enumerate(want):
        assert got[i] == row, (i, texts[i])


def test_short_lengths_and_kept_text(spark):
    docs = spark.createDataFrame([(1, "abcXXXXXdef", ""), (2, "ghXXXXXij", ""), (None, "zz", "")], SCHEMA)
    got = {r["doc_id"]: bytes(r["kept"]) for r in repeats.remove_repeats(docs, length=5, gram=3, texts=True).collect()}
    assert got == {1: b"abcdef", 2: b"ghij", None: b"zz"}


def test_empty_table(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_chunks_of_empty_texts_are_bounded(spark):
    rows = [(i, None if i % 3 else "") for i in range(2000)]
    docs = spark.createDataFrame(rows, "id long, text string").coalesce(1).selectExpr("id", "id as k", "cast(coalesce(text, '') as binary) as text")
    words = write_chunks(docs, bytes.split, False, 100 * ROW_BYTES)
    texts = repeats._text_chunks(docs, 100 * ROW_BYTES)
    for sizes in ([len(c["ks"]) for c in words.select("ks").collect()], [len(c["ids"]) for c in texts.select("ids").collect()]):
        assert sum(sizes) == 2000 and max(sizes) <= 100
