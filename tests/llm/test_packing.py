from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from panelprep.llm import packing
from panelprep.llm.encoding import Encoder
from panelprep.llm.queries import op12_packing, tokenizer_path

ENCODER = Encoder(tokenizer_path())


def plain_first_fit(lengths, sequence):
    bins = []
    for n in sorted(lengths, reverse=True):
        for b in bins:
            if sum(b) + n <= sequence:
                b.append(n)
                break
        else:
            bins.append([n])
    return bins


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_first_fit_decreasing(lengths):
    got = packing.pack(lengths, 64, padding=100.0)  # nothing has to be cut
    assert sorted(sorted(lengths[k] for k, _, _ in parts) for parts in got) == sorted(map(sorted, plain_first_fit(lengths, 64)))
    assert all(a == 0 and n == lengths[k] for parts in got for k, a, n in parts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80), st.sampled_from([0.0, 0.02, 0.3]))
def test_every_token_once_and_little_padding(lengths, padding):
    got = packing.pack(lengths, 64, padding)
    taken = sorted(part for parts in got for part in parts)
    at = {}
    for k, first, n in taken:
        assert first == at.get(k, 0) and n > 0
        at[k] = first + n
    assert at == {k: n for k, n in enumerate(lengths)}
    fills = [sum(n for _, _, n in parts) for parts in got]
    assert all(0 < f <= 64 for f in fills)
    assert sum(64 - f for f in fills if f & (f - 1)) <= padding * sum(lengths)


def test_room_tree_takes_the_first():
    rng = random.Random(2)
    tree, room = packing.RoomTree(100, 50), [50] * 100
    for _ in range(300):
        need = rng.randint(1, 9)
        want = next(i for i, r in enumerate(room) if r >= need)
        room[want] -= need
        assert tree.first_fit(need) == want


def whole(rows, got, sequence=packing.SEQUENCE):
    """Every id of every row in one piece, sequences without gaps."""
    want = {}
    for doc_id, text in rows:
        ids = np.array([*ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.setdefault(doc_id, []).append(ids)
    pieces, sequences = {}, {}
    for r in got:
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["sequence_length"]))
    assert pieces.keys() == want.keys()
    for doc_id, texts in want.items():
        covered = 0
        for start, length, crc, tokens in pieces[doc_id]:
            assert any(len(ids) == tokens and start + length <= tokens and zlib.crc32(ids[start : start + length].tobytes()) == crc for ids in texts)
            covered += length
        assert covered == sum(map(len, texts))
        if len(texts) == 1:
            at = 0
            for start, length, _, _ in sorted(pieces[doc_id]):
                assert start == at
                at += length
    for parts in sequences.values():
        at = 0
        for offset, length, total in sorted(parts):
            assert offset == at and total == parts[0][2]
            at += length
        assert at == total <= sequence
    return sequences


@pytest.mark.parametrize("group_bytes", [packing.GROUP_BYTES, 40_000])
def test_odd_documents(odd_docs, group_bytes):
    rows, df = odd_docs
    got = packing.pack_documents(df, tokenizer_path(), group_bytes=group_bytes).collect()
    sequences = whole([(r[0], r[1]) for r in rows], got)
    tokens = sum(r["length"] for r in got)
    padded = sum(packing.SEQUENCE - s[0][2] for s in sequences.values() if s[0][2] & (s[0][2] - 1))
    assert padded <= packing.PADDING * tokens
    again = packing.pack_documents(df, tokenizer_path(), group_bytes=group_bytes).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_empty_table(no_docs):
    assert packing.pack_documents(no_docs, tokenizer_path()).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    whole(rows, op12_packing(spark, sf).collect())
