from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from panelprep.llm import token_store as ts
from panelprep.llm.encoding import Encoder
from panelprep.llm.queries import tokenizer_path
from panelprep.llm.wavelet import WaveletMatrix


@pytest.mark.parametrize("n,top", [(0, 2), (1, 2), (63, 5), (64, 5), (65, 70000), (1000, 300)])
def test_wavelet_matrix(n, top):
    rng = np.random.default_rng(n)
    values = rng.integers(0, top, n).astype(np.uint16 if top < 65536 else np.uint32)
    matrix = WaveletMatrix.from_bytes(WaveletMatrix.build(values, 16 if values.dtype == np.uint16 else 17).to_bytes())
    assert (matrix.decode(np.uint32) == values).all()
    if n:
        at, value = rng.integers(0, n, 40), rng.integers(0, top, 40)
        assert (matrix.access(at) == values[at]).all()
        assert matrix.rank(value, at).tolist() == [int((values[:a] == v).sum()) for a, v in zip(at, value)]
        for v in {*values[:10].tolist(), top - 1}:
            assert matrix.occurrences(v).tolist() == np.flatnonzero(values == v).tolist() and matrix.count(v) == (values == v).sum()


ENCODER = Encoder(tokenizer_path())


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t'.,!?0123abcXYŹé—ßİΣ<|>"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_encodes_like_the_tokenizer(text):
    assert ENCODER.fast
    got = np.frombuffer(ENCODER.encode([text.encode()])[0], ENCODER.dtype).tolist()
    assert got == ENCODER.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["<|endoftext|> a", "A<|startoftext|>b'S", "it's I'LL x.y-z 3a", "ﬁ Å x́.y ½a२3"])
def test_special_strings(text):
    got = np.frombuffer(ENCODER.encode([text.encode()])[0], ENCODER.dtype).tolist()
    assert got == ENCODER.tokenizer.encode(text, add_special_tokens=False).ids


def test_texts_of_a_batch_and_long_ones():
    texts = ["a " * 700_000, "", "\n", "x" * 1_100_000 + " ß ’s 字 end", "it's"] * 2
    got = [np.frombuffer(ids, ENCODER.dtype).tolist() for ids in ENCODER.encode([t.encode() for t in texts])]
    assert got == [ENCODER.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_tokenizer_of_another_shape():
    import public_tokenizers

    other = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not other.fast
    text = "It's  A\n\ntext, ½ 字 "
    assert np.frombuffer(other.encode([text.encode()])[0], other.dtype).tolist() == other.tokenizer.encode(text, add_special_tokens=False).ids


def test_round_trip_in_order(spark, odd_docs, tmp_path):
    rows, df = odd_docs
    path = str(tmp_path / "shards")
    ts.write_shards(df, path, tokenizer_path(), shard_tokens=2000)
    got = ts.read_documents(spark, path).orderBy("start").collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode())))
    assert len(got) == len(rows)
    start = 0
    for r, (doc_id, text, *_) in zip(got, want):
        ids = [*ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        assert tuple(r) == (doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    places = {(t, d, k) for d, text, *_ in want for k, t in enumerate([*ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids, 1])}
    asked = [1, 2, 70_000, *sorted({t for t, _, _ in places})[5:200:40]]
    found = ts.find_tokens(spark, path, asked).collect()
    assert {tuple(r) for r in found} == {p for p in places if p[0] in asked}
    counts = {r["token"]: r["n"] for r in ts.count_tokens(spark, path, asked).collect()}
    assert counts == {t: sum(r["token"] == t for r in found) for t in asked}
    files = list((tmp_path / "shards").glob("part-*.parquet"))
    assert len(files) == spark.read.parquet(path).count() > 3  # one file a shard


def test_empty_table(no_docs):
    assert ts.encode_documents(no_docs, tokenizer_path()).count() == 0
