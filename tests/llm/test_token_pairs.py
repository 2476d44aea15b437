from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from panelprep.llm import token_pairs
from panelprep.llm.encoding import byte_alphabet
from panelprep.llm.queries import op11_alignment

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(PATHS[0])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
BYTE = {c: b for b, c in byte_alphabet().items()}


def plain_tokens(text):
    """(id, first byte, end) by A and by B."""
    whole = (" " + (text or "")).encode()
    out = []
    ids_a = A.encode(" " + (text or ""), add_special_tokens=False).ids
    ids_b = B.encode(text or "")
    for ids, of in ((ids_a, lambda i: bytes(BYTE[c] for c in A.id_to_token(i))),
                    (ids_b, lambda i: bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode())):
        at, tokens, joined = 0, [], b""
        for i in ids:
            tokens.append((i, at, at + len(of(i))))
            at += len(of(i))
            joined += of(i)
        if not text or joined != whole:
            return [], []
        out.append(tokens)
    return out


def plain(texts):
    tokens, linked = [plain_tokens(t) for t in texts], []
    for a, b in tokens:
        linked.append([(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] if len(a) < 2000 else None)
        if linked[-1] is None:  # too many to try all
            linked[-1], k = [], 0
            for x in a:
                while b[k][2] <= x[1]:
                    k += 1
                j = k
                while j < len(b) and b[j][1] < x[2]:
                    linked[-1].append((x[0], b[j][0]))
                    j += 1
    counts = Counter(pair for links in linked for pair in links)
    top = {}
    for (_, y), n in counts.items():
        top[y] = max(top.get(y, 0), n)
    out = []
    for (a, b), links in zip(tokens, linked):
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        ga, gb = ([[] for _ in ends] for _ in "ab")
        for of, groups in ((a, ga), (b, gb)):
            g = 0
            for i, _, end in of:
                groups[g].append(str(i))
                g += end == ends[g]
        said = ";".join(",".join(x) + "|" + ",".join(y) for x, y in zip(ga, gb))
        out.append((len(a), len(b), len(ends), len(links), sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(said.encode()).hexdigest() if said else ""))
    return out


TEXTS = ["Hello  world", "a\n\n\tb <|endoftext|> <s> </s> <unk> <0x41>", "▁", "x▁y", "½ ﬁ 字𝄞 \x00 é Å", " ", "  lead and trail  ", "don't I'LL 1234 3.14",
         "zzz" * 50, "   ​", "é" * 30, "\r\n\r\n", "tab\tx"]


@pytest.mark.parametrize("bounds", [{}, {"chunk_bytes": 3000, "slice_pairs": 2000, "group_bytes": 500}])
def test_odd_documents(spark, odd_docs, bounds):
    rows, df = odd_docs
    more = [(200 + i, t, None, None, None, None) for i, t in enumerate(TEXTS)]
    df = df.unionByName(spark.createDataFrame(more, df.schema))
    got = token_pairs.align_documents(df, *PATHS, **bounds).collect()
    texts = [r[1] for r in rows + more]
    want = [(r[0], *w) for r, w in zip(rows + more, plain(texts))]
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    assert sum(r["n_links"] == 0 for r in got) >= 4


def test_groups_as_text(spark, odd_docs):
    _, df = odd_docs
    for r in token_pairs.align_documents(df.where("doc_id < 5"), *PATHS, groups=True).collect():
        assert hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] and len(r["groups"].split(";")) == r["n_groups"]


def test_empty_table(no_docs):
    assert token_pairs.align_documents(no_docs, *PATHS).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = op11_alignment(spark, sf).collect()
    assert sorted(map(tuple, got)) == sorted((r["doc_id"], *w) for r, w in zip(rows, plain([r["text"] for r in rows])))


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 100_000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 60, n).astype(np.uint64))
    numbers = token_pairs.PerfectHash.from_bytes(token_pairs.PerfectHash.build(keys).to_bytes())
    assert sorted(numbers.numbers(keys).tolist()) == list(range(len(keys)))
    others = np.setdiff1d(rng.integers(0, 1 << 60, 100).astype(np.uint64), keys)
    assert (numbers.numbers(others) < max(n, 1)).all()


def test_parts_of_a_long_text(monkeypatch):
    both = token_pairs.Tokenizers(*PATHS)
    text = " ".join(t for t in TEXTS if "▁" not in t) + " plain words follow, with marks! " * 20
    whole = both.encode(text)
    monkeypatch.setattr(token_pairs, "PART_BYTES", 7)
    assert len(list(both._parts(text))) > 20
    assert all((x == y).all() and len(x) for x, y in zip(whole, both.encode(text)))
    assert whole[0].tolist() == A.encode(" " + text, add_special_tokens=False).ids and whole[1].tolist() == B.encode(text)
