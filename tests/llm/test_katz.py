"""Katz scores against a model kept in plain dictionaries."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import pytest

from panelprep.llm import katz
from panelprep.llm.katz import TOP, discounts

SCHEMA = "doc_id long, text string, held_out string"


class Model:
    """Counts of runs up to an order; a run's first word is None after the start."""

    def __init__(self, texts, order=2):
        self.order, self.runs = order, [Counter() for _ in range(order + 1)]
        for text in texts:
            seq = tokens(text)
            for t, w in enumerate(seq):
                self.runs[1][w] += 1
                for k in range(2, order + 1):
                    self.runs[k][history(seq, t, k), w] += 1
        self.words = self.runs[1]
        self.n = sum(self.words.values())
        self.d = [None, discounts(Counter(self.words.values()))] + [discounts(Counter(r.values())) for r in self.runs[2:]]
        left = sum(c * (1 - self.d[1][c]) for c in self.words.values() if c <= TOP)
        self.divisor = self.n if left > 0 else self.n + 1
        self.unknown = (left or 1) / self.divisor
        self.after = [None, None] + [{} for _ in self.runs[2:]]
        for k in range(2, order + 1):
            for (h, w), c in self.runs[k].items():
                self.after[k].setdefault(h, {})[w] = c

    def p(self, h, w):
        k = len(h) + 1
        if k == 1:
            c = self.words[w]
            return c * (self.d[1][c] if c <= TOP else 1) / self.divisor if c else self.unknown
        shorter, after = h[1:], self.after[k].get(h)
        if not after:
            return self.p(shorter, w)
        left = sum(c * (1 - self.d[k][c]) for c in after.values() if c <= TOP)
        divisor = sum(after.values()) + (left == 0)
        if w in after:
            return after[w] * (self.d[k][after[w]] if after[w] <= TOP else 1) / divisor
        return (left or 1) / divisor / (1 - sum(self.p(shorter, x) for x in after)) * self.p(shorter, w)


def history(seq, t, k):
    """The k - 1 words before place t, with start marks before the text."""
    return tuple(([None] * (k - 1) + seq)[t : t + k - 1])


def tokens(text):
    return [w for w in (text or "").encode().lower().split()] + [b""]


def is_held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def corpus():
    rows = [(i, " ".join(f"w{(i * 7 + j * j) % (5 + j % 11)}" for j in range(i % 40))) for i in range(120)]
    rows += [(200 + i, "The SAME line twice " * 3) for i in range(30)]
    rows += [(300, None), (301, ""), (None, "a b é"), (302, "unseen words only"), (302, "unseen words only"), (303, "same same same " * 2000)]
    return [(i, t, "clash") for i, t in rows]


@pytest.mark.parametrize("order,bounds", [(2, {}), (2, {"split": 20, "block_words": 100, "chunk_bytes": 400}), (3, {}),
                                          (3, {"split": 20, "block_words": 100, "chunk_bytes": 400}), (4, {"split": 9, "block_words": 150})])
def test_scores_equal_dictionary_model(spark, order, bounds):
    rows = corpus()
    model = Model([t for i, t, _ in rows if not is_held(i)], order)
    got = sorted((str(r["doc_id"]), r) for r in katz.score(spark.createDataFrame(rows, SCHEMA), order=order, **bounds).collect())
    assert len(got) == len(rows)
    want = sorted((str(i), i, t) for i, t, _ in rows)
    for (key, r), (wanted, i, t) in zip(got, want):
        assert key == wanted and r["held_out"] == is_held(i)
        seq = tokens(t)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(seq), sum(model.words[w] > 0 for w in seq), model.n)
        assert r["base_score"] == pytest.approx(sum(math.log10((model.words[w] + 1) / (model.n + len(model.words) + 1)) for w in seq), rel=1e-9)
        runs = [(history(seq, k, order), w) for k, w in enumerate(seq)]
        logs = {run: math.log10(model.p(*run)) for run in set(runs)}
        assert r["score"] == pytest.approx(sum(logs[run] for run in runs), rel=1e-9), t


def test_probabilities_after_a_context_add_up():
    model = Model([t for _, t, _ in corpus()], 3)
    for h in [(None, None), (None, b"w1"), (b"w1",), (b"same", b"line"), (b"same", b"same"), (b"never seen", b"w1")]:
        assert sum(model.p(h, w) for w in [*model.words, b"<unknown>"]) == pytest.approx(1, abs=1e-9)


def test_empty_table_and_no_training_documents(spark):
    assert katz.score(spark.createDataFrame([], SCHEMA)).count() == 0
    held = next(i for i in range(100) if is_held(i))
    row = katz.score(spark.createDataFrame([(held, "a b", "x")], SCHEMA)).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["score"], row["base_score"]) == (3, 0, 0, 0.0, 0.0)
