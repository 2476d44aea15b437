"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are made from a text's bytes where the text is read.  The trees are
grown on a bounded sample of labelled documents (binned features, second-order
gains of the logistic loss) and flattened into arrays, one slot a node of a
complete binary tree; scoring moves all rows of a batch down one level at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelprep.llm.common import fold, text_or_empty

FEATURES = (
    "log_words", "word_length", "upper", "digits", "marks", "symbols", "bars", "non_ascii", "stops", "distinct", "top_word",
    "echo", "log_lines", "words_per_line", "repeated_lines", "spaces",
)
SAMPLE = 20_000  # labelled documents that the trees are grown on at most


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars)] = 1
    return out


_CLASSES = np.stack([
    _class(bytes(range(65, 91))), _class(b"0123456789"), _class(b"!?"), _class(b"#*$%&<>@^~+=_{}[]\\/"), _class(b"|"),
    _class(bytes(range(128, 256))), _class(b".,;:"), _class(b" \t\n\r\v\f"),
], axis=1)


def statistics(text: bytes) -> list[float]:
    """The features of one text; an empty one has zeros."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    upper, digits, marks, symbols, bars, non_ascii, stops, spaces = (np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _CLASSES).tolist()
    size = len(text)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    echo = sum(map(bytes.__eq__, words, words[1:]))
    return [
        float(np.log1p(n)), (size - spaces) / n, upper / size, digits / size, marks / n, symbols / n, bars / n, non_ascii / size, stops / n,
        len(counts) / n, max(counts.values()) / n, echo / n, float(np.log1p(len(lines))), n / len(lines),
        1 - len(set(lines)) / len(lines), spaces / size,
    ]


@dataclass
class Trees:
    """Boosted complete binary trees as arrays: rows are trees, columns nodes (heap order) or leaves."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for every row."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = int(np.log2(self.leaf.shape[1])) if len(self.leaf) else 0
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - len(leaf) + 1]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64,
         ridge: float = 1.0, least: float = 5.0) -> Trees:
    """Fits the trees; without rows, or with one label only, the score is that share (without rows a half)."""
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    if not len(y) or y.min() == y.max():
        return Trees(np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)), base)
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T)], axis=1)  # bin b: edge[b-1] < x <= edge[b]
    total = np.full(len(y), base)
    trees = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        gradient, hessian = p - y, p * (1 - p)
        feature, threshold, cut = np.zeros(inner, int), np.full(inner, np.inf), np.full(inner, bins)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local = node - first
            best = np.zeros(width)
            for f in range(x.shape[1]):
                key = local * bins + binned[:, f]
                g = np.bincount(key, gradient, width * bins).reshape(width, bins).cumsum(axis=1)
                h = np.bincount(key, hessian, width * bins).reshape(width, bins).cumsum(axis=1)
                n = np.bincount(key, minlength=width * bins).reshape(width, bins).cumsum(axis=1)
                g_all, h_all, n_all = g[:, -1:], h[:, -1:], n[:, -1:]
                gain = g**2 / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge) - g_all**2 / (h_all + ridge)
                gain[(n < least) | (n_all - n < least)] = 0
                gain[:, len(edges[f]):] = 0
                at = gain.argmax(axis=1)
                for k in np.flatnonzero(gain[np.arange(width), at] > best + 1e-9):
                    best[k] = gain[k, at[k]]
                    feature[first + k], threshold[first + k], cut[first + k] = f, edges[f][at[k]], at[k]
            node = 2 * node + 1 + (binned[np.arange(len(y)), feature[node]] > cut[node])
        local = node - inner
        leaf = -rate * np.bincount(local, gradient, leaves) / (np.bincount(local, hessian, leaves) + ridge)
        total += leaf[local]
        trees.append((feature, threshold, leaf))
    return Trees(*(np.stack(part) for part in zip(*trees)), base)


def training_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, bound: int, id_col: str, text_col: str) -> pd.DataFrame:
    """Features and label of at most ``bound`` labelled documents outside fold 0, those with the smallest digest of their id.

    Several labels of one id are averaged; documents of one id are all candidates.
    """
    chosen = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != 0)).groupBy(
        F.col("doc_id").alias("_id")).agg(F.avg(F.col(label).cast("double")).alias("y"))
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id").limit(bound)
    texts = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).cast("binary").alias("text"))
    joined = texts.join(F.broadcast(chosen), "_id")  # at most `bound` rows are sent out

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("y"), pa.array(x, pa.list_(pa.float64()))], names=["id", "y", "x"])

    kind = dict(docs.select(id_col).dtypes)[id_col]
    found = joined.select("_id", "y", "text").mapInArrow(features, f"id {kind}, y double, x array<double>")
    return found.orderBy(F.xxhash64("id"), "id", "x").limit(bound).toPandas()


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, bound: int = SAMPLE, id_col: str = "doc_id",
        text_col: str = "text") -> Trees:
    sample = training_sample(docs, labels, label, folds, bound, id_col, text_col)
    x = np.array(sample["x"].tolist(), float).reshape(len(sample), len(FEATURES))
    return grow(x, sample["y"].to_numpy(float))


def classify(docs: DataFrame, trees: Trees, text_col: str = "text") -> DataFrame:
    """A row ``(doc, score)`` per input row: the row as a struct and the probability of label 1.

    Null and empty texts have zeros for features and a score like any other text.
    Every text is scored whole, by itself: repeated rows score alike, an empty
    table gives no rows, and columns may have any names.
    """
    ready = docs.sparkSession.sparkContext.broadcast(trees)
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), text_or_empty(text_col).cast("binary").alias("text"))
    schema = packed.select("doc", F.lit(0.0).alias("score")).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t) for t in batch.column(1).to_pylist()], float).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ready.value.score(x))], names=["doc", "score"])

    return packed.mapInArrow(score, schema)


def scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, ``held_out`` (fold 0), ``score``, ``predicted``."""
    trees = fit(docs, labels, folds=folds, id_col=id_col, text_col=text_col)
    scored = classify(docs.select(id_col, text_col), trees, text_col).select(F.col(f"doc.{id_col}").alias(id_col), "score")
    return scored.select(id_col, (fold(F.col(id_col), folds) == 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
