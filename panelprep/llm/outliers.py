"""Quality rules by robust multivariate outliers.

Fixed rules first (too few words, too much repetition).  Of the texts that pass,
a vector of transformed statistics is compared with its language and source: the
minimum-covariance-determinant estimate takes the mean and covariance of the
three quarters of a group that lie closest together, found by concentration
steps from three starts, of which the one with the smallest determinant counts.
A text whose Mahalanobis distance is beyond the chi-square quantile is rejected.

One step is one pass for all starts: distances under the present estimate fall into fixed
logarithmic bins, and each bin carries its count and moments, so the quantile
and the new estimate come from a table of bins.  No group's rows meet anywhere.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from panelprep.llm.common import stored, text_or_empty

LEAST_WORDS = 50
CENTRE = 0.75  # share of a group that the estimate is made from
LEAST_ROWS = 50  # a smaller group is pooled with the others of its language, then with all
FIRST_STEPS, MOST_STEPS = 3, 25  # of all starts, and at most of the best one, which goes on until
SETTLED = 0.01  # the logarithm of its determinant falls by less in every group
TAIL = 1e-6  # share of normally distributed vectors that lie beyond the cutoff
BINS = 1024
FEW_GROUPS = 50_000  # estimates of so many groups, some 400 bytes each, are sent to all tasks
# Statistic and the standard deviation that is always allowed: most texts have no symbols or repeated lines at all,
# and without a floor the tightest three quarters would have no spread there.
VECTOR = {"word_length": 0.05, "symbols": 0.3, "marks": 0.3, "upper": 0.3, "repeats": 0.3, "lines": 0.3, "digits": 0.3, "distinct": 0.05}
_GRID = 0.01


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[list(chars)] = 1
    return out


_COUNTS = np.stack([
    1 - _class(bytes(range(128, 192))), _class(b" \t\n\v\f\r"), _class(b"#*$%&|<>"), _class(b"!"), _class(bytes(range(65, 91))), _class(b"0123456789"),
], axis=1)


def repeated_words(numbers: np.ndarray, kinds: int) -> int:
    """Words covered by 3-word windows that occur twice or more."""
    n = len(numbers)
    if n < 4:
        return 0
    pairs = numbers[:-1] * kinds + numbers[1:]
    if kinds > 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, which, count = np.unique(pairs[:-1] * kinds + numbers[2:], return_inverse=True, return_counts=True)
    often = count[which] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= often
    return int(covered.sum())


def base_statistics(text: bytes) -> tuple[int, int, int, int, int, list[float]]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and the vector; an empty text has zeros."""
    words = text.split()
    n = len(words)
    points, spaces, symbols, marks, upper, digits = (np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _COUNTS).tolist()
    chars = points - spaces
    numbers: dict[bytes, int] = {}
    coded = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    repeats = repeated_words(coded, len(numbers))
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    again = len(lines) - len(set(lines))
    if not n:
        return 0, chars, symbols, again, repeats, [0.0] * len(VECTOR)
    share = lambda scale, a, b: math.asinh(scale * a / max(b, 1))
    return n, chars, symbols, again, repeats, [
        math.log(max(chars, 1) / n), share(20, symbols, n), share(20, marks, n), share(20, upper, chars), share(20, repeats, n),
        share(10, again, len(lines)), share(20, digits, chars), math.log(len(numbers) / n * max(n, 2) ** 0.1)]


_BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_cols: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """Per row: id, ``cell`` (its language and source, nulls told from empty), the base statistics, and ``z``."""
    cell = F.to_json(F.struct(*[F.col(c).cast("string").alias(str(i)) for i, c in enumerate(group_cols)]))
    lang = F.to_json(F.struct(F.col(group_cols[0]).cast("string").alias("0")))
    packed = docs.select(F.struct(F.col(id_col).alias("id"), cell.alias("cell"), lang.alias("wide")).alias("k"),
                         text_or_empty(text_col).cast("binary").alias("text"))
    schema = packed.select("k").schema.simpleString()[len("struct<"):-1].replace("k:", "k ", 1)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["k", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "z"]
        for batch in batches:
            columns = list(zip(*map(base_statistics, batch.column(1).to_pylist()))) or [()] * 6
            arrays = [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(columns[5], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)

    measured = packed.mapInArrow(measure, f"{schema}, {_BASE}, z array<double>")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.select(F.col("k.id").alias("id"), "k.cell", "k.wide", *[c.split()[0] for c in _BASE.split(", ")], "z").withColumn("base_failed", failed)


def _groups(rows: DataFrame) -> DataFrame:
    """``cell`` to the group that judges it: its own, its language's small ones, all small ones, or none (null).

    Without a source a cell reads as its language does, so names begin with their kind.
    """
    cells = rows.where("not base_failed").groupBy("cell", "wide").count()
    wide = cells.where(F.col("count") < LEAST_ROWS).groupBy("wide").agg(F.sum("count").alias("wide_count"))
    named = cells.join(wide, "wide", "left").withColumn("group", F.when(F.col("count") >= LEAST_ROWS, F.concat(F.lit("cell "), "cell")).when(
        F.col("wide_count") >= LEAST_ROWS, F.concat(F.lit("wide "), "wide")).otherwise(F.lit("*")))
    rest = named.where("group = '*'").select(F.sum("count")).scalar()
    return named.select("cell", F.when((F.col("group") != "*") | (rest >= LEAST_ROWS), F.col("group")).alias("group"))


def _beyond(x: float, freedom: int) -> float:
    """Share of a chi-square distribution with an even number of degrees of freedom beyond ``x``."""
    return math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(freedom // 2))


def chi_square(beyond: float, freedom: int) -> float:
    """The value that this share lies beyond."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if _beyond(middle, freedom) > beyond else (low, middle)
    return low


def _consistency(share: float, size: int) -> float:
    """What the covariance of the central share of a normal distribution in ``size`` (even) dimensions is too small by."""
    return share / (1 - _beyond(chi_square(1 - share, size), size + 2))


_ESTIMATE = "group string, start int, mean array<double>, root array<double>, logdet double"
_FLOORS = np.array(list(VECTOR.values()))
_SIZE = len(VECTOR)
_LOWER = [(i, j) for i in range(_SIZE) for j in range(i + 1)]


def _start(rows: DataFrame) -> DataFrame:
    """First estimates, from a histogram of fixed width of each statistic: median and quartile range, mean and deviation, median and 1."""
    bins = rows.select("group", F.posexplode("z").alias("axis", "value")).groupBy(
        "group", "axis", F.round(F.col("value") / _GRID).cast("int").alias("bin")).count()

    def estimate(key: tuple, bins: pd.DataFrame) -> pd.DataFrame:
        bins = bins.sort_values(["axis", "bin"])
        mean, spread = np.zeros((3, _SIZE)), np.ones((3, _SIZE))
        for axis, part in bins.groupby("axis"):
            total, value = part["count"].cumsum().to_numpy(), part["bin"].to_numpy() * _GRID
            low, middle, high = value[np.searchsorted(total, total[-1] * np.array([0.25, 0.5, 0.75]))]
            average = np.average(value, weights=part["count"])
            mean[:, axis] = middle, average, middle
            spread[:2, axis] = (high - low) / 1.349, math.sqrt(np.average((value - average) ** 2, weights=part["count"]))
        roots = [np.diag(1 / np.sqrt(s**2 + _FLOORS**2)) for s in spread]
        return pd.DataFrame({"group": [key[0]] * 3, "start": range(3), "mean": mean.tolist(),
                             "root": [[r[i, j] for i, j in _LOWER] for r in roots], "logdet": [math.inf] * 3})

    return bins.groupBy("group").applyInPandas(estimate, _ESTIMATE)


def _distance() -> Column:
    """Squared Mahalanobis distance; ``root`` is the lower triangle of the inverse Cholesky factor."""
    off = [F.col("z")[i] - F.col("mean")[i] for i in range(_SIZE)]
    at = {pair: k for k, pair in enumerate(_LOWER)}
    parts = [reduce(add, [F.col("root")[at[i, j]] * off[j] for j in range(i + 1)]) for i in range(_SIZE)]
    return reduce(add, [p * p for p in parts])


def _step(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """One concentration step of all starts."""
    placed = rows.join(estimate.drop("logdet"), "group").withColumn("d", _distance())
    at = F.floor(F.log2(F.greatest("d", F.lit(1e-6))) * 24 + 480)
    moments = [F.sum(F.col("z")[i]).alias(f"s{i}") for i in range(_SIZE)] + [
        F.sum(F.col("z")[i] * F.col("z")[j]).alias(f"q{i}_{j}") for i, j in _LOWER]
    bins = placed.groupBy("group", "start", F.least(F.greatest(at, F.lit(0)), F.lit(BINS - 1)).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), *moments)
    factor = _consistency(CENTRE, _SIZE)

    def estimate_of(key: tuple, bins: pd.DataFrame) -> pd.DataFrame:
        bins = bins.sort_values("bin")
        total = bins["n"].cumsum().to_numpy()
        inner = bins.iloc[: int(np.searchsorted(total, math.ceil(CENTRE * total[-1]))) + 1]
        n = inner["n"].sum()
        mean = np.array([inner[f"s{i}"].sum() for i in range(_SIZE)]) / n
        spread = np.zeros((_SIZE, _SIZE))
        for i, j in _LOWER:
            spread[i, j] = spread[j, i] = inner[f"q{i}_{j}"].sum() / n - mean[i] * mean[j]
        lower = np.linalg.cholesky(spread * factor + np.diag(_FLOORS**2))
        root = np.linalg.inv(lower)
        return pd.DataFrame({"group": [key[0]], "start": [key[1]], "mean": [mean.tolist()], "root": [[root[i, j] for i, j in _LOWER]],
                             "logdet": [2 * float(np.log(lower.diagonal()).sum())]})

    return bins.groupBy("group", "start").applyInPandas(estimate_of, _ESTIMATE)


def fit(vectors: DataFrame) -> DataFrame:
    """Of vectors (``group, z``) the estimate of each group: ``group, mean, root``.

    All starts take a few steps; each group's best one goes on until it's settled.
    Whole bins are let in, so a step may raise a determinant; then the estimate before stays.
    """
    estimate = stored(_start(vectors), "estimate0")
    near = F.broadcast if estimate.count() <= 3 * FEW_GROUPS else lambda df: df
    lowest = F.min_by(F.struct("start", "mean", "root", "logdet"), F.struct("logdet", "start")).alias("lowest")
    for step in range(1, MOST_STEPS + 1):
        better = _step(vectors, near(estimate)).unionByName(estimate)
        better = better.groupBy("group", *["start"] * (step < FIRST_STEPS)).agg(lowest).select("group", "lowest.*")
        better = stored(better, f"estimate{step}")
        before = estimate.select("group", "start", F.col("logdet").alias("before"))
        moved = better.join(before, ["group", "start"]).select(F.max(F.col("before") - F.col("logdet"))).first()[0]
        estimate = better
        if step >= FIRST_STEPS and (moved is None or moved < SETTLED):
            break
    return near(estimate.select("group", "mean", "root"))


def judge(docs: DataFrame, tail: float = TAIL, id_col: str = "doc_id", text_col: str = "text",
          group_cols: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """A row per input row: id, base statistics, ``base_failed``, ``distance``, ``kept``.

    ``distance`` is null where the base rules fail or where even all small groups
    together are too few to estimate from; such texts are kept if the base rules
    allow.  A null or empty text has no words and fails.  Null languages and
    sources are groups like any other.  Repeated rows count as often as they are
    there and are judged alike; an empty table gives no rows; other columns of any
    name are ignored.  ``tail`` is the share of normal vectors beyond the cutoff.
    """
    cutoff = math.sqrt(chi_square(tail, _SIZE))
    rows = stored(text_statistics(docs, id_col, text_col, group_cols), "statistics")
    groups = stored(_groups(rows), "groups")
    grouped = rows.join(F.broadcast(groups) if groups.count() <= FEW_GROUPS else groups, "cell", "left")
    fitted = stored(grouped.where("not base_failed and group is not null").select("group", "z"), "vectors")
    estimate = fit(fitted)
    judged = grouped.join(estimate, "group", "left").withColumn(
        "distance", F.when(~F.col("base_failed"), F.sqrt(_distance())))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    return judged.select(F.col("id").alias(id_col), *[c.split()[0] for c in _BASE.split(", ")], "base_failed", "distance", kept.alias("kept"))
