"""Set operations, first-of-key, top-k, stable sort and in-group numbering."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelprep.session import durable

Order = Sequence[Column | str]


def stack(frames: Iterable[DataFrame]) -> DataFrame:
    """Union all by name; a column that a frame lacks is null there."""
    frames = list(frames)
    if not frames:
        raise ValueError("nothing to stack")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def top_k(df: DataFrame, keys: Sequence[str], order: Order, k: int, rank: str | None = None) -> DataFrame:
    """First ``k`` rows per key in ``order``.

    Spark limits each key to ``k`` rows within every map task before the shuffle
    (``WindowGroupLimit``), so a hot key arrives as k rows per task.
    """
    name = rank or "_rank"
    window = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)
    return out if rank else out.drop(name)


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """The first row of each key in ``order``."""
    return top_k(df, keys, order, 1)


def stable_sort(df: DataFrame, *order: Column | str) -> DataFrame:
    """Global sort; give a unique last column for a repeatable order."""
    return df.orderBy(*order)


def numbered(df: DataFrame, keys: Sequence[str], order_col: str, name: str) -> DataFrame:
    """1-based position of each row within its key, by a unique column.

    A key may hold any share of the rows: they're dealt to partitions by ranges of
    (key, order), so its rows are neighbours, and only counts, one row per key and
    partition, are ever put in one group by key.  The sorted rows are written to
    the shared folder once, as both the counts and the rows are read from them.
    """
    # One struct key: equality on it treats nulls as equal.
    dealt = df.withColumn("_key", F.struct(*keys)).repartitionByRange("_key", order_col).sortWithinPartitions("_key", order_col)
    placed = durable(dealt.withColumn("_row", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_row", 33))
    runs = placed.groupBy("_key", "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = runs.select("_key", "_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_before"))
    return placed.join(before, ["_key", "_part"]).select(*df.columns, (F.col("_row") + F.col("_before")).alias(name))
