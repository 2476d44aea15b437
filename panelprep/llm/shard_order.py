"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Every row gets a number from 0 to N-1 that depends on the rows alone, not on
files or tasks: rows are dealt to blocks by a digest of their identity, block
sizes are summed up, and a row's number is its block's offset plus its place in
the block.  A keyed Feistel network permutes the numbers; the permuted number p
gives shard ``p mod shards`` and slot ``p div shards``, so shards differ by one
row at most and slots have no gaps.  Anyone who has N, the seed and a row number
can compute shard and slot without a lookup, and the other way round.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from panelprep.llm.common import spread

ROUNDS = 6


def _draw(value: Column, round_no: Column, seed: int) -> Column:
    """48 pseudo-random bits of (seed, round, value)."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), round_no.cast("string"), value.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")


def feistel(number: Column, left: int, right: int, seed: int) -> Column:
    """Permutes 0 … left*right-1: an unbalanced Feistel network whose rounds alternate between the two moduli."""
    start = F.struct(F.floor(number / F.lit(right)).cast("long").alias("a"), F.pmod(number, F.lit(right)).cast("long").alias("b"))
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start,
        lambda s, r: F.struct(s["b"].alias("a"), F.pmod(
            s["a"] + _draw(s["b"], r, seed), F.when(r % 2 == 0, F.lit(left)).otherwise(F.lit(right))).cast("long").alias("b")),
        lambda s: s["a"] * F.lit(right) + s["b"])


def halves(rows: int) -> tuple[int, int]:
    """The two moduli: their product is at least ``rows`` and exceeds it by less than the larger one."""
    right = max(1, math.isqrt(max(rows - 1, 0)) + 1)
    return max(1, -(-rows // right)), right


def _walk(number: Column, rows: int, left: int, right: int, seed: int, steps: int) -> tuple[Column, Column]:
    """The first image, and from it (as column ``_first``) the first image below ``rows`` within ``steps`` more."""
    first = feistel(number, left, right, seed)
    more = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.col("_first"), lambda p, _: F.when(p < rows, p).otherwise(
        feistel(p, left, right, seed)))
    return first, F.when(F.col("_first") < rows, F.col("_first")).otherwise(more)


def walk_steps(spark: SparkSession, rows: int, seed: int) -> int:
    """Enough steps for every row: measured over the numbers beyond ``rows``, which any walk must pass through."""
    left, right = halves(rows)
    if rows == 0 or left * right == rows:
        return 1
    steps = 8
    while True:
        first, rest = _walk(F.col("id"), rows, left, right, seed, steps)
        beyond = spark.range(rows, left * right).withColumn("_first", first).select(rest.alias("p"))
        if not beyond.where(F.col("p") >= rows).head(1):
            return steps + 1
        steps *= 2


def permuted(df: DataFrame, number: str, rows: int, seed: int, to: str = "position") -> DataFrame:
    """``df`` with the place of each row in the shuffle."""
    left, right = halves(rows)
    first, rest = _walk(F.col(number), rows, left, right, seed, walk_steps(df.sparkSession, rows, seed))
    return df.withColumn("_first", first).withColumn(to, rest).drop("_first")


def shard_plan(docs: DataFrame, shards: int, seed: int = 20, id_col: str = "doc_id", text_col: str = "text",
               blocks: int = 4096) -> DataFrame:
    """A row per input row: ``id, size, text_crc32, law, shard, slot, grown_shard``.

    ``size`` is the UTF-8 length of the text plus 8, ``law`` is ``rows`` (shard
    sizes at most one row apart) and ``grown_shard`` is null, as another shard
    would move all rows.  A null text counts as empty, a null id is an id of its
    own; rows equal in id, size and crc get consecutive numbers, so which of them
    is which makes no difference.  An empty table gives no rows; other columns
    are ignored.  Equal rows are counted before the shuffle and become rows again
    in ranges dealt to all tasks, so no group of copies meets in one.  ``blocks`` only bounds how
    many rows are sorted together; at 10^11 rows a block has 25 million.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    keys = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    rows = docs.count()
    block = F.pmod(F.conv(F.substring(F.md5(F.concat_ws(
        ":", F.coalesce(F.col("id").cast("string"), F.lit("-")), "size", "text_crc32").cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(blocks))
    equal = keys.groupBy("id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n")).withColumn("block", block)
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = equal.groupBy("block").agg(F.sum("n").alias("rows")).select(  # at most `blocks` rows
        "block", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("block").orderBy("id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    placed = equal.withColumn("place", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    numbered = spread(placed.join(F.broadcast(offsets), "block", "left").select(
        "id", "size", "text_crc32", "n", (F.col("offset") + F.col("place")).alias("first")), "n", "j").withColumn("number", F.col("first") + F.col("j"))
    return permuted(numbered, "number", rows, seed).select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"),
        F.pmod("position", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("position") / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
