"""Helpers that several of the operators share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from panelprep.session import checkpoint_dir

# What operators keep in a worker process between tasks.  Workers are reused, so an
# operator that needs memory for itself drops what others have left.
_KEPT: list[dict] = []


def kept(cache: dict) -> dict:
    _KEPT.append(cache)
    return cache


def drop_kept() -> None:
    for cache in _KEPT:
        cache.clear()


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows one by one: those of a batch may be megabytes each."""
    for i in range(batch.num_rows):
        yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}


def release_memory() -> None:
    """Gives freed memory back: workers are reused, and what one task needed would stay theirs."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim is not None:
        trim(0)


WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: later reads don't run its plan once more."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return read_stored(df.sparkSession, path, df.schema)


def read_stored(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A table written to the shared folder; it can be discarded."""
    df = spark.read.schema(schema).parquet(path)
    df.stored_at = path
    return df


def discard(*frames: DataFrame) -> None:
    """Deletes stored tables that no plan reads any more."""
    for df in frames:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame, n: str, to: str) -> DataFrame:
    """``df`` with each row as often as its column ``n`` (1 or more) says, numbered from 0 in ``to``.

    A row becomes ranges of at most 4,096 numbers, which are dealt to all partitions
    before they become rows: a row that stands for a third of a table fills no task,
    and no array is longer than some thousands below 7 * 10^10 rows.
    """
    ranges, last = df, F.col(n) - 1
    for step in (1 << 24, 1 << 12):
        ends = F.lit(0).cast("long") if step > 1 << 12 else F.col("_from")
        until = last if step > 1 << 12 else F.least(last, F.col("_from") + ((1 << 24) - 1))
        ranges = ranges.withColumn("_from", F.explode(F.sequence(ends, until.cast("long"), F.lit(step).cast("long"))))
    ranges = ranges.repartition(F.xxhash64(*[c for c, kind in ranges.dtypes if kind in ("string", "bigint", "int", "double")]))
    return ranges.withColumn(to, F.explode(F.sequence(F.col("_from"), F.least(last, F.col("_from") + ((1 << 12) - 1))))).drop("_from")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def count_words(text: Column) -> Column:
    """Number of maximal runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
