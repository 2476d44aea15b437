"""Token-id output: one wavelet matrix per shard, each a file of its own.

Documents are put in order of their id by a range partitioning; each task encodes
its documents, fills shards with whole documents and writes every shard as one
file: ids and lengths of the documents, and the tokens as a wavelet matrix, from
which any token, the count of an id and all its places can be looked up.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from panelprep.llm.common import shared_path, text_or_empty
from panelprep.llm.encoding import encoder
from panelprep.llm.wavelet import WaveletMatrix

END_ID = 1
SHARD_TOKENS = 4_000_000

_SHARDS = "part int, seq int, n_docs long, n_tokens long, doc_ids binary, lengths binary, wavelet binary"


def write_shards(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes ``docs`` in ascending order of their id as wavelet shards under ``path``, one file a shard.

    A shard is closed by the first document with which it has ``shard_tokens``
    tokens, so documents stay whole.  A null text is empty and gives the end id
    alone; null ids come first; documents of one id go by the crc of their text,
    and equal rows stay as often as they are.  An empty table gives no shard.
    """

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seq = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        end = np.array([end_id], enc.dtype).tobytes()
        ids: list[int | None] = []
        chunks: list[bytes] = []
        size = 0

        def shard() -> pa.RecordBatch:
            tokens = np.frombuffer(b"".join(chunks), enc.dtype)
            lengths = np.array([len(c) for c in chunks], np.int64) // enc.dtype().itemsize
            known = np.array([i is not None for i in ids])
            numbers = np.array([i or 0 for i in ids], np.int64)
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(ids)]), pa.array([len(tokens)]),
                pa.array([np.packbits(known).tobytes() + numbers.tobytes()], pa.binary()), pa.array([lengths.tobytes()], pa.binary()),
                pa.array([WaveletMatrix.build(tokens, enc.bits).to_bytes()], pa.binary()),
            ], names=["part", "seq", "n_docs", "n_tokens", "doc_ids", "lengths", "wavelet"])

        for batch in batches:
            for i, tokens in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1).to_pylist())):
                chunks.append(tokens + end)
                ids.append(i)
                size += len(chunks[-1]) // enc.dtype().itemsize
                if size >= shard_tokens:
                    yield shard()
                    ids, chunks, size, seq = [], [], 0, seq + 1
        if ids:
            yield shard()

    text = text_or_empty(text_col).cast("binary")
    ordered = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text")).repartitionByRange(
        F.col("id"), F.crc32("text")).sortWithinPartitions(F.col("id"), F.crc32("text"))
    ordered.mapInArrow(fill, _SHARDS).write.option("maxRecordsPerFile", 1).option("compression", "uncompressed").parquet(path)


def read_documents(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """From the files: ``id, start, n_tokens, ids_crc32`` per document, with ``start`` counted over all shards before it."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = row["n_docs"]
                flags = -(-n // 8)
                known = np.unpackbits(np.frombuffer(row["doc_ids"][:flags], np.uint8), count=n).astype(bool)
                ids = np.frombuffer(row["doc_ids"][flags:], np.int64)
                ends = np.cumsum(np.frombuffer(row["lengths"], np.int64))
                matrix = WaveletMatrix.from_bytes(row["wavelet"])
                tokens = matrix.decode(np.uint16 if len(matrix.planes) <= 16 else np.uint32).astype("<u4")
                starts = np.concatenate((np.zeros(1, np.int64), ends[:-1]))
                view = memoryview(tokens).cast("B")
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, row["part"], np.int32)), pa.array(np.full(n, row["seq"], np.int32)),
                    pa.array(ids, mask=~known), pa.array(starts), pa.array(ends - starts), pa.array(crc, pa.int64()),
                ], names=["part", "seq", "id", "inside", "n_tokens", "ids_crc32"])

    shards = spark.read.schema(_SHARDS).parquet(path)
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    offsets = shards.select("part", "seq", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("offset"))
    documents = shards.mapInArrow(decode, "part int, seq int, id long, inside long, n_tokens long, ids_crc32 long")
    return documents.join(offsets, ["part", "seq"]).select(
        F.col("id").alias(id_col), (F.col("offset") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


class _Shard:
    """A shard's row: its documents' ids and ends, and its tokens, of which none is decoded before it's asked for."""

    def __init__(self, row: dict):
        flags = -(-row["n_docs"] // 8)
        known = np.unpackbits(np.frombuffer(row["doc_ids"][:flags], np.uint8), count=row["n_docs"]).astype(bool)
        self.ids = pa.array(np.frombuffer(row["doc_ids"][flags:], np.int64), mask=~known)
        self.ends = np.cumsum(np.frombuffer(row["lengths"], np.int64))
        self.matrix = WaveletMatrix.from_bytes(row["wavelet"])


def count_tokens(spark: SparkSession, path: str, tokens: Sequence[int]) -> DataFrame:
    """How often each of ``tokens`` is in the files: ``token, n``; two ranks a bit plane and shard, no decoding."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                matrix = _Shard(row).matrix
                n = [matrix.count(t) if 0 <= t < 1 << len(matrix.planes) else 0 for t in wanted]
                yield pa.RecordBatch.from_arrays([pa.array(wanted, pa.int64()), pa.array(n, pa.int64())], names=["token", "n"])

    wanted = sorted(set(tokens))
    asked = spark.createDataFrame([(t, 0) for t in wanted], "token long, n long")
    counted = spark.read.schema(_SHARDS).parquet(path).mapInArrow(count, "token long, n long")
    return counted.unionByName(asked).groupBy("token").agg(F.sum("n").alias("n"))


def find_tokens(spark: SparkSession, path: str, tokens: Sequence[int], id_col: str = "doc_id") -> DataFrame:
    """All places of ``tokens`` in the files: ``token, id, offset`` (in its document), by selecting up through the bit planes."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = _Shard(row)
                for token in wanted:
                    at = shard.matrix.occurrences(token) if 0 <= token < 1 << len(shard.matrix.planes) else np.zeros(0, np.int64)
                    doc = np.searchsorted(shard.ends, at, side="right")
                    begin = np.concatenate((np.zeros(1, np.int64), shard.ends[:-1]))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(at), token, np.int64)), shard.ids.take(pa.array(doc)), pa.array(at - begin[doc])], names=["token", "id", "offset"])

    wanted = sorted(set(tokens))
    found = spark.read.schema(_SHARDS).parquet(path).mapInArrow(find, "token long, id long, offset long")
    return found.withColumnRenamed("id", id_col)


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, **names: str) -> DataFrame:
    """Writes shards to the shared folder and reads the documents back from them."""
    spark = docs.sparkSession
    path = shared_path(spark, "tokens")
    write_shards(docs, path, tokenizer_path, end_id, **names)
    return read_documents(spark, path, names.get("id_col", "doc_id"))
