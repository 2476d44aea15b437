"""Word chunks: documents of some megabytes as one row of packed arrays.

For jobs whose intermediate rows would be single words or word pairs.  A chunk has
its different words as sorted 64-bit hashes and its texts as numbers of those, so
that a job can send each word once a chunk, in blocks dealt by ranges of the hash,
and get an answer block of the same order back.  A block is a row: with more data
blocks get smaller until they hold one word, never more rows than words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from panelprep.llm.common import drop_kept, read_stored, shared_path

CHUNK_BYTES = 5 * 1024 * 1024
ROW_BYTES = 64  # what a text counts for besides its bytes, so that empty ones fill a chunk, too
BLOCK_WORDS = 1_200_000  # different words (or pairs) that one block group should have
END = 1  # hash of the token after the last word


def pack(values: np.ndarray) -> bytes:
    """zstd over the values' lowest bytes, then their second bytes and so on: small numbers take little room."""
    values = np.ascontiguousarray(values)
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(planes.reshape(size, len(planes) // size).T).view(dtype).reshape(-1)


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def write_chunks(docs: DataFrame, words_of: Callable[[bytes], list[bytes]], end: bool, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``docs`` has ``k`` (anything that identifies a row) and ``text`` (binary).

    Rows: ``chunk, n_tokens, ks`` (the documents' ``k``), ``lengths``, ``tokens`` and
    ``vocab`` (differences of the sorted hashes).  With ``end`` every document has
    one token more, with hash ``END``.  The table is written to the shared folder
    and read again, so chunk numbers are fixed whatever is recomputed later.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        part, seq = TaskContext.get().partitionId(), 0
        numbers, lengths, tokens, keys, size = _Numbers(), [], [], [], 0

        def chunk() -> pa.RecordBatch:
            hashes = np.fromiter((max(xxhash.xxh3_64_intdigest(w), 2) if w else END for w in numbers), np.uint64, len(numbers))
            order = np.argsort(hashes)
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            local = rank[np.concatenate(tokens)] if tokens else np.zeros(0, np.uint32)
            ks = pa.concat_arrays(keys)
            return pa.RecordBatch.from_arrays([
                pa.array([(part << 32) + seq], pa.int64()), pa.array([len(local)], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(ks)], pa.int32()), ks), pa.array([pack(np.array(lengths, np.int64))], pa.binary()),
                pa.array([pack(local)], pa.binary()), pa.array([pack(np.diff(hashes[order], prepend=np.uint64(0)))], pa.binary()),
            ], names=["chunk", "n_tokens", "ks", "lengths", "tokens", "vocab"])

        for batch in batches:
            at = 0
            for i, text in enumerate(batch.column(1).to_pylist()):
                words = words_of(text)
                if end:
                    words.append(b"")
                tokens.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
                lengths.append(len(words))
                size += len(text) + ROW_BYTES
                if size >= chunk_bytes:
                    keys.append(batch.column(0).slice(at, i + 1 - at))
                    at = i + 1
                    yield chunk()
                    numbers, lengths, tokens, keys, size, seq = _Numbers(), [], [], [], 0, seq + 1
            if at < batch.num_rows:
                keys.append(batch.column(0).slice(at))
        if lengths:
            yield chunk()

    schema = docs.limit(0).select(
        F.lit(0).cast("long").alias("chunk"), F.lit(0).cast("long").alias("n_tokens"), F.array("k").alias("ks"),
        F.lit(b"").alias("lengths"), F.lit(b"").alias("tokens"), F.lit(b"").alias("vocab")).schema
    path = shared_path(docs.sparkSession, "chunks")
    docs.select("k", "text").mapInArrow(build, schema).write.option("compression", "uncompressed").parquet(path)
    return read_stored(docs.sparkSession, path, schema)


def hashes_of(row: dict) -> np.ndarray:
    return np.cumsum(unpack(row["vocab"], np.uint64), dtype=np.uint64)


def block_count(total: int, words: int = BLOCK_WORDS) -> int:
    return max(1, -(-total // words))


def block_of(hashes: np.ndarray, blocks: int) -> np.ndarray:
    """Range of the 64-bit hash, by its upper half."""
    return ((hashes >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)


def cuts(block: np.ndarray) -> list[tuple[int, int, int]]:
    """``(block, start, end)`` of each run in a sorted array."""
    if not len(block):
        return []
    starts = np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1))
    ends = np.concatenate((starts[1:], [len(block)]))
    return list(zip(block[starts].astype(np.int64).tolist(), starts.tolist(), ends.tolist()))


def word_blocks(chunks: DataFrame, blocks: int, counts_of: Callable[[dict, int], np.ndarray]) -> DataFrame:
    """Each chunk's words in blocks: ``block, chunk, keys, counts``; ``counts_of`` gives a count per word of a chunk."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes = hashes_of(row)
                counts = counts_of(row, len(hashes)).astype(np.uint32)
                runs = cuts(block_of(hashes, blocks))
                yield pa.RecordBatch.from_arrays([
                    pa.array([b for b, _, _ in runs], pa.int64()), pa.array([row["chunk"]] * len(runs), pa.int64()),
                    pa.array([pack(hashes[a:z]) for _, a, z in runs], pa.binary()),
                    pa.array([pack(counts[a:z]) for _, a, z in runs], pa.binary())], names=["block", "chunk", "keys", "counts"])

    return chunks.mapInArrow(send, "block long, chunk long, keys binary, counts binary")


def summed_words(sent: DataFrame, blocks: int) -> DataFrame:
    """Sums the counts of each word over all chunks and answers every block.

    Rows with ``chunk`` null are the table: per block its ``keys`` and ``counts``.
    The others answer a chunk's block in the order of its words: ``keys`` are
    numbers, one for each word, from 1 and unique over all blocks, and ``counts``.
    """

    def add(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        block = rows[0]["block"]
        keys = [unpack(r["keys"], np.uint64) for r in rows]
        words, which = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(which, np.concatenate([unpack(r["counts"], np.uint32) for r in rows]), len(words)).astype(np.int64)
        out = {"block": [block], "chunk": [None], "keys": [pack(words)], "counts": [pack(total)]}
        at = 0
        for row, part in zip(rows, keys):
            mine = which[at : at + len(part)]
            at += len(part)
            for name, value in zip(out, (block, row["chunk"], pack(mine * blocks + block + 1), pack(total[mine]))):
                out[name].append(value)
        return pa.table(out, schema=pa.schema([("block", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]))

    return sent.groupBy("block").applyInArrow(add, "block long, chunk long, keys binary, counts binary")


def answered(chunks: DataFrame, answers: DataFrame, columns: list[str], to: str) -> DataFrame:
    """Chunks with their answers as an array of ``(block, columns)``, in the order of the blocks."""
    lists = answers.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("block", *columns))).alias(to))
    return chunks.join(lists, "chunk", "left")


def joined_answer(answers: list[dict] | None, column: str, dtype) -> np.ndarray:
    return np.concatenate([unpack(a[column], dtype) for a in answers]) if answers else np.zeros(0, dtype)
