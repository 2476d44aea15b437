"""Removal of byte strings that occur twice or more anywhere in a corpus.

Every 200-byte window belongs to one anchor, the leftmost of its positions whose
short substring has the smallest hash.  That depends on the window alone, so equal
windows have equal anchors, and windows need to be compared within anchors only.
The windows of one occurrence of an anchor lie together in a segment of the text:

* an anchor that occurs once has no repeated window;
* an anchor all of whose segments are equal repeats in all its windows;
* segments of any other anchor are gathered by the anchor's hash.  Over some
  megabytes of them the Burrows-Wheeler transform is built and expanded breadth
  first: intervals of strings of length l, extended by one byte to the left, give
  the boundaries with a longest common prefix of l.  After 200 levels, boundaries
  still without one separate suffixes that agree in 200 bytes or more; a run of
  these with two windows or more repeats.
* an anchor with very many different segments would fill a task.  Its windows are
  split into parts by how far behind their start the anchor lies; all windows of a
  part share more bytes round the anchor, and these are the part's anchor.  Parts
  with very many different segments are split again: at the end a window is an
  anchor of its own.

Texts are read once into chunks of some megabytes; anchors and their answers
travel as packed blocks (see :mod:`panelprep.llm.chunks`).
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from panelprep.llm.chunks import ROW_BYTES, answered, block_count, block_of, cuts, joined_answer, pack, unpack
from panelprep.llm.common import discard, release_memory, rows_of, shared_path, stored, text_or_empty

LENGTH = 200
GRAM = 100  # bytes of the substrings that anchors are chosen from
RANGE_BYTES = 500_000  # of segments that one transform should have
CHUNK_BYTES = 1024 * 1024  # a packed chunk should be well under half a region of the heap
BLOCK_ANCHORS = 500_000
WAYS = 5  # that a segment's windows are split
MANY = 2_000  # different segments of an anchor beyond which its windows are split

_PIECE = 1 << 16  # windows that are gone through at a time
_BASE = 0x9E3779B97F4A7C15


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number for each byte value, and powers of the base and of its inverse."""
    rng = np.random.default_rng(6)
    size = _PIECE + 4096
    powers = [np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(size, b, np.uint64)))) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    return rng.integers(1, 1 << 63, 256, np.uint64), *powers


_VALUE, _POWER, _INVERSE = _tables()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    done, out = 1, x
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out


def segments(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of texts put end to end: anchor, digest of the segment, first and last window, and the anchor's place, for all windows within a text, in order."""
    ends = ends[np.diff(ends, prepend=0) > 0]
    parts = [(np.zeros(0, np.uint64), np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))]
    for start in range(0, len(data) - length + 1, _PIECE):
        windows = min(_PIECE, len(data) - length + 1 - start)
        part = data[start : start + windows + length - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_VALUE[part] * _POWER[: len(part)], out=sums[1:])
        grams = _mix((sums[gram:] - sums[:-gram]) * _INVERSE[: len(part) - gram + 1])
        packed = (grams >> np.uint64(20) << np.uint64(20)) | np.arange(len(grams), dtype=np.uint64)
        anchor = (_sliding_min(packed, length - gram + 1) & np.uint64((1 << 20) - 1)).astype(np.int64)
        at = np.arange(start, start + windows)
        inside = ends[np.searchsorted(ends, at, side="right")] >= at + length
        first = np.concatenate(([0], np.flatnonzero((np.diff(anchor) != 0) | (inside[1:] != inside[:-1])) + 1))
        last = np.concatenate((first[1:] - 1, [windows - 1]))
        first, last = first[inside[first]], last[inside[first]]
        content = _mix((sums[last + length] - sums[first]) * _INVERSE[first] + (last - first).astype(np.uint64))
        # anchors have small hashes: mixed again, they spread over all blocks
        parts.append((_mix(grams[anchor[first]] + np.uint64(_BASE)), content, first + start, last + start, anchor[first] + start))
    return tuple(np.concatenate(p) for p in zip(*parts))


def sorted_suffixes(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Suffixes in the order of their first ``length`` symbols at least, by prefix doubling.

    Also the common prefix with the suffix before, as far as the first key tells,
    and how many symbols that key had.
    """
    n = len(symbols)
    bits = int(symbols.max()).bit_length()
    step = first = 62 // bits
    key = np.zeros(n, np.int64)
    for k in range(first):
        key <<= bits
        key[: max(n - k, 0)] |= symbols[k:]
    order = np.argsort(key).astype(np.int32)
    key = key[order]
    change = key[1:] ^ key[:-1]
    common = np.zeros(n, np.uint8)
    for k in range(1, first + 1):
        common[1:] += change < 1 << (bits * (first - k))
    del change
    rank = np.empty(n, np.int32)
    while True:
        rank[order] = np.cumsum(np.concatenate(([False], key[1:] != key[:-1])), dtype=np.int32)
        if step >= length or rank[order[-1]] == n - 1:
            return order, common, first
        key = rank.astype(np.int64)
        key *= n + 1
        key[: max(n - step, 0)] += rank[step:]
        key[: max(n - step, 0)] += 1
        order = np.argsort(key).astype(np.int32)
        key = key[order]
        step *= 2


def long_prefixes(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array, and for each of its places whether it agrees with the one before in ``length`` symbols or more.

    The last symbol is 0 and the only one, 1 ends a text.  Strings that hold an end
    are only of use with the end at their right, so no string is extended by one.
    The first levels are read off the sort's first key.
    """
    n = len(symbols)
    sa, common, level = sorted_suffixes(symbols, length)
    level = min(level, length)
    bwt = symbols[sa - 1]
    to = np.empty(n, np.int32)  # where each place's suffix, extended by the symbol to its left, stands
    to[np.argsort(bwt, kind="stable")] = np.arange(n, dtype=np.int32)
    unset = np.append(common >= level, False)  # no common prefix length known yet at the boundary before a place
    unset[0] = False
    edges = np.flatnonzero(~unset).astype(np.int32)
    low, high = edges[:-1], edges[1:]  # half-open intervals of the strings of this level, those with a new boundary at their end
    new = np.append(common, np.uint8(255))[high] == level - 1
    low, high = low[new], high[new]
    while level < length and len(low):
        sizes = high - low
        of = np.repeat(np.arange(len(low), dtype=np.int32), sizes)
        place = np.arange(len(of), dtype=np.int32) + np.repeat(low - (np.cumsum(sizes, dtype=np.int32) - sizes), sizes)
        symbol = bwt[place]
        more = symbol > 1
        # strings longer by one: of one interval, the places with one symbol to the left lead to neighbours
        place, key = place[more], of[more].astype(np.int64)
        key <<= 9
        key |= symbol[more]
        order = np.argsort(key, kind="stable")
        key, target = key[order], to[place[order]]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        last = np.append(first[1:], len(key))[: len(first)] - 1
        low, high = target[first], target[last] + 1
        fresh = unset[high]
        unset[high] = False
        low, high = low[fresh], high[fresh]
        level += 1
    return sa, unset[:n]


def repeated_windows(texts: list[bytes], weights: list[int], length: int) -> list[np.ndarray]:
    """Which windows of each segment occur in it or others again; one of weight 2 or more repeats by itself."""
    sizes = np.array([len(t) + 1 for t in texts])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    symbols = np.frombuffer(b"\x00".join(texts) + b"\x00\x00", np.uint8).astype(np.uint16) + np.uint16(2)
    symbols[ends - 1], symbols[-1] = 1, 0  # 1 ends a segment, 0 the whole
    sa, same = long_prefixes(symbols, length)
    known = np.zeros(len(symbols), np.uint8)  # weights of whole windows
    for a, b, weight in zip(starts.tolist(), ends.tolist(), weights):
        known[a : max(a, b - length)] = min(weight, 2)
    known = known[sa]
    run = np.cumsum(~same, dtype=np.int32) - 1
    repeated = np.zeros(len(symbols), bool)
    repeated[sa] = (np.bincount(run, known)[run] >= 2) & (known > 0)
    return [repeated[a : max(a, b - length)] for a, b in zip(starts.tolist(), ends.tolist())]


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _text_chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """``docs`` (``id``, ``text``) as rows ``chunk, ids, lengths, text``, texts put end to end."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0

        def chunk() -> pa.RecordBatch:
            held = pa.concat_arrays(ids)
            return pa.RecordBatch.from_arrays([
                pa.array([(part << 32) + seq]), pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held),
                pa.array([pack(np.array([len(t) for t in texts], np.int64))], pa.binary()),
                pa.array([zstandard.ZstdCompressor(level=1).compress(b"".join(texts))], pa.binary())], names=["chunk", "ids", "lengths", "text"])

        for batch in batches:
            at = 0
            for i, text in enumerate(batch.column(1)):
                texts.append(text := text.as_py())
                size += len(text) + ROW_BYTES
                if size >= chunk_bytes:
                    ids.append(batch.column(0).slice(at, i + 1 - at))
                    at = i + 1
                    yield chunk()
                    ids, texts, size, seq = [], [], 0, seq + 1
                    release_memory()
            if at < batch.num_rows:
                ids.append(batch.column(0).slice(at))
        if texts:
            yield chunk()

    schema = docs.limit(0).select(F.lit(0).cast("long").alias("chunk"), F.array("id").alias("ids"), F.lit(b"").alias("lengths"), F.lit(b"").alias("text")).schema
    path = shared_path(docs.sparkSession, "text_chunks")
    docs.select("id", "text").mapInArrow(build, schema).write.option("compression", "uncompressed").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


class _Chunk:
    def __init__(self, row: dict):
        self.bytes = zstandard.ZstdDecompressor().decompress(row["text"])
        self.data = np.frombuffer(self.bytes, np.uint8)
        self.ends = np.cumsum(unpack(row["lengths"], np.int64))

    def find(self, length: int, gram: int) -> None:
        """Segments in the order of anchor and content; ``first_of`` marks the first of equal ones, ``entry`` that of an anchor."""
        anchor, content, first, last, at = segments(self.data, self.ends, length, gram)
        order = np.lexsort((content, anchor))
        self.anchor, self.content, self.first, self.last, self.at = (x[order] for x in (anchor, content, first, last, at))
        self.entry = np.ones(len(order), bool)
        self.entry[1:] = self.anchor[1:] != self.anchor[:-1]
        self.first_of = self.entry.copy()
        self.first_of[1:] |= self.content[1:] != self.content[:-1]


_NONE, _EQUAL, _MIXED, _MANY = range(4)


def _anchor_answers(chunks: DataFrame, blocks: int, length: int, gram: int, many: int) -> DataFrame:
    """For each chunk's anchors, in order: occurs once, all its segments equal, different ones, or very many different ones."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                chunk = _Chunk(row)
                chunk.find(length, gram)
                at = np.flatnonzero(chunk.entry)
                if not len(at):
                    continue
                anchor = chunk.anchor[at]
                kinds, count = np.add.reduceat(chunk.first_of.astype(np.int64), at), np.diff(at, append=len(chunk.anchor))
                out = [(block, row["chunk"], pack(np.diff(anchor[a:z], prepend=np.uint64(0))), pack(chunk.content[at[a:z]]),
                        pack(kinds[a:z].astype(np.uint32)), pack(count[a:z].astype(np.uint32))) for block, a, z in cuts(block_of(anchor, blocks))]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [pa.int64()] * 2 + [pa.binary()] * 4)],
                                                 names=["block", "chunk", "anchors", "contents", "kinds", "counts"])

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        anchors = [np.cumsum(unpack(r["anchors"], np.uint64), dtype=np.uint64) for r in rows]
        contents = np.concatenate([unpack(r["contents"], np.uint64) for r in rows])
        kinds = np.concatenate([unpack(r["kinds"], np.uint32) for r in rows])
        known, which = np.unique(np.concatenate(anchors), return_inverse=True)
        total = np.bincount(which, np.concatenate([unpack(r["counts"], np.uint32) for r in rows]))
        different = np.bincount(which, kinds)
        some = np.empty(len(known), np.uint64)
        some[which] = contents
        mixed = np.bincount(which, (kinds > 1) | (contents != some[which])) > 0
        code = np.where(total < 2, _NONE, np.where(~mixed, _EQUAL, np.where(different > many, _MANY, _MIXED))).astype(np.uint8)
        ends = np.cumsum([len(a) for a in anchors])
        return pa.table([table.column("block"), table.column("chunk"), pa.array([pack(code[which[z - len(a) : z]]) for a, z in zip(anchors, ends)], pa.binary())],
                        names=["block", "chunk", "codes"])

    sent = chunks.mapInArrow(send, "block long, chunk long, anchors binary, contents binary, kinds binary, counts binary")
    return sent.groupBy("block").applyInArrow(answer, "block long, chunk long, codes binary")


_FOUND = "chunk long, starts binary, ends binary, anchor long, content long, weight long, many boolean, first long, at long, data binary"


def _first_findings(joined: DataFrame, length: int, gram: int) -> DataFrame:
    """Windows that certainly repeat (``starts, ends``), and the segments that have to be compared (``data``)."""
    names = [c.split()[0] for c in _FOUND.split(", ")]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                chunk = _Chunk(row)
                chunk.find(length, gram)
                code = joined_answer(row["codes"], "codes", np.uint8)[np.cumsum(chunk.entry) - 1] if len(chunk.anchor) else np.zeros(0, np.uint8)
                weight = np.diff(np.flatnonzero(chunk.first_of), append=len(chunk.anchor))
                all_weight = weight[np.cumsum(chunk.first_of) - 1] if len(weight) else code
                sure = (code == _EQUAL) | ((code >= _MIXED) & (all_weight > 1))
                send = np.flatnonzero((code >= _MIXED) & chunk.first_of)
                n = len(send)
                nothing = lambda kind: pa.nulls(1, kind)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["chunk"]]), pa.array([pack(chunk.first[sure])], pa.binary()), pa.array([pack(chunk.last[sure] + 1)], pa.binary()),
                    *[nothing(pa.int64())] * 3, nothing(pa.bool_()), *[nothing(pa.int64())] * 2, nothing(pa.binary())], names=names)
                view = memoryview(chunk.bytes)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, row["chunk"])), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()), pa.array(chunk.anchor[send].view(np.int64)),
                    pa.array(chunk.content[send].view(np.int64)), pa.array(all_weight[send].astype(np.int64)), pa.array(code[send] == _MANY),
                    pa.array(chunk.first[send]), pa.array(chunk.at[send]), pa.array([view[a : b + length] for a, b in zip(chunk.first[send].tolist(), chunk.last[send].tolist())], pa.binary())],
                    names=names)
            release_memory()

    return joined.mapInArrow(find, _FOUND)


_MORE = "chunk long, first long, starts array<long>, ends array<long>"


def _transformed(rows: DataFrame, ranges: int, length: int) -> DataFrame:
    """Repeated windows of single segments, from transforms over all segments of a range of anchors."""
    def transform(table: pa.Table) -> pa.Table:
        key = table.column("anchor").to_numpy().view(np.uint64) * np.uint64(_BASE) ^ table.column("content").to_numpy().view(np.uint64)
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        weight = table.column("weight").to_numpy()
        total = np.bincount(which, weight).astype(np.int64)
        found = repeated_windows([d.as_py() for d in table.column("data").take(pa.array(first))], total.tolist(), length)
        release_memory()
        alone = np.flatnonzero(weight == 1)  # the others are known to repeat
        runs = [_runs(found[k]) for k in which[alone].tolist()]
        taken = table.take(pa.array(alone))
        kind = pa.list_(pa.int64())
        return pa.table([taken.column("chunk"), taken.column("first"), pa.array([r[0] for r in runs], kind), pa.array([r[1] for r in runs], kind)],
                        names=["chunk", "first", "starts", "ends"])

    spread = rows.withColumn("range", F.pmod(F.xxhash64("anchor"), F.lit(ranges)))
    return spread.groupBy("range").applyInArrow(transform, _MORE)


_SPLIT = "chunk long, first long, at long, low int, high int, anchor long, content long, weight long, data binary"


def _split(rows: DataFrame, length: int) -> DataFrame:
    """Each segment's windows in ``WAYS`` parts, by how far behind their start the anchor lies, from ``low`` up to ``high``."""
    names = [c.split()[0] for c in _SPLIT.split(", ")]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for chunk, first, at, low, high, weight, data in zip(*(batch.column(c).to_pylist() for c in ("chunk", "first", "at", "low", "high", "weight", "data"))):
                view, step = memoryview(data), -(-(high - low) // WAYS)
                for a in range(low, high, step):
                    z = min(a + step, high)
                    begin, end = max(first, at - z + 1), min(first + len(data) - length, at - a) + 1  # windows of this part
                    if begin < end:
                        shared = view[at - a - first : at - z + 1 + length - first]  # what every window of the part has
                        part = view[begin - first : end - 1 + length - first]
                        anchor, content = xxhash.xxh3_64_intdigest(shared, seed=a << 16 | z), xxhash.xxh3_64_intdigest(part)
                        out.append((chunk, begin, at, a, z, anchor - (1 << 63), content - (1 << 63), weight, bytes(part)))
            columns = zip(*out) if out else [[]] * len(names)
            kinds = [pa.int64()] * 3 + [pa.int32()] * 2 + [pa.int64()] * 3 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return rows.select("chunk", "first", "at", "low", "high", "weight", "data").mapInArrow(split, _SPLIT)


def _split_until_few(rows: DataFrame, length: int, gram: int, many: int, range_bytes: int) -> list[DataFrame]:
    """Repeated windows of segments whose anchor has very many different ones.

    Equal parts become one row with their weight before anything else is done
    with them; parts alone under their anchor are done with.  The last split has
    one window a part.
    """
    out, low, high = [], 0, length - gram + 1
    rows = rows.select("chunk", "first", "at", F.lit(low).alias("low"), F.lit(high).alias("high"), "weight", "data")
    first = F.struct("chunk", "first", "at", "low", "high", "data")
    whole = lambda n: (F.array(F.lit(0).cast("long")).alias("starts"), F.array(n).alias("ends"))
    for level in itertools.count():
        parts = stored(_split(rows, length), f"parts{level}")
        known = stored(parts.groupBy("anchor", "content").agg(F.sum("weight").alias("weight"), F.count("*").alias("n"), F.min_by(first, F.struct("chunk", "first")).alias("one"))
                       .select("anchor", "content", "weight", "n", "one.*"), f"kinds{level}")
        twice = known.where("n > 1").select("anchor", "content")
        again = parts.where("weight = 1").join(twice, ["anchor", "content"], "left_semi")
        out.append(again.select("chunk", "first", *whole((F.octet_length("data") - length + 1).cast("long"))))
        kinds = known.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
        open_ = stored(known.join(kinds, "anchor").where("high > low + 1"), f"open{level}")
        few = open_.where(F.col("kinds") <= many)
        total = few.agg(F.sum(F.octet_length("data"))).first()[0] or 0
        if total:
            out.append(_transformed(few, -(-total // range_bytes), length))
        rows = open_.where(F.col("kinds") > many)
        if not rows.head(1):  # at the last when each part is one window
            return out


_RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", texts: bool = False,
                   chunk_bytes: int = CHUNK_BYTES, block_anchors: int = BLOCK_ANCHORS, range_bytes: int = RANGE_BYTES, many: int = MANY) -> DataFrame:
    """A row per input row: id, ``n_bytes, n_removed, n_spans, kept_sha256``; with ``texts`` also ``kept``, the bytes that stay.

    Every byte covered by a string of ``length`` bytes that also starts anywhere
    else is removed, the first occurrence too; matches stay within texts, and all
    are judged on the input.  A null text is an empty one; a text shorter than
    ``length`` stays whole; repeated rows remove each other; an empty table gives
    no rows; other columns are ignored.  The other arguments bound what one task holds.
    """
    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).cast("binary").alias("text"))
    chunks = _text_chunks(source, chunk_bytes)
    kind = chunks.schema["ids"].dataType.elementType.simpleString()
    size = chunks.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = block_count(size // 20, block_anchors)  # packed texts have an anchor about every twenty bytes
    codes = stored(_anchor_answers(chunks, blocks, length, gram, many), "anchors")
    found = stored(_first_findings(answered(chunks, codes, ["codes"], "codes"), length, gram), "findings")
    discard(codes)
    open_ = found.where("data is not null")
    total = open_.where("not many").agg(F.sum(F.octet_length("data"))).first()[0] or 0
    more = _transformed(open_.where("not many"), max(1, -(-total // range_bytes)), length)
    if open_.where("many").head(1):
        for part in _split_until_few(open_.where("many"), length, gram, many, range_bytes):
            more = more.unionByName(part)
    per_chunk = stored(more.where(F.size("starts") > 0), "more").groupBy("chunk").agg(
        F.flatten(F.collect_list(F.transform("starts", lambda x: x + F.col("first")))).alias("more_starts"),
        F.flatten(F.collect_list(F.transform("ends", lambda x: x + F.col("first")))).alias("more_ends"))
    sure = found.where("data is null").select("chunk", "starts", "ends")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(rows_of(batch)):
                chunk = _Chunk(row)
                starts = chunk.ends - np.diff(chunk.ends, prepend=0)
                first = np.concatenate((unpack(row["starts"], np.int64), np.array(row["more_starts"] or [], np.int64)))
                last = np.concatenate((unpack(row["ends"], np.int64), np.array(row["more_ends"] or [], np.int64))) + length - 1
                order = np.argsort(first)
                first, upto = first[order], np.maximum.accumulate(last[order]) if len(last) else last
                # a span begins past all before it, or in another text than they are
                text_of = np.searchsorted(chunk.ends, first, side="right")
                new = np.flatnonzero((first > np.append(-1, upto[:-1])[: len(first)]) | (np.diff(text_of, prepend=-1) > 0))
                begin, end, of = first[new], upto[np.append(new[1:], len(first))[: len(new)] - 1], text_of[new]
                size = len(starts)
                n_spans, n_removed = np.bincount(of, minlength=size), np.bincount(of, end - begin, size).astype(np.int64)
                view, at, kept = memoryview(chunk.bytes), 0, []
                for a, z, spans in zip(starts.tolist(), chunk.ends.tolist(), n_spans.tolist()):
                    parts = []
                    for k in range(at, at + spans):
                        parts.append(view[a : begin[k]])
                        a = int(end[k])
                    at += spans
                    kept.append(b"".join([*parts, view[a:z]]))
                columns = [batch.column(batch.schema.get_field_index("ids"))[i].values, pa.array(chunk.ends - starts), pa.array(n_removed),
                           pa.array(n_spans), pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.binary())] * texts,
                                                 names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * texts)

    joined = chunks.join(sure, "chunk").join(per_chunk, "chunk", "left")
    return joined.mapInArrow(cut, f"id {kind}, {_RESULT}" + ", kept binary" * texts).withColumnRenamed("id", id_col)
