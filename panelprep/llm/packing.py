"""Packing of documents into sequences of one length: first-fit decreasing with a tournament tree.

Documents are encoded and cut into pieces of at most a sequence.  Full pieces are
sequences already.  The others are dealt at random into groups of some megabytes,
and each group is packed by itself: pieces from the longest down, each into the
first sequence with room for it, which a tournament tree of the sequences' free
room finds by going down to the leftmost winner.  What little room is then left
over is filled by cutting up the emptiest sequences, until padding is below a
stated share of the group's tokens.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelprep.llm.common import shared_path, text_or_empty
from panelprep.llm.encoding import encoder

SEQUENCE = 4096
END_ID = 2
PADDING = 0.001  # share of a group's tokens that may be padding
GROUP_BYTES = 8 * 1024 * 1024  # of text
ROW_BYTES = 64  # what a document counts for besides its text


class RoomTree:
    """Free room of sequences, and for each pair, pair of pairs and so on the larger one."""

    def __init__(self, sequences: int, room: int):
        self.size = 1 << max(sequences - 1, 0).bit_length()
        self.room = [room] * (2 * self.size)

    def first_fit(self, need: int) -> int:
        """The first sequence with at least this room; the room is taken."""
        room, at = self.room, 1
        while at < self.size:
            at *= 2
            if room[at] < need:
                at += 1
        found = at - self.size
        room[at] -= need
        while at > 1:
            at >>= 1
            larger = max(room[2 * at], room[2 * at + 1])
            if room[at] == larger:
                break
            room[at] = larger
        return found


Part = tuple[int, int, int]  # number of the piece, first token in it, tokens


def _padding(fill: int, sequence: int) -> int:
    """What a sequence with this many tokens is padded by: a power of two isn't."""
    return 0 if fill & (fill - 1) == 0 else sequence - fill


def pack(lengths: list[int], sequence: int = SEQUENCE, padding: float = PADDING) -> list[list[Part]]:
    """Sequences of parts of pieces, whose ``lengths`` are given; all tokens are in one part each.

    Pieces stay whole in first-fit decreasing.  While more than ``padding`` of all
    tokens is padding, the emptiest sequence gives its tokens to the next emptiest;
    if a last one is still too empty, it's cut into sequences whose lengths are
    powers of two.
    """
    total = sum(lengths)
    tree = RoomTree(2 * -(-total // sequence) + 1, sequence)  # at most one sequence is half empty
    bins: dict[int, list[Part]] = {}
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        bins.setdefault(tree.first_fit(lengths[k]), []).append((k, 0, lengths[k]))
    left = deque(sorted(((sum(n for _, _, n in parts), parts) for _, parts in sorted(bins.items())), key=lambda b: b[0]))
    padded = sum(_padding(fill, sequence) for fill, _ in left)
    out: list[list[Part]] = []
    fill, parts = left.popleft() if left else (0, [])
    while left and padded > total * padding:
        more, taken = left.popleft()
        padded -= _padding(fill, sequence) + _padding(more, sequence)
        moved = min(fill, sequence - more)
        fill, more = fill - moved, more + moved
        while moved:
            k, first, n = parts.pop()
            given = min(n, moved)
            taken.append((k, first + n - given, given))
            if n > given:
                parts.append((k, first, n - given))
            moved -= given
        if fill:
            out.append(taken)
        else:
            fill, parts = more, taken
        if fill == sequence:
            out.append(parts)
            fill, parts = left.popleft() if left else (0, [])
        padded += _padding(fill, sequence)
    if padded > total * padding:
        while fill:
            size = 1 << (fill.bit_length() - 1)
            cut, parts = _split(parts, size)
            out.append(cut)
            fill -= size
    elif fill:
        out.append(parts)
    return out + [parts for _, parts in left]


def _split(parts: list[Part], size: int) -> tuple[list[Part], list[Part]]:
    """The first ``size`` tokens, and the rest."""
    head, rest = [], list(reversed(parts))
    while size:
        k, first, n = rest.pop()
        head.append((k, first, min(n, size)))
        if n > size:
            rest.append((k, first + size, n - size))
        size -= min(n, size)
    return head, rest[::-1]


_PIECE = "id {id}, start long, length long, doc_tokens long, ids binary, grp long"
_SEQUENCE = "sequence_id long, length long, doc_ids array<{id}>, starts array<long>, lengths array<long>, doc_tokens array<long>, ids binary"


def _pieces(docs: DataFrame, tokenizer_path: str, end_id: int, sequence: int, groups: int, kind: str) -> DataFrame:
    """Documents encoded and cut into pieces, each with the group it's dealt to."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        end, step = np.array([end_id], enc.dtype).tobytes(), enc.dtype().itemsize
        for batch in batches:
            texts = batch.column(1)
            for at, until in _runs(texts):
                rows, columns = [], ([], [], [], [], [])
                encoded = enc.encode(texts.slice(at, until - at).to_pylist())
                for k, (ids, salt) in enumerate(zip(encoded, batch.column(2).slice(at, until - at).to_pylist())):
                    ids += end
                    tokens = len(ids) // step
                    for start in range(0, tokens, sequence):
                        length = min(sequence, tokens - start)
                        group = xxhash.xxh3_64_intdigest(start.to_bytes(8, "little"), seed=salt & (1 << 64) - 1) % groups
                        rows.append(at + k)
                        for column, value in zip(columns, (start, length, tokens, ids[start * step : (start + length) * step], group)):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, pa.int64()) for c in columns[:3]),
                    pa.array(columns[3], pa.binary()), pa.array(columns[4], pa.int64())], names=["id", "start", "length", "doc_tokens", "ids", "grp"])

    return docs.mapInArrow(cut, _PIECE.format(id=kind))


def _runs(texts: pa.Array, size: int = 4 * 1024 * 1024) -> Iterator[tuple[int, int]]:
    """Neighbouring texts of some megabytes."""
    at = held = 0
    for k, n in enumerate(pc.binary_length(texts).to_pylist()):
        held += n
        if held >= size:
            yield at, k + 1
            at, held = k + 1, 0
    if at < len(texts):
        yield at, len(texts)


def write_sequences(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, sequence: int = SEQUENCE, padding: float = PADDING,
                    group_bytes: int = GROUP_BYTES, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes sequences of at most ``sequence`` tokens under ``path``: ids, and of which documents they are.

    Each document's ids and ``end_id`` after them lie in exactly one piece each.  A
    null text is empty and gives the end id alone; equal rows are packed as often
    as they are, and pieces are dealt to groups by themselves, so neither a long
    document nor many equal ones fill a group.  Results repeat while the table's
    files stay the same.  An empty table gives no sequence; other columns are ignored.
    """
    text = text_or_empty(text_col).cast("binary")
    source = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(F.monotonically_increasing_id(), F.lit(12)).alias("salt"))
    size = docs.agg(F.sum(F.octet_length(text) + ROW_BYTES)).first()[0] or 0
    kind = source.schema["id"].dataType.simpleString()
    pieces = _pieces(source, tokenizer_path, end_id, sequence, max(1, -(-size // group_bytes)), kind)
    step = encoder(tokenizer_path).dtype().itemsize

    def fill(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("id", "ascending"), ("start", "ascending"), ("ids", "ascending")])
        group, ids = table.column("grp")[0].as_py(), table.column("ids").to_pylist()
        starts, lengths, tokens = (table.column(c).to_numpy() for c in ("start", "length", "doc_tokens"))
        full, open_ = np.flatnonzero(lengths == sequence).tolist(), np.flatnonzero(lengths < sequence).tolist()
        packed = [[(k, 0, sequence)] for k in full]
        packed += [[(open_[k], a, n) for k, a, n in parts] for parts in pack(lengths[open_].tolist(), sequence, padding)]
        of = np.array([k for parts in packed for k, _, _ in parts], np.int64)
        first = np.array([a for parts in packed for _, a, _ in parts], np.int64)
        n = np.array([n for parts in packed for _, _, n in parts], np.int64)
        edges = np.concatenate(([0], np.cumsum([len(p) for p in packed])))
        offsets = pa.array(edges, pa.int32())
        return pa.table({
            "sequence_id": pa.array((group << 32) + np.arange(len(packed))), "length": pa.array(np.add.reduceat(n, edges[:-1])),
            "doc_ids": pa.ListArray.from_arrays(offsets, table.column("id").take(pa.array(of)).combine_chunks()),
            "starts": pa.ListArray.from_arrays(offsets, pa.array(starts[of] + first)), "lengths": pa.ListArray.from_arrays(offsets, pa.array(n)),
            "doc_tokens": pa.ListArray.from_arrays(offsets, pa.array(tokens[of])),
            "ids": pa.array([b"".join(ids[k][a * step : (a + m) * step] for k, a, m in parts) for parts in packed], pa.binary())})

    pieces.groupBy("grp").applyInArrow(fill, _SEQUENCE.format(id=kind)).write.parquet(path)


def read_pieces(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """From the files, per piece: id, ``start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length``."""
    sequences = spark.read.parquet(path)
    kind = sequences.schema["doc_ids"].dataType.elementType.simpleString()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            lists = {name: column[name].flatten() for name in ("doc_ids", "starts", "lengths", "doc_tokens")}
            counts, lengths = np.diff(column["lengths"].offsets.to_numpy()), lists["lengths"].to_numpy()
            whole, offsets, crcs, at = column["length"].to_numpy(), [], [], 0
            for ids, count, total in zip(column["ids"].to_pylist(), counts.tolist(), whole.tolist()):
                wide = memoryview(np.frombuffer(ids, np.uint16 if len(ids) == 2 * total else np.uint32).astype("<u4")).cast("B")
                offset = 0
                for n in lengths[at : at + count].tolist():
                    crcs.append(zlib.crc32(wide[4 * offset : 4 * (offset + n)]))
                    offsets.append(offset)
                    offset += n
                at += count
            yield pa.RecordBatch.from_arrays([
                lists["doc_ids"], lists["starts"], lists["lengths"], pa.array(crcs, pa.int64()), lists["doc_tokens"],
                pa.array(np.repeat(column["sequence_id"].to_numpy(), counts)), pa.array(offsets, pa.int64()), pa.array(np.repeat(whole, counts))],
                names=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length"])

    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long"
    return sequences.mapInArrow(digests, schema).withColumnRenamed("id", id_col)


def pack_documents(docs: DataFrame, tokenizer_path: str, **arguments) -> DataFrame:
    """Writes sequences to the shared folder and reads the pieces back from them."""
    path = shared_path(docs.sparkSession, "sequences")
    write_sequences(docs, path, tokenizer_path, **arguments)
    return read_pieces(docs.sparkSession, path, arguments.get("id_col", "doc_id"))
