"""Alignment of two tokenizers over a corpus, with corpus-wide counts of linked token ids.

Both tokenizers' tokens cover the same bytes of a text.  Offsets where a token of
either ends cut a text into segments, and each segment is the overlap of one token
of A with one of B: a link.  Offsets where tokens of both end cut it into groups.

1. Texts are encoded once and kept in chunks of some megabytes, with the chunk's
   distinct id pairs and how often each is linked, in blocks.  A block is a slice
   of the pairs: those of every n-th id of B, so that a slice can't have more pairs
   than its ids of B times all ids of A.
2. The distinct pairs of a slice are united in a tree of groups of blocks, and a
   minimal perfect hash numbers them without gaps.
3. Each group of blocks becomes a dense vector of counts at those numbers; vectors
   are summed in a tree.  The pairs themselves are kept in the order of their
   numbers, so that whatever is looked up is compared with its pair.
4. Blocks get their counts back; chunks are aligned again and add them up.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from panelprep.llm.chunks import ROW_BYTES, pack, unpack
from panelprep.llm.common import drop_kept, kept, shared_path, stored, text_or_empty
from panelprep.llm.encoding import byte_alphabet

CHUNK_BYTES = 512 * 1024  # a packed chunk should be under half a region of the heap
SLICE_PAIRS = 4_000_000  # distinct pairs that a slice can have at most
GROUP_BYTES = 16 * 1024 * 1024  # of packed blocks that become one vector
FAN = 8  # vectors that are summed at a time
PART_BYTES = 1 << 18  # a longer text is encoded in parts

# A single space between two other characters: tokens begin at such a space, and none goes on across it.
_CUT = re.compile(r"(?<=\S) (?=[^\s▁])")
# Fixed value: the pattern by which byte-level pre-tokenizers cut text.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _pack_ids(ids: np.ndarray) -> bytes:
    """Token ids take most of what is stored: better packed than :func:`pack` does."""
    small = not len(ids) or int(ids.max()) < 1 << 16
    return bytes([2 if small else 4]) + zstandard.ZstdCompressor(level=3).compress(ids.astype(np.uint16 if small else np.uint32).tobytes())


def _unpack_ids(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint16 if data[0] == 2 else np.uint32)


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: numbers them from 0 to n - 1.

    Keys that are alone at their place of a bit array take it, the others go on to
    the next, smaller array.  A key's number is how many bits are set before its own.
    """

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.before = np.concatenate((np.zeros(1, np.int64), np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        x = keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (((x ^ (x >> np.uint64(31))) >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, words = [], [np.zeros(0, np.uint64)]
        while len(keys):
            size = -(-len(keys) * 2 // 64) * 64
            at = cls._places(keys, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            keys = keys[~alone[at]]
        return cls(sizes, np.concatenate(words))

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """A number for each key; for one that wasn't built in any number, or -1."""
        out, open_, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = self._places(keys[open_], level, size) + base
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            rank = self.before[at >> 6] + np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[open_[hit]] = rank[hit]
            open_, base = open_[~hit], base + size
        return out

    def to_bytes(self) -> bytes:
        return np.array([len(self.sizes), *self.sizes], np.int64).tobytes() + self.words.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        levels = int(np.frombuffer(data, np.int64, 1)[0])
        return cls(np.frombuffer(data, np.int64, levels, 8).tolist(), np.frombuffer(data, np.uint64, offset=8 * (levels + 1)))


class Tokenizers:
    """Both tokenizers, and the bytes of each of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.parts = not any("▁" in p.lstrip("▁") for p in pieces)  # no piece holds a space behind another character
        with open(path_a, encoding="utf-8") as file:
            shape = json.load(file)
        byte, model, pre = {c: b for b, c in byte_alphabet().items()}, shape["model"], shape["pre_tokenizer"]
        added = {t["id"]: t["content"] for t in shape["added_tokens"]}
        tokens = {i: token for token, i in model["vocab"].items()} | added
        self.bytes_a = [b""] * (max(tokens) + 1)
        for i, token in tokens.items():
            self.bytes_a[i] = token.encode() if i in added else bytes(byte[c] for c in token)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        plain = shape["normalizer"] is None and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and not model.get("ignore_merges")
        if plain and all(model["vocab"].get(x + y) == 256 + i for i, (x, y) in enumerate(pairs)):
            # ids in the order of the merges: the same tokens come from the joined tokens' ids as ranks
            import tiktoken

            ranks = {self.bytes_a[i]: i for i in tokens if i not in added}
            self.encode_a = tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            own = Tokenizer.from_file(path_a)
            own.encode_special_tokens = True
            self.encode_a = lambda text: own.encode(text, add_special_tokens=False).ids
        self.length_a, self.length_b = (np.array([len(t) for t in of], np.int64) for of in (self.bytes_a, self.bytes_b))

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids by A and by B of a space and the text; none where there's no text, or either's tokens aren't its bytes."""
        a, b = [], []
        for part in self._parts(text):
            whole = f" {part}"
            ids_a, ids_b = self.encode_a(whole), self.b.encode(part, num_threads=1)
            whole = whole.encode()
            if b"".join(map(self.bytes_a.__getitem__, ids_a)) != whole or b"".join(map(self.bytes_b.__getitem__, ids_b)) != whole:
                return _NO_IDS, _NO_IDS
            a.append(np.array(ids_a, np.uint32))
            b.append(np.array(ids_b, np.uint32))
        return (np.concatenate(a), np.concatenate(b)) if a else (_NO_IDS, _NO_IDS)

    def _parts(self, text: str) -> Iterator[str]:
        at = 0
        while self.parts and len(text) - at > PART_BYTES and (cut := _CUT.search(text, at + PART_BYTES)):
            yield text[at : cut.start()]
            at = cut.end()
        if text:
            yield text[at:]


_NO_IDS = np.zeros(0, np.uint32)
_LOADED: dict[tuple[str, str], Tokenizers] = kept({})
_SAID: dict[tuple[int, int], list[str]] = kept({})


def _said(kinds_a: int, kinds_b: int) -> list[str]:
    """How each id of A, then of B, is written inside a group and as the last one of its kind."""
    if (kinds_a, kinds_b) not in _SAID:
        drop_kept()  # the tokenizers aren't needed any more
        _SAID[kinds_a, kinds_b] = [f"{i}{mark}" for kinds, marks in ((kinds_a, ",|"), (kinds_b, ",;")) for i in range(kinds) for mark in marks]
    return _SAID[kinds_a, kinds_b]


def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    """One pair for each worker process."""
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = Tokenizers(path_a, path_b)
    return _LOADED[path_a, path_b]


class Alignment(NamedTuple):
    """Of texts put end to end: the tokens' groups, and each link's token of A, token of B and last byte."""

    group_a: np.ndarray
    group_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    ends: np.ndarray
    both: np.ndarray  # whether a group ends with the link


def align(length_a: np.ndarray, length_b: np.ndarray) -> Alignment:
    """``length_a`` and ``length_b`` are the tokens' bytes; both have the same sum."""
    ends_a, ends_b = np.cumsum(length_a), np.cumsum(length_b)
    size = int(ends_a[-1]) if len(ends_a) else 0
    ends = np.zeros(size + 1, np.uint8)
    ends[ends_a] = 1
    ends[ends_b] |= 2
    at = np.flatnonzero(ends)
    kind = ends[at]
    del ends
    ends_with_a, ends_with_b, both = kind & 1, kind >> 1, kind == 3
    kind_of = np.int32 if size < 1 << 31 else np.int64
    before = lambda flags: np.cumsum(flags, dtype=kind_of) - flags
    group = before(both)
    return Alignment(group[ends_with_a == 1], group[ends_with_b == 1], before(ends_with_a), before(ends_with_b), at, both)


def _write_chunks(docs: DataFrame, path_a: str, path_b: str, slices: int, chunk_bytes: int) -> DataFrame:
    """``docs`` (``id``, ``text``) as rows of packed arrays: ids, tokens of both kinds and the distinct pairs in blocks."""
    block = pa.list_(pa.struct([("slice", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, part, seq = tokenizers(path_a, path_b), TaskContext.get().partitionId(), 0
        ids, a, b, size = [], [], [], 0

        def chunk() -> pa.RecordBatch:
            held = pa.concat_arrays(ids)
            all_a, all_b = np.concatenate(a), np.concatenate(b)
            links = align(both.length_a[all_a], both.length_b[all_b])
            keys, counts = np.unique(_keys(all_a[links.link_a], all_b[links.link_b]), return_counts=True)
            slice_of = (keys >> np.uint64(32)) % np.uint64(slices)
            order = np.argsort(slice_of, kind="stable")  # each slice's keys ascending
            keys, counts, slice_of = keys[order], counts[order], slice_of[order]
            starts = np.flatnonzero(np.diff(slice_of, prepend=np.uint64(slices)))
            blocks = [{"slice": int(slice_of[s]), "keys": _packed_keys(keys[s:e]), "counts": pack(counts[s:e].astype(np.uint32))}
                      for s, e in zip(starts.tolist(), np.append(starts[1:], len(keys)).tolist())]
            return pa.RecordBatch.from_arrays([
                pa.array([(part << 32) + seq], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held),
                *(pa.array([pack(np.array([len(x) for x in of], np.int64))], pa.binary()) for of in (a, b)),
                pa.array([_pack_ids(all_a)], pa.binary()), pa.array([_pack_ids(all_b)], pa.binary()), pa.array([blocks], block)],
                names=["chunk", "ids", "n_a", "n_b", "a", "b", "blocks"])

        for batch in batches:
            at = 0
            for i, text in enumerate(batch.column(1)):
                text = text.as_py()
                ids_a, ids_b = both.encode(text)
                a.append(ids_a)
                b.append(ids_b)
                size += len(text) + ROW_BYTES
                if size >= chunk_bytes:
                    ids.append(batch.column(0).slice(at, i + 1 - at))
                    at = i + 1
                    yield chunk()
                    ids, a, b, size, seq = [], [], [], 0, seq + 1
                    pa.default_memory_pool().release_unused()
            if at < batch.num_rows:
                ids.append(batch.column(0).slice(at))
        if a:
            yield chunk()

    kind = docs.schema["id"].dataType.simpleString()
    schema = f"chunk long, ids array<{kind}>, n_a binary, n_b binary, a binary, b binary, blocks array<struct<slice: int, keys: binary, counts: binary>>"
    path = shared_path(docs.sparkSession, "aligned")
    docs.select("id", "text").mapInArrow(build, schema).write.option("compression", "uncompressed").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def _keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (b.astype(np.uint64) << np.uint64(32)) | a


def _packed_keys(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def _read_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


_UNITED = "slice int, grp int, keys binary"
_VECTOR = "slice int, grp int, counts binary"
_TABLE = "slice int, n long, hash binary, keys binary"
_TOTAL = "slice int, hash binary, keys binary, counts binary, best binary"


def _fanned(df: DataFrame, groups: int, add, schema: str) -> DataFrame:
    """One row a slice from ``groups`` a slice, ``FAN`` at a time."""
    while groups > 1:
        df = df.withColumn("grp", F.floor(F.col("grp") / FAN).cast("int")).groupBy("slice", "grp").applyInArrow(add, schema)
        groups = -(-groups // FAN)
    return df


def _pair_table(blocks: DataFrame, groups: int) -> DataFrame:
    """The distinct pairs of each slice: their minimal perfect hash, and the pairs in its order."""
    def unite(table: pa.Table) -> pa.Table:
        keys = np.unique(np.concatenate([_read_keys(k.as_py()) for k in table.column("keys")]))
        return pa.table({"slice": table.column("slice").slice(0, 1), "grp": table.column("grp").slice(0, 1), "keys": pa.array([_packed_keys(keys)], pa.binary())})

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slice_, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys = _read_keys(packed)
                numbers = PerfectHash.build(keys)
                ordered = np.empty_like(keys)
                ordered[numbers.numbers(keys)] = keys
                yield pa.RecordBatch.from_pydict({"slice": pa.array([slice_], pa.int32()), "n": [len(keys)], "hash": pa.array([numbers.to_bytes()], pa.binary()),
                                                  "keys": pa.array([pack(ordered)], pa.binary())})

    united = _fanned(blocks.select("slice", "grp", "keys").groupBy("slice", "grp").applyInArrow(unite, _UNITED), groups, unite, _UNITED)
    return stored(united.select("slice", "keys").mapInArrow(number, _TABLE), "pairs")


def _found(table: dict, keys: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """The keys' numbers, each compared with the key kept at it."""
    at = PerfectHash.from_bytes(table["hash"]).numbers(keys)
    if len(at) and (at.min() < 0 or (ordered[at] != keys).any()):
        raise ValueError("a pair isn't in its slice's table")
    return at


def _per_group(table: DataFrame, groups: int) -> DataFrame:
    return table.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))


def _totals(blocks: DataFrame, table: DataFrame, groups: int) -> DataFrame:
    """Each slice's pairs with their counts over the corpus, and whether that's the highest of the pair's id of B."""
    def vector(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):  # no chunk of the group has pairs of this slice
            return pa.table({"slice": right.column("slice"), "grp": right.column("grp"), "counts": pa.array([pack(np.zeros(right.column("n")[0].as_py(), np.uint64))], pa.binary())})
        row = right.select(["n", "hash", "keys"]).to_pylist()[0]
        dense, ordered = np.zeros(row["n"], np.uint64), unpack(row["keys"], np.uint64)
        numbers = _found(row, np.concatenate([_read_keys(k.as_py()) for k in left.column("keys")]), ordered)
        np.add.at(dense, numbers, np.concatenate([unpack(c.as_py(), np.uint32) for c in left.column("counts")]).astype(np.uint64))
        return pa.table({"slice": left.column("slice").slice(0, 1), "grp": left.column("grp").slice(0, 1), "counts": pa.array([pack(dense)], pa.binary())})

    def add(vectors: pa.Table) -> pa.Table:
        total = 0
        for counts in vectors.column("counts"):
            total = total + unpack(counts.as_py(), np.uint64)
        return pa.table({"slice": vectors.column("slice").slice(0, 1), "grp": vectors.column("grp").slice(0, 1), "counts": pa.array([pack(total)], pa.binary())})

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids_b, counts = unpack(row["keys"], np.uint64) >> np.uint64(32), unpack(row["counts"], np.uint64)
                order = np.lexsort((counts, ids_b))
                last = np.flatnonzero(np.diff(ids_b[order], append=np.uint64(1 << 63)))
                best = np.empty(len(order), bool)
                best[order] = counts[order] == np.repeat(counts[order][last], np.diff(last, prepend=-1))
                yield pa.RecordBatch.from_pydict({"slice": pa.array([row["slice"]], pa.int32()), "hash": pa.array([row["hash"]], pa.binary()), "keys": pa.array([row["keys"]], pa.binary()),
                                                  "counts": pa.array([row["counts"]], pa.binary()), "best": pa.array([pack(best.view(np.uint8))], pa.binary())})

    vectors = blocks.groupBy("slice", "grp").cogroup(_per_group(table, groups).groupBy("slice", "grp")).applyInArrow(vector, _VECTOR)
    summed = _fanned(vectors, groups, add, _VECTOR)
    return stored(table.join(summed.select("slice", "counts"), "slice").select("slice", "hash", "keys", "counts").mapInArrow(judge, _TOTAL), "totals")


def _answers(blocks: DataFrame, totals: DataFrame, groups: int) -> DataFrame:
    """For each chunk's block the counts of its pairs and whether they're the best, in the block's order."""
    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"chunk": left.column("chunk"), "slice": left.column("slice"), "counts": [], "best": []}
        if len(left):
            row = right.select(["hash", "keys", "counts", "best"]).to_pylist()[0]
            ordered, counts, best = unpack(row["keys"], np.uint64), unpack(row["counts"], np.uint64), unpack(row["best"], np.uint8)
            for packed in left.column("keys"):
                at = _found(row, _read_keys(packed.as_py()), ordered)
                out["counts"].append(pack(counts[at]))
                out["best"].append(pack(best[at]))
        return pa.table(out | {name: pa.array(out[name], pa.binary()) for name in ("counts", "best")})

    return blocks.drop("counts").groupBy("slice", "grp").cogroup(_per_group(totals, groups).groupBy("slice", "grp")).applyInArrow(
        answer, "chunk long, slice int, counts binary, best binary")


_RESULT = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _text_ends(length_a: np.ndarray, n_a: np.ndarray) -> np.ndarray:
    """Last byte of each text, put end to end; first a 0."""
    return np.concatenate((np.zeros(1, np.int64), np.cumsum(length_a)))[np.concatenate((np.zeros(1, np.int64), np.cumsum(n_a)))]


def _per_text(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of each text's values."""
    return np.diff(np.concatenate((np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)))[edges])


def align_documents(docs: DataFrame, path_a: str, path_b: str, groups: bool = False, id_col: str = "doc_id", text_col: str = "text",
                    chunk_bytes: int = CHUNK_BYTES, slice_pairs: int = SLICE_PAIRS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """A row per row of ``docs``: id, ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``; with ``groups`` also the groups as text.

    ``path_a`` is a byte-level file of the tokenizers library, ``path_b`` a
    sentencepiece model; both encode a space and the text, special strings as plain
    text.  A null or empty text, and one that a tokenizer doesn't give back byte by
    byte, has no tokens, zeros and an empty digest, and adds to no count.  Equal rows
    count as often as they are; an empty table gives no rows; other columns are ignored.
    """
    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    both = tokenizers(path_a, path_b)
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, -(-min(len(both.bytes_a) * len(both.bytes_b), size // 2) // slice_pairs))
    chunks = _write_chunks(source, path_a, path_b, slices, chunk_bytes)
    kind = chunks.schema["ids"].dataType.elementType.simpleString()
    blocks = chunks.select("chunk", F.inline("blocks"))
    packed = blocks.agg(F.sum(F.octet_length("keys") + F.octet_length("counts"))).first()[0] or 0
    parts = max(1, -(-packed // (slices * group_bytes)))
    blocks = blocks.withColumn("grp", F.pmod(F.xxhash64("chunk"), F.lit(parts)).cast("int"))
    answers = _answers(blocks, _totals(blocks, _pair_table(blocks, parts), parts), parts)
    answers = answers.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("slice", "counts", "best"))).alias("answers"))  # a chunk's blocks
    length_a, length_b = both.length_a.astype(np.int32), both.length_b.astype(np.int32)  # of some ten thousand tokens each

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        said = _said(len(length_a), len(length_b))
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names) if name != "ids"}
                a, b, n_a, n_b = _unpack_ids(row["a"]), _unpack_ids(row["b"]), unpack(row["n_a"], np.int64), unpack(row["n_b"], np.int64)
                links = align(length_a[a], length_b[b])
                answers = row["answers"] or []
                known = np.concatenate([np.zeros(0, np.uint64), *(_read_keys(k["keys"]) for k in sorted(row["blocks"], key=lambda k: k["slice"]))])
                counts = np.concatenate([np.zeros(0, np.uint64), *(unpack(k["counts"], np.uint64) for k in answers)]).astype(np.int64)
                best = np.concatenate([np.zeros(0, np.uint8), *(unpack(k["best"], np.uint8) for k in answers)])
                order = np.argsort(known)
                at = order[np.searchsorted(known[order], _keys(a[links.link_a], b[links.link_b]))]
                edges = np.searchsorted(links.ends, _text_ends(length_a[a], n_a), side="right")
                n_best, count_sum = (_per_text(of[at], edges) for of in (best, counts))
                edge_a, edge_b = (np.concatenate((np.zeros(1, np.int64), np.cumsum(n))) for n in (n_a, n_b))
                n_groups = _per_text(links.both, edges)
                del at, known, order
                in_a, in_b = (np.concatenate((np.zeros(1, np.int64), np.cumsum(np.bincount(g, minlength=int(links.both.sum()))))) for g in (links.group_a, links.group_b))
                text = np.empty(len(a) + len(b), np.int32)  # tokens of both in the order of the groups
                text[np.arange(len(a)) + in_b[links.group_a]] = a.astype(np.int32) * 2 + (np.diff(links.group_a, append=-1) != 0)
                text[np.arange(len(b)) + in_a[links.group_b + 1]] = (b.astype(np.int32) + len(length_a)) * 2 + (np.diff(links.group_b, append=-1) != 0)
                cut = (edge_a + edge_b).tolist()
                told = ["".join(map(said.__getitem__, text[s:e].tolist()))[:-1] for s, e in zip(cut, cut[1:])]
                digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in told]
                columns = [batch.column(batch.schema.get_field_index("ids"))[i].values, *map(pa.array, (
                    n_a, n_b, n_groups, np.diff(edges), n_best, count_sum)), pa.array(digests, pa.string())]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(told, pa.string())] * groups,
                                                 names=["id", *(c.split()[0] for c in _RESULT.split(", "))] + ["groups"] * groups)

    joined = chunks.join(answers, "chunk", "left")
    return joined.mapInArrow(add_up, f"id {kind}, {_RESULT}" + ", groups string" * groups).withColumnRenamed("id", id_col)
