"""Benchmark decontamination with an FM-index per training shard.

A shard is some batches of documents inside one task.  Its words become numbers
(0: a word that no benchmark item has); runs too short for any test phrase can't
match and are left out.  Over what remains the FM-index is built: the suffix
array gives the Burrows-Wheeler transform, kept in a wavelet matrix whose ranks
drive the backward search of all phrases at once, and every few suffix positions
are kept, from which occurrences are located by walking back.  The occurrences'
word spans are merged per document.
"""

from __future__ import annotations

import hashlib
import pickle
import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from panelprep.llm.common import kept, stored, text_or_empty
from panelprep.llm.wavelet import WaveletMatrix

WINDOW = 10
SHARD_WORDS = 2_000_000
SAMPLE = 8
SLICE_WINDOWS = 200_000  # of the benchmark that a task searches for at a time

# Lower-case letters, digits and bytes of non-ASCII characters are word bytes, A-Z are lowered, all else separates.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


def _windows(texts: pa.Array, window: int) -> tuple[list[int], list[bytes]]:
    """Each text's different windows, words joined by spaces, with the number of the text."""
    rows, found = [], []
    for row, text in enumerate(texts.to_pylist()):
        words = words_of(text)
        own = {b" ".join(words[start : start + window]) for start in range(max(1, len(words) - window + 1) if words else 0)}
        rows += [row] * len(own)
        found += own
    return rows, found


class Phrases:
    """A slice of the benchmark's different windows as rows of word numbers, and which items have each."""

    def __init__(self, windows: list[bytes], owners: list[list[str]], window: int):
        self.words: dict[bytes, int] = {}
        numbers = [[self.words.setdefault(w, len(self.words) + 1) for w in phrase.split()] for phrase in windows]
        self.length = np.array([len(n) for n in numbers], np.int64)
        self.phrases = np.zeros((len(windows), window), np.int64)
        for i, phrase in enumerate(numbers):
            self.phrases[i, : len(phrase)] = phrase
        names = sorted(set().union(*owners))
        number = {name: i for i, name in enumerate(names)}
        self.names, self.owner = names, np.array([number[name] for of in owners for name in of], np.int32)
        self.owned = np.concatenate(([0], np.cumsum([len(of) for of in owners]))).astype(np.int64)
        self.shortest = int(self.length.min()) if len(windows) else 0

    def items(self, phrase: int) -> list[str]:
        return [self.names[k] for k in self.owner[self.owned[phrase] : self.owned[phrase + 1]].tolist()]

    def to_bytes(self) -> bytes:
        words = b" ".join(self.words)  # in the order of their numbers
        return pickle.dumps((words, self.phrases.astype(np.int32), self.length.astype(np.uint16), "\0".join(self.names), self.owner, self.owned))

    @classmethod
    def from_bytes(cls, data: bytes) -> Phrases:
        out = cls([], [], 1)
        words, phrases, length, names, out.owner, out.owned = pickle.loads(data)
        out.words = {word: i + 1 for i, word in enumerate(words.split())}
        out.phrases, out.length, out.names = phrases.astype(np.int64), length.astype(np.int64), names.split("\0")
        out.shortest = int(length.min()) if len(length) else 0
        return out


def phrase_slices(benchmark: DataFrame, window: int = WINDOW, item_col: str = "item_id", text_col: str = "text",
                  slice_windows: int = SLICE_WINDOWS) -> DataFrame:
    """The benchmark's windows in slices of about ``slice_windows``, packed: ``slice, packed``.  Numbered in the tasks that have a slice."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = _windows(batch.column(1), window)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column(0).take(pa.array(rows, pa.int64()))], names=["window", "item"])

    def packed(table: pa.Table) -> pa.Table:
        owners: dict[bytes, list[str]] = {}
        for phrase, item in zip(table.column("window").to_pylist(), table.column("item").to_pylist()):
            owners.setdefault(phrase, [])
            if item is not None:
                owners[phrase].append(item)
        phrases = Phrases(list(owners), list(owners.values()), window)
        return pa.table({"slice": table.column("slice").slice(0, 1), "packed": pa.array([phrases.to_bytes()], pa.binary())})

    texts = benchmark.select(F.col(item_col).cast("string").alias("item"), text_or_empty(text_col).cast("binary").alias("text"))
    pairs = stored(texts.mapInArrow(cut, "window binary, item string").distinct(), "windows")
    total = pairs.select("window").distinct().count()
    spread = pairs.withColumn("slice", F.pmod(F.xxhash64("window"), F.lit(max(1, -(-total // slice_windows)))).cast("int"))
    return spread.groupBy("slice").applyInArrow(packed, "slice int, packed binary")


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """By prefix doubling; a 0 ends a run and is smaller the earlier it stands, so no comparison goes past it."""
    n = len(symbols)
    ends = symbols == 0
    rank = np.where(ends, np.cumsum(ends), symbols + ends.sum())
    step = 1
    while True:
        following = np.zeros(n, np.int64)
        following[: n - step] = rank[step:]
        key = rank * (int(rank.max()) + 2) + np.where(ends, 0, following)
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([1], key[order][1:] != key[order][:-1])))
        if rank[order[-1]] == n:
            return order
        step *= 2


class FmIndex:
    """Backward search and location over a sequence of word numbers in which every run ends with 0."""

    def __init__(self, symbols: np.ndarray, sample: int = SAMPLE):
        sa = suffix_array(symbols)
        bwt = symbols[sa - 1]  # before position 0 stands the last symbol, a 0
        bits = max(1, int(symbols.max()).bit_length())
        self.n = len(symbols)
        self.matrix = WaveletMatrix.build(bwt.astype(np.uint16 if bits <= 16 else np.uint32), bits)
        self.symbols = 1 << bits
        counts = np.bincount(symbols, minlength=self.symbols)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        # kept: every few positions, and starts of runs, before which a walk can't go on
        kept = (sa % sample == 0) | (bwt == 0)
        self.kept, self.sampled = kept, np.where(kept, sa, 0)[kept]
        self.kept_before = np.cumsum(kept) - 1

    def search(self, phrases: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix-array intervals of all phrases, from their last word to the first."""
        low, high = np.zeros(len(length), np.int64), np.full(len(length), self.n, np.int64)
        for back in range(1, phrases.shape[1] + 1):
            live = np.flatnonzero((length >= back) & (low < high))
            if not len(live):
                continue
            symbol = phrases[live, length[live] - back]
            known = symbol < self.symbols
            symbol = np.where(known, symbol, 0)
            below = self.matrix.rank(symbol, low[live])
            upto = self.matrix.rank(symbol, high[live])
            low[live] = self.first[symbol] + below
            high[live] = np.where(known, self.first[symbol] + upto, low[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows."""
        at, steps = rows.copy(), np.zeros(len(rows), np.int64)
        walking = np.flatnonzero(~self.kept[at])
        while len(walking):
            row = at[walking]
            symbol = self.matrix.access(row)
            at[walking] = self.first[symbol] + self.matrix.rank(symbol, row)
            steps[walking] += 1
            walking = walking[~self.kept[at[walking]]]
        return self.sampled[self.kept_before[at]] + steps


def _spans(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], marks.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def search_shard(texts: list[bytes], phrases: Phrases) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
    """Per text its number of words, the merged word spans of all occurrences, and the items found, sorted."""
    get = phrases.words.get
    n_words, sequence, doc_of, start_of, at = [], [], [], [], []
    for d, text in enumerate(texts):
        words = words_of(text)
        n_words.append(len(words))
        if not phrases.shortest or len(words) < phrases.shortest:
            continue
        numbers = np.fromiter(map(get, words, repeat(0)), np.int64, len(words))
        starts, ends = _spans(numbers > 0)
        for a, b in zip(starts.tolist(), ends.tolist()):
            if b - a >= phrases.shortest:
                doc_of.append(d)
                start_of.append(a)
                at.append(b - a + 1)
                sequence += [numbers[a:b], [0]]
    found: list[tuple[int, list[tuple[int, int]], list[str]]] = [(n, [], []) for n in n_words]
    if not sequence:
        return found
    run_at = np.concatenate(([0], np.cumsum(at)))
    index = FmIndex(np.concatenate(sequence).astype(np.int64))
    low, high = index.search(phrases.phrases, phrases.length)
    hits = high - low
    phrase = np.repeat(np.arange(len(hits)), hits)
    if not len(phrase):
        return found
    rows = np.arange(len(phrase)) - np.repeat(np.cumsum(hits) - hits, hits) + np.repeat(low, hits)
    place = index.locate(rows)
    cover = np.bincount(place, minlength=index.n + 1) - np.bincount(place + phrases.length[phrase], minlength=index.n + 1)
    starts, ends = _spans(np.cumsum(cover) > 0)
    for run, a, b in zip((np.searchsorted(run_at, starts, side="right") - 1).tolist(), starts.tolist(), ends.tolist()):
        shift = start_of[run] - int(run_at[run])
        found[doc_of[run]][1].append((a + shift, b + shift))
    docs = np.array(doc_of)[np.searchsorted(run_at, place, side="right") - 1]
    pairs = np.unique(docs * len(hits) + phrase)
    items: dict[int, set[str]] = {}
    for pair in pairs.tolist():
        items.setdefault(pair // len(hits), set()).update(phrases.items(pair % len(hits)))
    for d, names in items.items():
        found[d][2].extend(sorted(names))
    return found


def merge(found: list, more: list) -> list:
    """Findings of two slices of the benchmark over the same texts."""
    out = []
    for (n, spans, items), (_, other, names) in zip(found, more):
        joined: list[tuple[int, int]] = []
        for a, b in sorted(spans + other):
            if joined and a <= joined[-1][1]:
                joined[-1] = joined[-1][0], max(b, joined[-1][1])
            else:
                joined.append((a, b))
        out.append((n, joined, sorted({*items, *names})))
    return out


# The slice that a worker has unpacked last.
_UNPACKED: dict[str, Phrases] = kept({})


def _unpacked(name: str, slice_: Broadcast) -> Phrases:
    if name not in _UNPACKED:
        _UNPACKED.clear()
        _UNPACKED[name] = Phrases.from_bytes(slice_.value)
        slice_.__dict__.pop("_value", None)  # a worker holds the last slice only
    return _UNPACKED[name]


_RESULT = ("n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
           "spans array<struct<start:long,end:long>>, items array<string>")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", slice_windows: int = SLICE_WINDOWS) -> DataFrame:
    """A row ``(doc, found)`` per input row: the row itself as a struct, and what of the benchmark its text has.

    ``found.spans`` are merged word ranges (end exclusive) of all occurrences of
    the benchmark's windows, ``found.items`` the items they belong to.  A null or
    wordless text has no words and no hits; an item without words has no window,
    items of one text are all named, and one with a null id hits without being
    named.  Repeated rows get equal results; an empty table on either side gives
    no rows or no hits.  Columns of ``docs`` may have any names.

    No shuffle of documents: each is searched in the task that reads it.  The
    benchmark's windows are numbered and packed by tasks, in slices of bounded size;
    slices go to every executor, and a shard is searched for one after the other.
    """
    spark = docs.sparkSession
    packed_slices = phrase_slices(benchmark, window, item_col, item_text_col, slice_windows)
    # bounded each; the driver holds one at a time, as a broadcast is a file
    slices = [(uuid.uuid4().hex, spark.sparkContext.broadcast(bytes(row["packed"]))) for row in packed_slices.toLocalIterator()]
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), text_or_empty(text_col).cast("binary").alias("text"))
    schema = packed.select("doc").withColumn("found", F.lit(None).cast(f"struct<{_RESULT}>")).schema

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([
            ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_()),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.string()))])

        def shard(held: list[pa.RecordBatch], texts: list[bytes]) -> Iterator[pa.RecordBatch]:
            found, at = [(len(words_of(t)), [], []) for t in texts] if not slices else None, 0
            for name, slice_ in slices:
                more = search_shard(texts, _unpacked(name, slice_))
                found = more if found is None else merge(found, more)
            for batch in held:
                rows = []
                for n, spans, names in found[at : at + batch.num_rows]:
                    hit = sum(b - a for a, b in spans)
                    rows.append({
                        "n_words": n, "n_hit": hit, "n_items": len(names), "contaminated": hit > 0, "items": names,
                        "items_sha256": hashlib.sha256(",".join(names).encode()).hexdigest(),
                        "spans": [{"start": a, "end": b} for a, b in spans]})
                at += batch.num_rows
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["doc", "found"])

        held, texts, size = [], [], 0
        for batch in batches:
            held.append(batch)
            texts += batch.column(1).to_pylist()
            size += batch.column(1).nbytes // 7
            if size >= SHARD_WORDS:
                yield from shard(held, texts)
                held, texts, size = [], [], 0
        if held:
            yield from shard(held, texts)

    return packed.mapInArrow(search, schema)


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, ``n_words, n_hit, n_items, items_sha256, contaminated, spans``."""
    found = decontaminate(docs.select(id_col, text_col), benchmark, text_col=text_col)
    return found.select(F.col(f"doc.{id_col}").alias(id_col), *[
        f"found.{c}" for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans")])
