"""Near-duplicates by improved consistent weighted sampling, banded and verified.

A text is a weighted set of its five-word shingles; a shorter one is one shingle.
A shingle's weight is its count in the text times its inverse document frequency,
taken as the mean of its words' (all but a few five-word runs are as rare as their
text has copies, so their own frequency would only tell copies apart).  For each
of 40 hash functions a text's sample is the shingle and quantised weight with the
smallest hash; two texts agree on a sample with a probability equal to their
weighted Jaccard similarity.  Four samples make a band, and texts that agree on
any of ten bands are candidates: at similarity 0.8 all but 1 in 200 pairs.

Every text is compared with the first text of each of its buckets.  Where that
fails in a bucket of three or more, the bucket's texts are compared with the first
text of each of their rarest shingles (of similar texts, the rarest fifth of the
weight must have one in common).  After that all pairs of such a bucket that aren't
in one class yet are compared, block by block; left out are only texts that share
none of both's rarest shingles with another class and texts whose weights differ
too much, which can't be similar.  So of each bucket every similar pair is in one
class.  Links are verified similarities, and classes their connected components.
Exact copies count as one text throughout.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from panelprep.llm.chunks import BLOCK_WORDS, CHUNK_BYTES, answered, block_count, hashes_of, joined_answer, pack, summed_words, unpack, word_blocks, write_chunks
from panelprep.llm.common import discard, stored, text_or_empty

WORDS = 5
BANDS, ROWS = 10, 4
THRESHOLD = 0.8
PART = 48  # candidates of a text that are compared with it in one group
BLOCK = 512  # texts, and
BLOCK_SHINGLES = 200_000  # shingles of a block, two of which are compared in one group
HUB = 1024  # links that a text keeps itself
_COLUMNS = 4096

_TABLE = 1 << 16
_SHINGLE_BITS = 48


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r and ln c of Gamma(2, 1) and beta of the unit interval; a shingle's hash picks an entry for each function."""
    rng = np.random.default_rng(20)
    return rng.gamma(2, 1, _TABLE), np.log(rng.gamma(2, 1, _TABLE)), rng.random(_TABLE)


_R, _LOG_C, _BETA = _draws()


class Texts:
    """Weighted shingle sets of a chunk's texts, sorted by text and shingle."""

    def __init__(self, row: dict, n_docs: int, only: np.ndarray | None = None):
        hashes = hashes_of(row)
        idf = 1 + np.log((n_docs + 1) / (joined_answer(row["words"], "counts", np.int64) + 1))
        lengths = unpack(row["lengths"], np.int64)
        tokens = unpack(row["tokens"], np.uint32)
        starts = np.cumsum(lengths) - lengths
        docs = np.flatnonzero(lengths > 0) if only is None else only[lengths[only] > 0]
        sizes = np.maximum(1, lengths[docs] - WORDS + 1)
        doc = np.repeat(np.arange(len(docs)), sizes)
        within = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = starts[docs][doc] + within
        words = np.minimum(WORDS, lengths[docs])[doc]
        code = words.astype(np.uint64)
        weight = np.zeros(len(doc))
        for j in range(WORDS):
            live = words > j
            token = tokens[np.where(live, at + j, at)]
            code = np.where(live, _mix(code * np.uint64(0x9E3779B97F4A7C15) + hashes[token]), code)
            weight += np.where(live, idf[token], 0)
        code >>= np.uint64(64 - _SHINGLE_BITS)
        weight /= words
        order = np.lexsort((code, doc))
        code, doc, weight = code[order], doc[order], weight[order]
        new = np.ones(len(code), bool)
        new[1:] = (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        count = np.diff(first, append=len(code))
        self.docs, self.shingle, self.weight = docs, code[first], weight[first] * count
        self.ends = np.searchsorted(doc[first], np.arange(len(docs)), side="right")
        self.starts = np.concatenate(([0], self.ends[:-1])) if len(docs) else self.ends

    def samples(self, functions: int) -> np.ndarray:
        """For each text and function a 64-bit digest of the sampled shingle and quantised weight."""
        out = np.zeros((len(self.docs), functions), np.uint64)
        a = 0
        while a < len(self.docs):  # parts that fit the cache
            b = max(a + 1, int(np.searchsorted(self.ends, self.starts[a] + 50_000, side="right")))
            lo, hi = self.starts[a], self.ends[b - 1]
            shingle, log_w = self.shingle[lo:hi], np.log(self.weight[lo:hi])
            offsets, sizes = self.starts[a:b] - lo, self.ends[a:b] - self.starts[a:b]
            for f in range(functions):
                pick = ((shingle + np.uint64(f)) * np.uint64(0x9E3779B97F4A7C15 + 2 * f * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF) >> np.uint64(48)).astype(np.int64)
                r, beta = _R[pick], _BETA[pick]
                t = np.floor(log_w / r + beta)
                log_a = _LOG_C[pick] - r * (t - beta + 1)
                least = np.minimum.reduceat(log_a, offsets)
                hit = np.flatnonzero(log_a == np.repeat(least, sizes))
                hit = hit[np.searchsorted(hit, offsets)]  # the first of equals
                out[a:b, f] = _mix(shingle[hit] ^ _mix(t[hit].astype(np.int64).astype(np.uint64) + np.uint64(f)))
            a = b
        return out


def _bands(samples: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(samples), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(samples), band + 1, np.uint64)
        for row in range(rows):
            key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + samples[:, band * rows + row])
        out[:, band] = key
    return out


def _document_counts(row: dict, kinds: int) -> np.ndarray:
    """In how many of the chunk's texts each word is."""
    lengths = unpack(row["lengths"], np.int64)
    tokens = unpack(row["tokens"], np.uint32).astype(np.int64)
    return np.bincount(np.unique(np.repeat(np.arange(len(lengths)), lengths) * kinds + tokens) % kinds, minlength=kinds)


def _signatures(joined: DataFrame, n_docs: int, bands: int, rows: int) -> DataFrame:
    kind = joined.schema["ks"].dataType.elementType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.to_pylist()):
                n = len(row["ks"])
                texts = Texts(row, n_docs)
                keys = _bands(texts.samples(bands * rows), bands, rows).view(np.int64)
                sizes = np.zeros(n, np.int64)
                sizes[texts.docs] = bands
                ks = batch.column(batch.schema.get_field_index("ks"))[i].values
                yield pa.RecordBatch.from_arrays([
                    ks, pa.array(np.full(n, row["chunk"])), pa.array(np.arange(n, dtype=np.int32)),
                    pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(keys.ravel())),
                ], names=["k", "chunk", "nth", "bands"])

    return joined.mapInArrow(sign, f"k {kind}, chunk long, nth int, bands array<long>")


def _vectors(joined: DataFrame, wanted: DataFrame, n_docs: int) -> DataFrame:
    """Shingle sets of the wanted texts ``(key, chunk, nth)``: ``key, shingles, weights``, their number and total weight."""
    per_chunk = wanted.groupBy("chunk").agg(F.collect_list(F.struct("nth", "key")).alias("wanted"))  # texts of one chunk at most

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys = {w["nth"]: w["key"] for w in row["wanted"]}
                texts = Texts(row, n_docs, np.array(sorted(keys), np.int64))
                yield pa.RecordBatch.from_arrays([
                    pa.array([keys[d] for d in texts.docs.tolist()], pa.string()),
                    pa.array([pack(texts.shingle[a:b]) for a, b in zip(texts.starts, texts.ends)], pa.binary()),
                    pa.array([pack(texts.weight[a:b]) for a, b in zip(texts.starts, texts.ends)], pa.binary()),
                    pa.array(texts.ends - texts.starts, pa.int64()),
                    pa.array([texts.weight[a:b].sum() for a, b in zip(texts.starts, texts.ends)], pa.float64()),
                ], names=["key", "shingles", "weights", "size", "total"])

    return joined.join(per_chunk, "chunk").mapInArrow(build, "key string, shingles binary, weights binary, size long, total double")


def _similarity(left: np.ndarray, w: np.ndarray, right: np.ndarray, v: np.ndarray) -> float:
    _, i, j = np.intersect1d(left, right, True, True)
    both = np.minimum(w[i], v[j]).sum()
    return both / (w.sum() + v.sum() - both)


def _similarities(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Exact weighted Jaccard similarity of pairs ``(a, b)``.

    Each ``a`` is sent once to every part of some dozens of its ``b``, so that a
    text with very many candidates is compared in many tasks.
    """
    per_text = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(PART)).alias("parts"))
    placed = pairs.join(per_text, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"))
    rows = placed.select("a", "part", F.col("b").alias("key")).unionByName(placed.select("a", "part", F.col("a").alias("key")).distinct())

    def compare(table: pa.Table) -> pa.Table:
        a, keys = table.column("a")[0].as_py(), table.column("key").to_pylist()
        shingles, weights = table.column("shingles"), table.column("weights")
        first = keys.index(a)
        left, w = unpack(shingles[first].as_py(), np.uint64), unpack(weights[first].as_py(), float)
        out = []
        for k in range(len(keys)):
            if k != first:
                out.append((a, keys[k], _similarity(left, w, unpack(shingles[k].as_py(), np.uint64), unpack(weights[k].as_py(), float))))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.string(), pa.float64()))], names=["a", "b", "similarity"])

    return rows.join(vectors.select("key", "shingles", "weights"), "key").groupBy("a", "part").applyInArrow(compare, "a string, b string, similarity double")


def _rarest(keys: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """``shingle, key``: the rarest shingles of the texts in ``keys``, of which two similar texts must share one."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, shingles, weights in zip(*(c.to_pylist() for c in batch.columns)):
                values, w = unpack(shingles, np.uint64), unpack(weights, float)
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(values)), pa.array(values.view(np.int64)), pa.array(w)], names=["key", "shingle", "w"])

    rows = stored(vectors.join(keys, "key", "left_semi").select("key", "shingles", "weights").mapInArrow(
        spread, "key string, shingle long, w double"), "rare")
    counted = rows.join(rows.groupBy("shingle").count(), "shingle")
    before = Window.partitionBy("key").orderBy("count", "shingle")  # one text
    return counted.withColumn("upto", F.sum("w").over(before.rowsBetween(Window.unboundedPreceding, -1))).withColumn(
        "all", F.sum("w").over(Window.partitionBy("key"))).where(
        (F.coalesce("upto", F.lit(0.0)) <= (1 - threshold) * F.col("all") * (1 + 1e-9)) & (F.col("count") > 1)).select("shingle", "key")


def _common_weights(sets: list[tuple[np.ndarray, np.ndarray]], second: np.ndarray) -> np.ndarray:
    """Sums of the smaller weights of common shingles: texts not in ``second`` by those in it, or all by all where none is.

    A shingle is a column for each weight it has, worth what this exceeds the next
    smaller one by, and a text has the columns up to its weight.
    """
    code, w = np.concatenate([s for s, _ in sets]), np.concatenate([v for _, v in sets])
    text = np.repeat(np.arange(len(sets)), [len(s) for s, _ in sets])
    order = np.lexsort((w, code))
    code, w, text = code[order], w[order], text[order]
    other = np.append(True, code[1:] != code[:-1])
    new = other | np.append(True, w[1:] != w[:-1])
    column = np.cumsum(new) - 1
    lowest = column[np.flatnonzero(other)][np.cumsum(other) - 1]
    worth = np.where(other[new], w[new], np.diff(w[new], prepend=0))
    upto = column - lowest + 1
    text = np.repeat(text, upto)
    column = np.repeat(lowest, upto) + np.arange(len(text)) - np.repeat(np.cumsum(upto) - upto, upto)
    right = second if second.any() else np.ones(len(sets), bool)
    left = ~second
    shared = np.bincount(column[left[text]], minlength=len(worth)) * np.bincount(column[right[text]], minlength=len(worth)) > (0 if second.any() else 1)
    text, column = text[shared[column]], (np.cumsum(shared) - 1)[column[shared[column]]]
    worth = worth[shared]
    order = np.argsort(column, kind="stable")
    text, column = text[order], column[order]
    out = np.zeros((left.sum(), right.sum()))
    for a in range(0, len(worth), _COLUMNS):
        lo, hi = np.searchsorted(column, [a, a + _COLUMNS])
        has = np.zeros((len(sets), min(_COLUMNS, len(worth) - a)))
        has[text[lo:hi], column[lo:hi] - a] = 1
        out += (has[left] * worth[a : a + _COLUMNS]) @ has[right].T
    return out


def _joined_labels(table: pa.Table, threshold: float) -> pa.Table:
    """Labels of one block, or of two, that similar texts join: as many links as are needed for that."""
    labels, second = table.column("label").to_pylist(), np.array(table.column("second").to_pylist(), bool)
    sets = [(unpack(s, np.uint64), unpack(w, float)) for s, w in zip(table.column("shingles").to_pylist(), table.column("weights").to_pylist())]
    above: dict[str, str] = {}

    def root(label: str) -> str:
        while label in above:
            label = above[label]
        return label

    out = []
    if not second.all():
        rows, columns = np.flatnonzero(~second), np.flatnonzero(second if second.any() else ~second)
        total = np.array([w.sum() for _, w in sets])
        number = np.unique(labels, return_inverse=True)[1]
        both = _common_weights(sets, second)
        near = (both >= (threshold - 1e-9) * (total[rows][:, None] + total[columns] - both)) & (number[rows][:, None] != number[columns])
        for i, j in np.argwhere(near).tolist():
            i, j = rows[i], columns[j]
            a, b = sorted((root(labels[i]), root(labels[j])))
            if a != b and _similarity(*sets[i], *sets[j]) >= threshold:
                above[b] = a
                out.append((a, b))
    return pa.table([pa.array([p[k] for p in out], pa.string()) for k in range(2)], names=["a", "b"])


def _rest_of_buckets(members: DataFrame, vectors: DataFrame, threshold: float, block: int, block_shingles: int) -> DataFrame:
    """Links ``(a, b)`` of labels by all pairs of a bucket's texts (``bucket, key, label``) with different labels.

    A bucket is cut into blocks: labels with many texts have blocks of their own,
    which aren't compared among themselves, the others by ranges of the weight.
    Only neighbouring ranges can hold similar texts.
    """
    width = -math.log(max(threshold, 1e-9) * (1 - 1e-9))
    sized = members.join(vectors.select("key", "size", "total"), "key")
    whole = sized.groupBy("bucket").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("n_shingles")).where(
        "low <> high").select("bucket", ((F.col("n") <= block) & (F.col("n_shingles") <= block_shingles)).alias("one"))
    of_label = sized.groupBy("bucket", "label").agg((F.count(F.lit(1)) >= block).alias("many"))
    ranged = stored(sized.join(whole, "bucket").join(of_label, ["bucket", "label"]).select(
        "bucket", "key", "label", "size", F.when(F.col("many") & ~F.col("one"), F.col("label")).otherwise(F.lit("")).alias("own"),
        F.when(F.col("one"), F.lit(0)).otherwise(F.floor(F.log("total") / F.lit(width))).cast("long").alias("range")), "ranged")
    parts = ranged.groupBy("bucket", "own", "range").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / F.lit(block), F.sum("size") / F.lit(block_shingles))).cast("int").alias("parts"))
    blocks = parts.select("bucket", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "own", "range").select(
        "bucket", F.struct("own", "range", "part").alias("block"))
    x, y = F.col("x"), F.col("y")
    pairs = stored(blocks.withColumnRenamed("block", "x").join(blocks.withColumnRenamed("block", "y"), "bucket").where(
        (x <= y) & ((x["own"] == "") | (x["own"] != y["own"])) & (F.abs(x["range"] - y["range"]) <= 1)), "block_pairs")
    to = pairs.select("bucket", "x", "y", x.alias("block"), F.lit(False).alias("second")).unionByName(
        pairs.where(x != y).select("bucket", "x", "y", y.alias("block"), F.lit(True).alias("second")))
    placed = ranged.join(parts, ["bucket", "own", "range"]).select(
        "bucket", "key", "label", F.struct("own", "range", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part")).alias("block"))
    return placed.join(to, ["bucket", "block"]).join(vectors.select("key", "shingles", "weights"), "key").select(
        "bucket", "x", "y", "second", "label", "shingles", "weights").groupBy("bucket", "x", "y").applyInArrow(
        lambda table: _joined_labels(table, threshold), "a string, b string").distinct()


def _thinned(links: DataFrame, seed: int) -> DataFrame:
    """Links of the same components in which ``a`` has a thousandth of its links: the others go to one of some thousand of its partners."""
    placed = links.select("a", "b", F.pmod(F.xxhash64(F.lit(seed), "b"), F.lit(HUB)).alias("part"))
    partner = placed.groupBy("a", "part").agg(F.min("b").alias("partner"))
    moved = placed.join(partner, ["a", "part"]).where("b <> partner").select(F.col("partner").alias("a"), "b")
    return moved.unionByName(partner.select("a", F.col("partner").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``key, label`` of all linked keys: the smallest key of each connected component.

    Each round takes the smallest label of a key's neighbours and then its label's
    label, so a path of n links takes about log n rounds.  A key ``a`` that very many
    are linked to isn't one task: its links are first dealt to some thousand of its
    partners, and theirs once more.
    """
    links = _thinned(stored(_thinned(links.select("a", "b").distinct(), 1), "links_dealt"), 2)
    edges = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = edges.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("near")).select("key", F.least("key", "near").alias("label"))
    labels, nth = stored(labels, "labels0"), 0
    before = labels
    while True:
        nth += 1
        near = edges.join(labels.select(F.col("key").alias("b"), "label"), "b").groupBy(F.col("a").alias("key")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "key").select("key", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("key").alias("next"), F.col("label").alias("jump"))
        moved = stored(lower.join(jump, "next").select("key", F.col("label").alias("old"), F.least("next", "jump").alias("label")), f"labels{nth}")
        discard(before)
        before, labels = moved, moved.select("key", "label")
        if not moved.where("old <> label").head(1):
            discard(edges)
            return labels


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id",
                    text_col: str = "text", block_words: int = BLOCK_WORDS, chunk_bytes: int = CHUNK_BYTES,
                    block: int = BLOCK, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """A row per input row: ``id, key, class_id, class_key, n_class, n_copies``.

    ``key`` identifies the text (a null text is an empty one), ``class_id`` is the
    smallest id of its class and ``class_key`` a text that has this id, ``n_class``
    the class's rows and ``n_copies`` the rows with exactly this text.  Texts without
    words are alike only if they are equal.  A null id is never a class's id while
    the class has another.  Repeated rows are copies; an empty table gives no rows;
    other columns are ignored.
    """
    text = text_or_empty(text_col).cast("binary")
    keyed = docs.select(F.struct(F.col(id_col).alias("id"), F.md5(text).alias("key")).alias("k"), text.alias("text"))
    chunks = write_chunks(keyed, bytes.split, False, chunk_bytes)
    tokens, n_docs = chunks.agg(F.sum("n_tokens"), F.sum(F.size("ks"))).first()
    blocks = block_count(tokens or 0, block_words)
    counted = stored(summed_words(word_blocks(chunks, blocks, _document_counts), blocks), "words")
    joined = answered(chunks, counted.where("chunk is not null"), ["counts"], "words")
    signed = stored(_signatures(joined, n_docs or 0, bands, rows), "signatures")

    texts = stored(signed.groupBy("k.key").agg(
        F.min(F.struct("chunk", "nth")).alias("at"), F.first("bands").alias("bands"), F.count(F.lit(1)).alias("n"),
        F.min("k.id").alias("id")), "texts")
    banded = texts.select("key", F.explode("bands").alias("bucket"))
    buckets = stored(banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("key").alias("first")).where("size > 1"), "buckets")
    members = stored(banded.join(buckets, "bucket").where("key <> first"), "members")
    pairs = stored(members.select(F.col("first").alias("a"), F.col("key").alias("b")).distinct(), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct().join(texts, "key").select("key", "at.chunk", "at.nth")
    vectors = stored(_vectors(joined, wanted, n_docs or 0), "vectors")
    compared = stored(_similarities(pairs, vectors), "compared")

    failed = members.where("size > 2").join(compared.where(F.col("similarity") < threshold).select(
        F.col("a").alias("first"), F.col("b").alias("key")), ["first", "key"], "left_semi").select("bucket").distinct()
    held = members.join(failed, "bucket", "left_semi")
    held = stored(held.select("bucket", "key").unionByName(held.select("bucket", F.col("first").alias("key")).distinct()), "held")
    rarest = stored(_rarest(held.select("key").distinct(), vectors, threshold), "rarest")
    firsts = rarest.groupBy("shingle").agg(F.min("key").alias("a"))
    rare = rarest.join(firsts, "shingle").where("a < key").select("a", F.col("key").alias("b")).distinct().join(compared, ["a", "b"], "left_anti")
    more = stored(_similarities(rare, vectors), "compared_again")
    links = stored(compared.unionByName(more).where(F.col("similarity") >= threshold).select("a", "b"), "links")

    labels = components(links)
    label = F.coalesce("label", "key").alias("label")
    # texts that share one of both's rarest shingles with another class
    shared = rarest.join(labels, "key", "left").select("shingle", "key", label)
    mixed = shared.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    apart = shared.join(mixed, "shingle", "left_semi").select("key", "label").distinct()
    wider = components(stored(_rest_of_buckets(held.join(apart, "key"), vectors, threshold, block, block_shingles), "wider"))
    discard(chunks, counted, buckets, members, pairs, vectors, compared, held, rarest, more, links)
    labels = texts.select("key").join(labels, "key", "left").select("key", label).join(
        wider.select(F.col("key").alias("label"), F.col("label").alias("wider")), "label", "left").select("key", F.coalesce("wider", "label").alias("label"))
    labelled = texts.select("key", "id", "n").join(labels, "key")
    classes = labelled.groupBy("label").agg(F.min("id").alias("class_id"), F.sum("n").alias("n_class"),
                                            F.min_by("key", F.struct(F.col("id").isNull(), "id", "key")).alias("class_key"))
    found = labelled.join(classes, "label").select("key", "class_id", "class_key", "n_class", F.col("n").alias("n_copies"))
    return signed.select(F.col("k.id").alias(id_col), F.col("k.key").alias("key")).join(found, "key").select(
        id_col, "key", "class_id", "class_key", "n_class", "n_copies")


def one_of_each(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class: the one with the class's id, of equal ones any; rows and columns unchanged."""
    key = F.md5(text_or_empty(text_col).cast("binary"))
    kept = found.select(F.col("class_key").alias("_key")).distinct()
    first = docs.select(key.alias("_key"), F.col(id_col).alias("_id"), F.struct(*[docs[c] for c in docs.columns]).alias("_doc")).groupBy("_key").agg(
        F.min_by("_doc", F.struct(F.col("_id").isNull(), "_id")).alias("_doc"))  # combined before the shuffle
    return first.join(kept, "_key", "left_semi").select("_doc.*")
