"""Katz backoff language model of word pairs, or of longer runs of words.

P(w | h) is the Good-Turing discounted share of w after h if the run was seen in
training, else the weight of h times P(w | h without its first word).  The weight
is what the discounts left over h, divided by the probability that the shorter
history gives all words not seen after h, so that the probabilities after every h
add up to 1.  P(w) is discounted likewise; what's left is the probability of the
one unknown word.  A text starts after a start mark and ends with an end token.

Counts are gathered over all training documents in blocks (see
:mod:`panelprep.llm.chunks`), order by order: words by ranges of their hash, runs
by ranges of their context's hash, a frequent context split over more blocks by
its words.  A context is a run of the order below, by the number it got there.
Tokens are evaluated recursively: the probabilities of one order, per different
run of a chunk, are what the next one backs off to.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelprep.llm.chunks import BLOCK_WORDS, CHUNK_BYTES, answered, block_count, block_of, cuts, joined_answer, pack, summed_words, unpack, word_blocks, write_chunks
from panelprep.llm.common import fold, stored, text_or_empty

TOP = 5  # counts up to this are discounted
SPLIT = 1_000_000  # a context with more training tokens is split into parts of about so many
FEW = 200_000  # split contexts, some hundred bytes each, that are sent to all tasks

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_LOWER).split()


def discounts(count_of_counts: dict[int, int], top: int = TOP) -> np.ndarray:
    """Good-Turing discount of the counts 0 (unused) to ``top``.

    d_r = (r*/r - A) / (1 - A) with r* = (r+1) n_{r+1} / n_r and A = (top+1) n_{top+1} / n_1.
    Where the counts give no value between 0 and 1, as in tiny corpora, it's (r - 1/2) / r.
    """
    n = [count_of_counts.get(r, 0) for r in range(top + 2)]
    out = np.ones(top + 1)
    rest = (top + 1) * n[top + 1] / n[1] if n[1] else 1.0
    for r in range(1, top + 1):
        value = ((r + 1) * n[r + 1] / (r * n[r]) - rest) / (1 - rest) if n[r] and rest != 1 else 0.0
        out[r] = value if 0 < value < 1 else (r - 0.5) / r
    return out


@dataclass
class Words:
    """P(w) as a function of the word's training count."""

    discount: np.ndarray
    total: int
    kinds: int
    unknown: float
    divisor: int

    @classmethod
    def of(cls, count_of_counts: dict[int, int], total: int, kinds: int) -> Words:
        d = discounts(count_of_counts)
        left = sum(r * (1 - d[r]) * count_of_counts.get(r, 0) for r in range(1, TOP + 1))
        divisor = total if left > 0 else total + 1  # no count to discount: one is set aside
        return cls(d, total, kinds, (left or 1) / divisor if divisor else 1.0, max(divisor, 1))

    def p(self, count: np.ndarray) -> np.ndarray:
        return np.where(count > 0, count * self.discount[np.minimum(count, TOP + 1) % (TOP + 1)] / self.divisor, self.unknown)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Model:
    """What all tasks know: sizes, and the discounts of the orders counted so far."""

    train_docs: int
    blocks: int
    split: int
    words: Words
    discount: dict[int, np.ndarray]


class Grams:
    """A chunk's different runs of one order, in the order in which they are sent, and the blocks they go to."""

    def __init__(self, chunk: Chunk, below: Grams | None, model: Model):
        self.below, kinds = below, len(chunk.number)
        of, number, count = (chunk.tokens, chunk.number, chunk.count) if below is None else (below.which, below.number, below.count)
        before = np.concatenate(([0], of[:-1] + 1))
        before[np.cumsum(chunk.lengths) - chunk.lengths] = 0  # context 0 is the start mark; run i of the order below is context i + 1
        codes, self.which = np.unique(before * kinds + chunk.tokens, return_inverse=True)
        self.context, self.word = codes // kinds, codes % kinds
        self.context_number = np.concatenate(([0], number))
        self.context_count = np.concatenate(([model.train_docs], count))
        # blocks: of the context, or for a frequent one of context and word
        base = _mix(self.context_number.astype(np.uint64) + np.uint64(1))
        self.parts = np.minimum(np.maximum(1, -(-self.context_count // model.split)), model.blocks)
        part = (_mix(chunk.number[self.word]) % self.parts[self.context].astype(np.uint64)).astype(np.int64)
        block = (block_of(base, model.blocks).astype(np.int64)[self.context] + part) % model.blocks
        self.order = np.argsort(block * len(self.context_number) + self.context, kind="stable")
        self.sent_block, self.sent_context = block[self.order], self.context[self.order]
        if below is None:
            self.lower = model.words.p(chunk.count)[self.word]
        else:
            suffix = np.empty(len(codes), np.int64)  # each run without its first word
            suffix[self.which] = below.which
            self.lower = below.p[suffix]

    def runs(self, a: int, z: int) -> tuple[np.ndarray, np.ndarray]:
        """Of a block's part of what is sent: its contexts, and where each begins."""
        context = self.sent_context[a:z]
        first = np.concatenate(([0], np.flatnonzero(np.diff(context)) + 1))
        return context[first], first

    def load(self, answers: list[dict], split: list[dict] | None, discount: np.ndarray) -> None:
        """Counts and numbers, and with them the probabilities."""
        self.count, self.number = np.zeros(len(self.word), np.int64), np.zeros(len(self.word), np.int64)
        self.count[self.order] = joined_answer(answers, "counts", np.int64)
        if answers[0]["numbers"] is not None:
            self.number[self.order] = joined_answer(answers, "numbers", np.int64)
        lows, mass = np.zeros((len(self.context_number), TOP)), np.zeros(len(self.context_number))
        asked = np.zeros(len(mass), bool)
        sent = {block: (a, z) for block, a, z in cuts(self.sent_block)}
        for answer in answers:
            mine = self.runs(*sent[answer["block"]])[0][unpack(answer["contexts"], np.int64)]
            lows[mine] = unpack(answer["lows"], np.int64).reshape(-1, TOP)
            mass[mine] = unpack(answer["masses"], np.float64)
            asked[mine] = True
        of_number = np.argsort(self.context_number)
        for part in split or []:
            mine = of_number[np.searchsorted(self.context_number, part["context"], sorter=of_number)]
            lows[mine], mass[mine], asked[mine] = part["lows"], part["mass"], True
        # what the discounts leave of each context's count; where there is nothing to discount, one is set aside
        left = lows @ (np.arange(1, TOP + 1) * (1 - discount[1:]))
        aside = asked & (left == 0)
        c, n = self.context, (self.context_count + aside)[self.context]
        with np.errstate(divide="ignore", invalid="ignore"):
            direct = self.count * discount[np.minimum(self.count, TOP + 1) % (TOP + 1)] / n
            weight = np.where(self.context_count[c] > 0, np.where(aside, 1.0, left)[c] / n / (1 - mass[c]), 1.0)
            self.p = np.where(self.count > 0, direct, weight * self.lower)


class Chunk:
    """A chunk's words, and its runs of each order up to one; the last one's answers needn't be known yet."""

    def __init__(self, row: dict, model: Model, order: int):
        self.lengths = unpack(row["lengths"], np.int64)
        self.tokens = unpack(row["tokens"], np.uint32).astype(np.int64)
        self.number = joined_answer(row["words"], "keys", np.int64)
        self.count = joined_answer(row["words"], "counts", np.int64)
        self.held = np.array([k["held"] for k in row["ks"]], bool)
        self.grams: Grams | None = None
        for k in range(2, order + 1):
            self.grams = Grams(self, self.grams, model)
            if f"order{k}" in row:
                self.grams.load(row[f"order{k}"], row[f"split{k}"], model.discount[k])


_SENT = "block long, chunk long, contexts binary, runs binary, words binary, lower binary, counts binary, split binary"
_KEPT = "block long, chunk long, contexts binary, runs binary, words binary, counts binary, lows binary, masses binary, numbers binary"
_OF_PARTS = -1  # for a chunk: the rows that hold what a block has of split contexts


def _send(joined: DataFrame, model: Model, order: int) -> DataFrame:
    """The chunks' runs of one order in blocks; ``lower`` is what P(w | shorter history) comes from."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row, model, order)
                grams = chunk.grams
                train = np.bincount(grams.which[np.repeat(~chunk.held, chunk.lengths)], minlength=len(grams.word))
                word = grams.word[grams.order]
                number, count = chunk.number[word], train[grams.order].astype(np.uint32)
                lower = chunk.count[word].astype(np.uint32) if order == 2 else grams.lower[grams.order]
                out = []
                for block, a, z in cuts(grams.sent_block):
                    held, first = grams.runs(a, z)
                    out.append((block, row["chunk"], pack(grams.context_number[held]), pack(np.diff(first, append=z - a).astype(np.uint32)),
                                pack(number[a:z]), pack(lower[a:z]), pack(count[a:z]), pack(grams.parts[held] > 1)))
                kinds = [pa.int64()] * 2 + [pa.binary()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[c.split()[0] for c in _SENT.split(", ")])

    return joined.mapInArrow(send, _SENT)


def _sum(sent: DataFrame, model: Model, order: int, more: bool) -> DataFrame:
    """Rows without a chunk are the table of counts; the others answer a chunk's block.

    An answer has each run's count (and number, if a longer order follows) and, for
    contexts that may have to back off (one of the chunk's runs is unseen, or all
    counts are high), how many runs have each low count and the P(w | shorter
    history) of all seen words.  Of a split context a block has a part only; that
    goes to a row of its own, under the chunk ``_OF_PARTS``.
    """

    def add(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        contexts = [unpack(r["contexts"], np.int64) for r in rows]
        runs = [unpack(r["runs"], np.uint32).astype(np.int64) for r in rows]
        numbers = [unpack(r["words"], np.int64) for r in rows]
        kinds, context_of_run = np.unique(np.concatenate(contexts), return_inverse=True)
        context = np.repeat(context_of_run, np.concatenate(runs))
        known, word = np.unique(np.concatenate(numbers), return_inverse=True)
        gram, which = np.unique(context * len(known) + word, return_inverse=True)
        total = np.bincount(which, np.concatenate([unpack(r["counts"], np.uint32) for r in rows]), len(gram)).astype(np.int64)
        lower = np.zeros(len(gram), np.int64 if order == 2 else np.float64)
        lower[which] = np.concatenate([unpack(r["lower"], np.uint32 if order == 2 else np.float64) for r in rows])
        gram_context = gram // len(known)
        seen = total > 0
        lows = np.stack([np.bincount(gram_context[total == r], minlength=len(kinds)) for r in range(1, TOP + 1)], axis=1)
        masses = np.bincount(gram_context[seen], model.words.p(lower[seen]) if order == 2 else lower[seen], len(kinds))
        kept_context = gram_context[seen]
        kept, run = np.unique(kept_context, return_counts=True)
        block = rows[0]["block"]
        out = [(block, None, pack(kinds[kept]), pack(run.astype(np.uint32)), pack(known[gram[seen] % len(known)]), pack(total[seen]), None, None, None)]
        split = np.zeros(len(kinds), bool)
        split[context_of_run] = np.concatenate([unpack(r["split"], bool) for r in rows])
        parts = np.flatnonzero(split)
        if len(parts):
            out.append((block, _OF_PARTS, pack(kinds[parts]), None, None, None, pack(lows[parts].ravel()), pack(masses[parts]), None))
        at = at_run = 0
        for row, mine_contexts, mine_runs, mine in zip(rows, contexts, runs, numbers):
            own = which[at : at + len(mine)]
            counts = total[own]
            of = context_of_run[at_run : at_run + len(mine_contexts)]
            at, at_run = at + len(mine), at_run + len(mine_contexts)
            run_of = np.repeat(np.arange(len(of)), mine_runs)
            unseen = np.bincount(run_of[counts == 0], minlength=len(of)) > 0
            need = np.flatnonzero((unseen | (lows[of].sum(axis=1) == 0)) & ~split[of])
            out.append((block, row["chunk"], pack(need), None, None, pack(counts), pack(lows[of[need]].ravel()), pack(masses[of[need]]),
                        pack(own * model.blocks + block + 1) if more else None))
        kinds_of = [pa.int64()] * 2 + [pa.binary()] * 7
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds_of)], names=[c.split()[0] for c in _KEPT.split(", ")])

    return sent.groupBy("block").applyInArrow(add, _KEPT)


def _split_contexts(table: DataFrame) -> DataFrame:
    """Split contexts: ``context, lows, mass`` summed over their blocks.  At most one context for every ``split`` training tokens."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for contexts, lows, masses in zip(*(batch.column(k).to_pylist() for k in range(3))):
                low = unpack(lows, np.int64).reshape(-1, TOP)
                yield pa.RecordBatch.from_arrays([pa.array(unpack(contexts, np.int64)), *(pa.array(low[:, k]) for k in range(TOP)), pa.array(unpack(masses, np.float64))],
                                                 names=["context", *(f"low{k}" for k in range(TOP)), "mass"])

    rows = table.where(F.col("chunk") == _OF_PARTS).select("contexts", "lows", "masses").mapInArrow(
        spread, "context long, " + ", ".join(f"low{k} long" for k in range(TOP)) + ", mass double")
    return rows.groupBy("context").agg(F.array(*(F.sum(f"low{k}") for k in range(TOP))).alias("lows"), F.sum("mass").alias("mass"))


def _asked_contexts(joined: DataFrame, model: Model, order: int) -> DataFrame:
    """``chunk, context`` of the split contexts that a chunk has."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if order == 2:
                    numbers, counts = joined_answer(row["words"], "keys", np.int64), joined_answer(row["words"], "counts", np.int64)
                else:
                    below = Chunk(row, model, order - 1).grams
                    numbers, counts = below.number, below.count
                found = np.concatenate(([0], numbers))[np.concatenate(([model.train_docs], counts)) > model.split]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), row["chunk"], np.int64)), pa.array(found)], names=["chunk", "context"])

    needed = joined.select("chunk", "words") if order == 2 else joined
    return needed.mapInArrow(ask, "chunk long, context long")


def _count_of_counts(table: DataFrame) -> tuple[dict[int, int], int, int]:
    """Of a table's packed counts: how many have each low value, the sum, and how many are above 0."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                values = unpack(blob, np.int64)
                low = np.bincount(values[values <= TOP + 1], minlength=TOP + 2)
                yield pa.RecordBatch.from_arrays([
                    pa.array([*range(1, TOP + 2), -1, -2], pa.int64()), pa.array([*low[1:].tolist(), int(values.sum()), int((values > 0).sum())], pa.int64()),
                ], names=["r", "n"])

    rows = {r["r"]: r["n"] for r in table.where("chunk is null").select("counts").mapInArrow(count, "r long, n long").groupBy("r").agg(
        F.sum("n").alias("n")).collect()}  # TOP + 3 rows
    return {r: n for r, n in rows.items() if r > 0}, rows.get(-1, 0), rows.get(-2, 0)


def _evaluate(joined: DataFrame, model: Model, order: int) -> DataFrame:
    kind = joined.schema["ks"].dataType.elementType["id"].dataType.simpleString()
    words = model.words

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.to_pylist()):
                chunk = Chunk(row, model, order)
                with np.errstate(divide="ignore"):
                    log_p = np.log10(chunk.grams.p)
                base = np.log10((chunk.count + 1) / (words.total + words.kinds + 1))
                ends = np.cumsum(chunk.lengths)
                sums = [np.add.reduceat(v, ends - chunk.lengths) for v in (
                    log_p[chunk.grams.which], base[chunk.tokens], (chunk.count > 0)[chunk.tokens].astype(np.int64))]
                size = len(ends)
                ks = batch.column(batch.schema.get_field_index("ks"))[i].values
                yield pa.RecordBatch.from_arrays([
                    ks.field("id"), pa.array(chunk.held), pa.array(chunk.lengths), pa.array(sums[2]),
                    pa.array(np.full(size, words.total, np.int64)), pa.array(sums[1]), pa.array(sums[0]),
                ], names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return joined.mapInArrow(score, f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score(docs: DataFrame, folds: int = 7, hold: int = 2, order: int = 2, id_col: str = "doc_id", text_col: str = "text",
          split: int = SPLIT, block_words: int = BLOCK_WORDS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Learns from the documents outside fold ``hold`` and scores all: a row per input row.

    ``id, held_out, n_tokens, n_known, train_tokens, base_score, score``; scores are
    log10 probabilities of the whole text with its end token, ``base_score`` with
    counts plus one.  A null or empty text is the end token alone; a null id counts
    as empty text for the fold; repeated rows count as often as they are there.
    Without any training document every token has probability 1.  An empty table
    gives no rows; other columns are ignored.  ``order`` is the longest run of words
    that's counted, 2 or more; ``split``, ``block_words`` and ``chunk_bytes`` only
    bound what one task holds.
    """
    if order < 2:
        raise ValueError("order must be 2 or more")
    held = fold(F.col(id_col), folds) == hold
    keyed = docs.select(F.struct(F.col(id_col).alias("id"), held.alias("held")).alias("k"), text_or_empty(text_col).cast("binary").alias("text"))
    chunks = write_chunks(keyed, words_of, True, chunk_bytes)
    tokens, train_docs = chunks.agg(F.sum("n_tokens"), F.sum(F.size(F.filter("ks", lambda k: ~k["held"])))).first()
    blocks = block_count(tokens or 0, block_words)

    def train_counts(row: dict, kinds: int) -> np.ndarray:
        train = np.repeat([not k["held"] for k in row["ks"]], unpack(row["lengths"], np.int64))
        return np.bincount(unpack(row["tokens"], np.uint32)[train], minlength=kinds)

    word_table = stored(summed_words(word_blocks(chunks, blocks, train_counts), blocks), "words")
    words = Words.of(*_count_of_counts(word_table))
    joined = answered(chunks.select("chunk", "ks", "lengths", "tokens"), word_table.where("chunk is not null"), ["keys", "counts"], "words")
    model = Model(train_docs or 0, blocks, split, words, {})
    for k in range(2, order + 1):
        table = stored(_sum(_send(joined, model, k), model, k, k < order), f"order{k}")
        of_split = stored(_split_contexts(table), f"split{k}")
        few = of_split.count() <= FEW
        found = _asked_contexts(joined, model, k).join(F.broadcast(of_split) if few else of_split, "context")
        joined = answered(joined, table.where("chunk >= 0"), ["contexts", "counts", "lows", "masses", "numbers"], f"order{k}").join(
            found.groupBy("chunk").agg(F.collect_list(F.struct("context", "lows", "mass")).alias(f"split{k}")), "chunk", "left")
        model = replace(model, discount={**model.discount, k: discounts(_count_of_counts(table)[0])})
        if k < order:
            joined = stored(joined, f"known{k}")
    return _evaluate(joined, model, order).withColumnRenamed("id", id_col)
