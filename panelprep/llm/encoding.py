"""Whole texts to token ids, as the tokenizers library gives them, at a fraction of its time."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np

from panelprep.llm.common import kept

SLICE_BYTES = 1 << 20  # of text that is gone through at a time
# Characters that compose with none before them, so that each normalizes by itself: Latin, Cyrillic, punctuation, currencies.
FAST_CHARS = [*range(1, 0x250), *range(0x400, 0x460), *range(0x2010, 0x2028), *range(0x20A0, 0x20C0)]

_PLAIN = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))  # A-Z lowered, white space as spaces
_SPACE = re.compile(rb"[ \t\n\r\x0b\x0c]")
_ODD = "\x01"  # stands for a piece that the tokenizer itself has to encode

# The normalizer, the pre-tokenizer and the settings of a model whose texts may be cut into pieces.
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": _CONTRACTIONS + "|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "byte_fallback": False}


def byte_alphabet() -> dict[int, str]:
    """The printable stand-ins of byte-level pre-tokenizers: printable Latin-1 bytes stand for themselves, the rest follow from U+0100."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


def byte_ranks(model: dict, added: set[str]) -> dict[bytes, int] | None:
    """Tokens as bytes, with a space for the end of a word, if the ids are the order of the merges; else None.

    With ids in that order, merging the pair with the smallest id of the joined
    token gives the same tokens as the list of merges.
    """
    if any(model.get(k) != v for k, v in _MODEL.items()) or model.get("ignore_merges"):
        return None
    vocab, first = model["vocab"], 512
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    if any(vocab.get(a + b) != first + i for i, (a, b) in enumerate(pairs)) or len(vocab.keys() - added) != first + len(pairs):
        return None
    byte = {c: b for b, c in byte_alphabet().items()}
    ranks = {}
    for token, i in vocab.items():
        if token not in added:
            word = token.removesuffix("</w>")
            ranks[bytes(byte[c] for c in word) + b" " * (word != token)] = i
    return ranks


class Encoder:
    """Encodes whole texts exactly as the tokenizer does.

    If the file's normalizer, pre-tokenizer and model have the expected shape, a
    slice of text is lowered, spaces are put round its words by two regular
    expressions, made from what the tokenizer itself says of each usual character,
    and all words are merged in one call, with the space as the end of a word.
    Pieces with other characters, texts in which a special token could be meant,
    and all texts of a tokenizer of another shape go through the tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.bits = max(1, (self.tokenizer.get_vocab_size() - 1).bit_length())
        with open(path, encoding="utf-8") as file:
            shape = json.load(file)
        self.added = {t["content"] for t in shape["added_tokens"]}
        ranks = byte_ranks(shape["model"], self.added) if shape["normalizer"] == _NORMALIZER and shape["pre_tokenizer"] == _PRE_TOKENIZER else None
        self.fast = ranks is not None and all(t["special"] and t["content"].startswith("<|") for t in shape["added_tokens"])
        if self.fast:
            import tiktoken

            self.merger = tiktoken.Encoding("words", pat_str=r"[^ \n]+ |\n", mergeable_ranks=ranks, special_tokens={})
            self.break_id, self.odd_id = ranks[b"\n"], ranks[_ODD.encode() + b" "]
            self._characters()

    def _characters(self) -> None:
        """What the tokenizer does with each usual character: its lower case, and the kind of it."""
        kinds: dict[str, list[str]] = {"letter": [], "number": [], "space": [" "], "other": []}
        self.lower, usual = {}, ["\n"]
        words = self.tokenizer.pre_tokenizer.pre_tokenize_str
        for c in map(chr, FAST_CHARS):
            low = self.tokenizer.normalizer.normalize_str(c)
            if len(low) == 1 and ord(low) in FAST_CHARS and c not in (_ODD, "\n"):
                usual.append(c)
                if low != c:
                    self.lower[ord(c)] = low
                kind = "space" if not words(low) else "letter" if len(words("a" + low)) == 1 else "other" if len(words("!" + low)) == 1 else "number"
                kinds[kind].append(low)
        a_set = lambda chars: re.escape("".join(sorted(set(chars))))
        rest = f"[^\\n{_ODD}{a_set(kinds['space'] + kinds['letter'] + kinds['number'])}]"
        endings = "|".join(c[1:] for c in _CONTRACTIONS.split("|"))
        self.marks = re.compile(f"{rest}(?:(?<=')(?:{endings})|{rest}*)")
        self.numbers = re.compile(f"[{a_set(kinds['number'])}]")
        self.changed = re.compile(f"[{a_set(chr(c) for c in self.lower if c > 127)}]")
        self.odd = re.compile(f"[^{a_set(usual)}]")
        self.odd_piece = re.compile(f"[^ \\n]*[^{a_set(usual)}][^ \\n]*")

    def _ids(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _whole(self, text: str) -> bytes:
        return self._ids(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _parts(self, parts: list[bytes]) -> list[bytes]:
        """Ids of lowered texts; they don't matter to each other."""
        text = b" \n".join([*parts, b""]).decode("utf-8")
        odd: list[str] = []
        if not text.isascii() or _ODD in text:
            if self.odd.search(text):
                text = self.odd_piece.sub(lambda piece: odd.append(piece[0]) or _ODD, text)
            if self.changed.search(text):
                text = self.changed.sub(lambda c: self.lower[ord(c[0])], text)
        text = self.marks.sub(r" \g<0> ", self.numbers.sub(r" \g<0> ", text))
        ids = self.merger.encode_to_numpy(text)
        ends = np.flatnonzero(ids == self.break_id)
        data, size = ids.astype(self.dtype).tobytes(), self.dtype().itemsize
        begins = np.append(0, ends[:-1] + 1) if len(ends) else ends
        if not odd:
            return [data[a * size : z * size] for a, z in zip(begins.tolist(), ends.tolist())]
        places = np.flatnonzero(ids == self.odd_id)
        known = {piece: self._whole(piece) for piece in set(odd)}
        out = []
        for a, z, first, last in zip(begins.tolist(), ends.tolist(), np.searchsorted(places, begins).tolist(), np.searchsorted(places, ends).tolist()):
            whole = []
            for at, piece in zip(places[first:last].tolist(), odd[first:last]):
                whole += [data[a * size : at * size], known[piece]]
                a = at + 1
            out.append(b"".join([*whole, data[a * size : z * size]]))
        return out

    def _slices(self, text: bytes) -> Iterator[bytes]:
        at = 0
        while len(text) - at > SLICE_BYTES and (space := _SPACE.search(text, at + SLICE_BYTES)):
            yield text[at : space.end()]
            at = space.end()
        yield text[at:] if at else text

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, as an array's bytes."""
        if not self.fast:
            return [self._whole(t.decode("utf-8")) for t in texts]
        out: list[list[bytes]] = []
        held, of, size = [], [], 0

        def flush() -> None:
            for k, ids in zip(of, self._parts(held)):
                out[k].append(ids)
            held.clear()
            of.clear()

        for k, text in enumerate(texts):
            if b"<|" in text:
                out.append([self._whole(text.decode("utf-8"))])
                continue
            out.append([])
            for part in self._slices(text):
                held.append(part.translate(_PLAIN))
                of.append(k)
                size += len(part)
                if size >= SLICE_BYTES:
                    flush()
                    size = 0
        flush()
        return [o[0] if len(o) == 1 else b"".join(o) for o in out]


_ENCODERS: dict[str, Encoder] = kept({})


def encoder(path: str) -> Encoder:
    """One for each worker process and tokenizer."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
