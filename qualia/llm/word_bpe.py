"""Whole-text encoding with a word-level BPE file of the tokenizers library, each distinct word once.

White space never reaches the model of such a file and no pre-token spans it, so a text's ids are
the ids of its space-separated chunks in order. A plain chunk, of Latin-1 letters and ASCII punctuation, is cut
further where the two meet, as the pre-tokenizer does, and lower-cased. The pieces of a slice of texts are grouped by
their bytes in array operations; a worker keeps the ids of pieces it has met in arrays, and new pieces are
encoded together. Hashes only find a piece: its bytes are compared too. The ids are those of encoding the
whole text (tests/llm/test_encoders.py).
"""

from __future__ import annotations

import os
import struct
import unicodedata

import numpy as np
import pyarrow as pa

from qualia.llm.batches import LOWER, hash_words, text_bytes, word_spans
from qualia.llm.pair_bpe import byte_letters

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
from tokenizers import Tokenizer  # noqa: E402

# Punctuation that always is a pre-token apart from the letters before it (no apostrophe: 's; no <|>: special tokens).
_TAIL = ".,;:!?#*$%&-"
_JOINED = 400
SLICE = 2 << 20  # bytes of text to encode at once: working memory is about 30 times that

_BETWEEN = np.zeros(256, dtype=bool)
_BETWEEN[[ord(" "), ord("\n")]] = True
# Kinds of bytes: 0 between chunks, 1 Latin-1 letters in UTF-8, 2 punctuation of _TAIL, 3 others. Letters beyond ASCII
# are 0xC3 and one byte more (not 0x97 and 0xB7, signs); any other character's first byte is of kind 3.
_KIND = np.full(256, 3, dtype=np.uint8)
_KIND[_BETWEEN] = 0
_KIND[[c for c in range(128) if chr(c).isalpha()]] = 1
_KIND[[0xC3, *(c for c in range(0x80, 0xC0) if c not in (0x97, 0xB7))]] = 1
_KIND[[ord(c) for c in _TAIL]] = 2
_PLAIN_LOWER = LOWER.copy()
_PLAIN_LOWER[[c for c in range(0x80, 0x9F) if c != 0x97]] += 32
_LONG = 200


def _one_word(stem: str) -> bool:
    """Whether a chunk is all letters, also after the tokenizer's normalization: one pre-token."""
    return stem.isalpha() and (stem.isascii() or unicodedata.normalize("NFC", stem).lower().isalpha())


def _latin(word: str) -> bool:
    """Whether all characters are in Latin-1: they are composed, and each has one lower-case letter there."""
    try:
        word.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes with the plain chunks lower-cased, starts and ends of all pieces in order, whether they are of a plain
    chunk, and their bounds per row (rows + 1)."""
    starts, ends, _ = word_spans(data, offsets, _BETWEEN)
    kind = _KIND[data]
    plain = np.ones(len(starts), dtype=bool)
    plain[np.searchsorted(starts, np.flatnonzero(kind == 3), side="right") - 1] = False
    cuts = np.flatnonzero((kind[1:] != kind[:-1]) & (kind[1:] * kind[:-1] == 2)) + 1
    at = np.searchsorted(starts, cuts, side="right") - 1
    cuts = cuts[plain[at] & (cuts > starts[at])]
    other = np.zeros(len(data) + 1, dtype=np.int8)
    other[starts[~plain]] = 1
    other[ends[~plain]] -= 1
    data = np.where(np.cumsum(other[:-1], dtype=np.int8).view(bool), data, _PLAIN_LOWER[data])
    chunks, starts, ends = starts, np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    plain = plain[np.searchsorted(chunks, starts, side="right") - 1]
    return data, starts, ends, plain, np.searchsorted(starts, offsets)


def _same(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether spans of ``sizes`` bytes are equal."""
    a, b = (np.lib.stride_tricks.sliding_window_view(np.concatenate([x, np.zeros(8, np.uint8)]), 8) for x in (a, b))
    out, rows, k = np.ones(len(sizes), dtype=bool), np.arange(len(sizes)), 0
    while len(rows):
        differ = np.ascontiguousarray(a[a_at[rows] + k]).view("<u8").reshape(-1) ^ np.ascontiguousarray(b[b_at[rows] + k]).view("<u8").reshape(-1)
        equal = differ << (np.uint64(8) * (8 - np.minimum(sizes[rows] - k, 8)).astype(np.uint64)) == 0
        out[rows[~equal]] = False
        k += 8
        rows = rows[equal & (sizes[rows] > k)]
    return out


class PieceTable:
    """Ids by piece, in arrays: the pieces' bytes and ids one after the other, found by sorted hashes."""

    def __init__(self):
        self.text, self.text_at = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.ids, self.ids_at = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.hashes, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def __len__(self) -> int:
        return len(self.ids_at) - 1

    def find(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The slot of each piece, -1 if it is not here."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            slots = self.slots[at]
            rows = np.flatnonzero((self.hashes[at] == hashes) & (self.text_at[slots + 1] - self.text_at[slots] == sizes))
            slots = slots[rows]
            equal = _same(data, starts[rows], self.text, self.text_at[slots], sizes[rows])
            out[rows[equal]] = slots[equal]
        return out

    def add(self, pieces: list[bytes], ids: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """Append pieces; of equal hashes the first one met is found again. Returns their slots."""
        slots = np.arange(len(self), len(self) + len(pieces))
        self.text = np.concatenate([self.text, np.frombuffer(b"".join(pieces), np.uint8)])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), "<u4")])
        self.text_at = np.concatenate([self.text_at, self.text_at[-1] + np.cumsum([len(p) for p in pieces], dtype=np.int64)])
        self.ids_at = np.concatenate([self.ids_at, self.ids_at[-1] + np.cumsum([len(i) // 4 for i in ids], dtype=np.int64)])
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        at = np.searchsorted(self.hashes, hashes)
        fresh = np.concatenate([[True], hashes[1:] != hashes[:-1]]) & (np.searchsorted(self.hashes, hashes, side="right") == at)
        self.hashes = np.insert(self.hashes, at[fresh], hashes[fresh])
        self.slots = np.insert(self.slots, at[fresh], slots[order][fresh].astype(np.int32))
        return slots

    def keep(self, n: int) -> None:
        """Drop all but the first ``n`` pieces."""
        here = self.slots < n
        self.hashes, self.slots = self.hashes[here], self.slots[here]
        self.text_at, self.ids_at = self.text_at[:n + 1].copy(), self.ids_at[:n + 1].copy()
        self.text, self.ids = self.text[:self.text_at[-1]].copy(), self.ids[:self.ids_at[-1]].copy()


class WordBpe:
    """Encoder with a bounded table of pieces -> ids."""

    _loaded: dict[str, WordBpe] = {}

    @classmethod
    def of(cls, path: str) -> WordBpe:
        """One encoder per file and Python worker."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def __init__(self, path: str, max_chunks: int = 600_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocab = self.tokenizer.get_vocab()
        self.word_end = np.zeros(max(vocab.values()) + 1, dtype=bool)
        for token, i in vocab.items():
            self.word_end[i] = token.endswith("</w>")
        self.letters = {b: c for b, c in byte_letters().items() if chr(b) != c}
        self.packers = [struct.Struct(f"<{n}I").pack for n in range(64)]
        self.max_chunks = max_chunks
        self.table = PieceTable()

    def pack(self, ids: list[int]) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self.packers[len(ids)](*ids) if len(ids) < 64 else np.asarray(ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Ids of each whole text (null: empty) as little-endian unsigned 32-bit integers."""
        ids, bounds = self.encode_column(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()))
        raw, bounds = ids.astype("<u4").tobytes(), (4 * bounds).tolist()
        return [raw[a:b] for a, b in zip(bounds[:-1], bounds[1:])]

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all whole texts (null: empty) one after the other, and their bounds per text (texts + 1)."""
        if len(self.table) > self.max_chunks:
            # the pieces met first are the most frequent ones, by and large
            self.table.keep(self.max_chunks // 3)
        data, starts, ends, plain, bounds = _pieces(*text_bytes(column))
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(column) + 1, np.int64)
        hashes, sizes = hash_words(data, starts, ends), ends - starts
        order = np.argsort(hashes)
        ordered = hashes[order]
        fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        group = np.empty(len(order), dtype=np.int64)
        group[order] = np.cumsum(fresh) - 1
        first = order[fresh]
        # a piece with the hash but not the bytes of its group's first one is a group of its own
        like = first[group]
        apart = np.flatnonzero((sizes != sizes[like]) | ~_same(data, starts, data, starts[like], np.minimum(sizes, sizes[like])))
        group[apart] = len(first) + np.arange(len(apart))
        first = np.concatenate([first, apart])
        slots = self.table.find(hashes[first], data, starts[first], sizes[first])
        new = np.flatnonzero(slots < 0)
        if len(new):
            raw = data.tobytes()
            pieces = [raw[a:b] for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())]
            short = plain[first[new]] & (sizes[first[new]] < _LONG)
            others = iter(self._learn([p.decode() for p, own in zip(pieces, short.tolist()) if not own]))
            ids = [self._plain(p) if own else next(others) for p, own in zip(pieces, short.tolist())]
            slots[new] = self.table.add(pieces, ids, hashes[first[new]])
        slots = slots[group]
        begin = self.table.ids_at[slots]
        ends = np.cumsum(self.table.ids_at[slots + 1] - begin)
        counts = np.diff(ends, prepend=0)
        ids = self.table.ids[np.arange(ends[-1]) + np.repeat(begin - ends + counts, counts)]
        return ids, np.concatenate([[0], ends])[bounds]

    def _plain(self, piece: bytes) -> bytes:
        """Ids of a piece of a plain chunk: one pre-token that goes to the model as it is, each byte as its letter of
        the vocabulary."""
        word = piece.decode("latin-1")
        return self.pack([t.id for t in self.tokenizer.model.tokenize(word if piece.isascii() else word.translate(self.letters))])

    def _learn(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk."""
        cut: list[tuple[str, str]] = []
        words, others = set(), set()
        for chunk in chunks:
            stem = chunk.rstrip(_TAIL)
            if len(stem) < _LONG and _one_word(stem):
                low = stem.lower() if stem.isascii() or _latin(stem) else stem
                cut.append((low, chunk[len(stem):]))
                words.update(cut[-1])
            elif not stem:
                cut.append((stem, chunk))
                words.update(cut[-1])
            else:
                cut.append((chunk, ""))
                others.add(chunk)
        ids = self._words([w for w in words if w]) | self._each(list(others))
        ids[""] = b""
        return [ids[low] + ids[tail] if tail else ids[low] for low, tail in cut]

    def _each(self, chunks: list[str]) -> dict[str, bytes]:
        found = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False) if chunks else []
        return {c: np.asarray(e.ids, dtype="<u4").tobytes() for c, e in zip(chunks, found)}

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Words of one pre-token each. Words of Latin-1 letters, already lower-cased, go to the model
        as they are (each byte as its letter of the vocabulary); of the others many are joined in
        one call and cut after each word-end token."""
        out: dict[str, bytes] = {}
        tokenize, pack, rest = self.tokenizer.model.tokenize, self.pack, []
        for w in words:
            if w.isascii():
                out[w] = pack([t.id for t in tokenize(w)])
            elif _latin(w):
                out[w] = pack([t.id for t in tokenize(w.encode().decode("latin-1").translate(self.letters))])
            else:
                rest.append(w)
        words = rest
        groups = [words[i:i + _JOINED] for i in range(0, len(words), _JOINED)]
        found = self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False) if groups else []
        for group, e in zip(groups, found):
            ids = np.asarray(e.ids, dtype="<u4")
            cuts = np.flatnonzero(self.word_end[ids]) + 1
            if len(cuts) != len(group) or cuts[-1] != len(ids):
                out.update(self._each(group))
                continue
            raw, at = ids.tobytes(), [0, *(4 * cuts).tolist()]
            out.update((w, raw[at[i]:at[i + 1]]) for i, w in enumerate(group))
        return out
