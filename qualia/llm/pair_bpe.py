"""Byte-level BPE encoding and decoding with a pair occurrence index.

A partition's new pre-tokens are laid end to end. The index maps each adjacent pair that has a merge
rank to all its positions in all of them; the active ranks are applied in ascending order, each at
all its positions at once, and the lists of the pairs that a merge creates are updated. A merge only
creates pairs of later ranks, so one ascending sweep gives each pre-token the ids that merging it
alone, lowest rank first, would give.

A single space between two characters that are not white space always starts a pre-token, so texts
are handled in space-separated chunks and the ids of chunks a worker has met are kept (bounded).
Texts with other white space beside a space, or with special tokens, are cut into pre-tokens whole.

Defined results: null text is the empty text, with no ids; the strings of special tokens in a text
become their ids; repeated rows give equal results; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualia.llm.batches import slices

# Unicode white space, and the pre-token pattern of this vocabulary.
WS = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
PRE_TOKEN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WS}\p{{L}}\p{{N}}]+|[{WS}]+(?![^{WS}])|[{WS}]+")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary: printable Latin-1 as it is, the rest from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or (b >= 0xA1 and b != 0xAD)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PairBpe:
    """Encoder and decoder for one tokenizers file."""

    _loaded: dict[str, PairBpe] = {}

    @classmethod
    def of(cls, path: str) -> PairBpe:
        """One codec per file and Python worker."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def __init__(self, path: str, max_chunks: int = 400_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        back = {c: b for b, c in letters.items()}
        self.byte_id = np.array([vocab[letters[b]] for b in range(256)], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        keys = self.left << 32 | self.right
        self.rank_of_key = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_of_key]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token_bytes = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.max_chunks = max_chunks
        self.plain: dict[str, bytes] = {}  # pre-token -> ids
        self.spaced: dict[str, bytes] = {}  # chunk that follows a single space -> ids

    def ranks(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, -1 for none."""
        if not len(self.keys):
            return np.full(len(first), -1)
        key = first << 32 | second
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (second >= 0) & (first >= 0), self.rank_of_key[at], -1)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each (non-empty) pre-token, as little-endian unsigned 32-bit integers."""
        if not words:
            return []
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        ends = np.cumsum(sizes)
        n = int(ends[-1])
        ids = np.concatenate([self.byte_id[np.frombuffer(b"".join(words), dtype=np.uint8)], [-1]])
        after = np.arange(1, n + 2)
        before = np.arange(-1, n)
        after[ends - 1] = n
        before[ends - sizes] = n
        after[n] = before[n] = n
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def note(at: np.ndarray) -> None:
            rank = self.ranks(ids[at], ids[after[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            bounds = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]])) if len(rank) else []
            for i, j in zip(bounds, [*bounds[1:], len(rank)]):
                r = int(rank[i])
                if r not in index:
                    index[r] = []
                    heapq.heappush(heap, r)
                index[r].append(at[i:j])

        note(np.arange(n))
        while heap:
            r = heapq.heappop(heap)
            at = np.sort(np.concatenate(index.pop(r)))
            at = at[np.concatenate([[True], at[1:] != at[:-1]])]
            a, b = self.left[r], self.right[r]
            follow = after[at]
            live = (ids[at] == a) & (ids[follow] == b)
            at, follow = at[live], follow[live]
            if a == b and len(at) > 1:  # in a run of one symbol every second position is free
                i = np.arange(len(at))
                run = np.maximum.accumulate(np.where(np.concatenate([[True], at[1:] != follow[:-1]]), i, 0))
                at, follow = at[(i - run) % 2 == 0], follow[(i - run) % 2 == 0]
            if not len(at):
                continue
            ids[at], ids[follow] = self.merged[r], -2
            beyond = after[follow]
            after[at] = beyond
            before[beyond] = at
            prior = before[at]
            note(np.concatenate([prior[prior != n], at[beyond != n]]))
        live = ids[:n] >= 0
        raw = ids[:n][live].astype("<u4").tobytes()
        upto = np.concatenate([[0], np.cumsum(live)])[ends] * 4
        cuts = [0, *upto.tolist()]
        return [raw[i:j] for i, j in zip(cuts[:-1], cuts[1:])]

    def _learn_words(self, words: set[str]) -> None:
        new = list(words.difference(self.plain))
        self.plain.update(zip(new, self.merge([w.encode() for w in new])))

    def _learn_chunks(self, chunks: set[str]) -> None:
        """Ids of chunks that follow a single space; none for those that are empty or have white
        space at an end, as their pre-tokens depend on what stands beside them."""
        parts = {}
        for c in chunks:
            if c.isalpha():
                parts[c] = [" " + c]
            elif c and c[0] not in WS and c[-1] not in WS:
                parts[c] = [" " + c[:-1], c[-1]] if c[-1] in ".,;:!?" and c[:-1].isalpha() else PRE_TOKEN.findall(" " + c)
        self._learn_words({w for own in parts.values() for w in own})
        plain = self.plain
        self.spaced.update((c, plain[own[0]] if len(own) == 1 else b"".join([plain[w] for w in own])) for c, own in parts.items())

    def _by_words(self, text: str) -> bytes:
        """Ids of a text that is not made of known chunks: special tokens apart, then pre-tokens."""
        parts = self.cut.split(text) if self.cut is not None else [text]
        out = []
        for part in parts:
            if part in self.special:
                out.append(np.asarray([self.special[part]], dtype="<u4").tobytes())
            else:
                words = PRE_TOKEN.findall(part)
                self._learn_words(set(words))
                out.extend(map(self.plain.__getitem__, words))
        return b"".join(out)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each whole text as little-endian unsigned 32-bit integers."""
        if len(self.spaced) + len(self.plain) > self.max_chunks:
            self.spaced, self.plain = {}, {}
        split, first = [], set()
        for text in texts:
            text = text or ""
            special = self.cut is not None and any(t in text for t in self.special)
            chunks = [] if special else text.split(" ")
            if chunks and chunks[0]:
                if chunks[0][-1] in WS and len(chunks) > 1:
                    chunks = []
                else:
                    first.update(PRE_TOKEN.findall(chunks[0]))
            split.append(chunks)
        self._learn_chunks({c for chunks in split for c in chunks[1:]}.difference(self.spaced))
        self._learn_words(first)
        out = []
        for text, chunks in zip(texts, split):
            try:
                if not chunks:
                    raise KeyError
                head = map(self.plain.__getitem__, PRE_TOKEN.findall(chunks[0])) if chunks[0] else ()
                out.append(b"".join([*head, *map(self.spaced.__getitem__, chunks[1:])]))
            except KeyError:
                out.append(self._by_words(text or ""))
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids; special ids give their strings, bytes that are not UTF-8 give U+FFFD."""
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                  full: bool = True) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256 (and, if ``full``, ids and decoded)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PairBpe.of(tokenizer)
        for batch in slices(batches, max_bytes=8 << 20):
            encoded = codec.encode(batch.column("text").to_pylist())
            ids = [np.frombuffer(raw, dtype="<u4").tolist() for raw in encoded]
            texts = [codec.decode(i) for i in ids]
            arrays = [
                batch.column("doc_id"),
                pa.array([len(i) for i in ids], pa.int64()),
                pa.array([hashlib.sha256(raw).hexdigest() for raw in encoded], pa.string()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if full:
                arrays += [pa.array(ids, pa.list_(pa.int32())), pa.array(texts, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, schema + (", ids array<int>, decoded string" if full else ""))
