"""Helpers for operators that run inside Arrow batches: text slices of bounded size and word hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# The ASCII white space that separates words, and A-Z lower-cased.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_LONG_WORD = 128
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``max_bytes`` of text (one row at least), so that working
    memory follows ``max_bytes`` and the longest single text, not the Arrow batch."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def free_name(columns: list[str], name: str) -> str:
    """``name``, made longer until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column (null: empty) and its offsets (rows + 1) into them."""
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finalizer (public murmur constants), in place on a fresh array."""
    h = h ^ (h >> np.uint64(33))
    h *= _M1
    h ^= h >> np.uint64(33)
    h *= _M2
    h ^= h >> np.uint64(33)
    return h


def word_spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows, and the words' bounds per row (rows + 1); ``between`` flags the
    bytes that separate words."""
    solid = ~between[data]
    before = np.empty_like(solid)
    before[:1] = False
    before[1:] = solid[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.empty_like(solid)
    after[-1:] = False
    after[:-1] = solid[1:]
    after[inner - 1] = False
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, eight bytes at a time."""
    sizes = ends - starts
    out = mix(sizes.astype(np.uint64) * _STEP + _STEP)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, 8)
    rows = np.flatnonzero(sizes <= _LONG_WORD)
    k = 0
    while len(rows):
        part = np.ascontiguousarray(windows[starts[rows] + k]).view("<u8").reshape(-1)
        part = part & _MASKS[np.minimum(sizes[rows] - k, 8)]
        out[rows] = mix(out[rows] * _STEP + part)
        k += 8
        rows = rows[sizes[rows] > k]
    for i in np.flatnonzero(sizes > _LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i]:ends[i]].tobytes())
    return out


def combine(parts: Iterable[np.ndarray]) -> np.ndarray:
    """Order-dependent hash of equally long columns of hashes."""
    out = None
    for part in parts:
        out = mix(part.copy()) if out is None else mix(out * _STEP + part)
    return out


def hashed_words(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all rows in order, and their bounds per row (rows + 1)."""
    data, offsets = text_bytes(column)
    if lower:
        data = LOWER[data]
    starts, ends, bounds = word_spans(data, offsets)
    return hash_words(data, starts, ends), bounds
