"""Packing token ids into fixed windows with the sum-of-squares online rule.

Each partition is packed on its own, in one pass and without a shuffle. A document's ids (with the
end id) are cut into full windows; the rest is placed online: of all fill levels it fits on, the one
after which the sum of squared counts of partially filled windows is least (ties: the fullest), where
``counts[level]`` is the tracked level array and level 0 means a new window. At the end of the
partition (or when ``max_open`` windows are open) the open windows are poured into full ones by
cutting pieces, so what is left is less than one window; at the end it becomes sequences whose
lengths are powers of two, which need no padding.

Working memory: ``max_open`` windows of ids plus one slice of texts.

Defined results: null or empty text is the end id alone; repeated rows are packed each on their
own; null doc_ids are kept; an empty table gives no pieces; other columns are not read. Sequence
ids are unique over the table (partition number in the upper bits); offsets in a sequence are gapless.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualia.llm.batches import slices
from qualia.llm.word_bpe import SLICE, WordBpe

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class LevelPacker:
    """Sum-of-squares placement of pieces into windows of ``size`` ids. ``closed`` gets full windows."""

    def __init__(self, size: int, max_open: int, first_id: int):
        self.size, self.max_open, self.next_id = size, max_open, first_id
        self.counts = np.zeros(size + 1, dtype=np.int64)
        self.windows: dict[int, list[list]] = {}
        self.n_open = 0
        self.closed: list[tuple[int, list]] = []

    def _close(self, window: list) -> None:
        self.closed.append((self.next_id, window))
        self.next_id += 1

    def _open(self, level: int, window: list) -> None:
        self.counts[level] += 1
        self.windows.setdefault(level, []).append(window)
        self.n_open += 1

    def level_for(self, n: int) -> int:
        """The fill level to place ``n`` ids on: least growth of the sum of squared counts."""
        counts, size = self.counts, self.size
        levels = np.flatnonzero(counts[1:size - n + 1]) + 1
        best, cost = 0, 2 * counts[n] + 1
        if len(levels):
            grown = 2 * (counts[levels + n] - counts[levels]) + 2
            if levels[-1] + n == size:
                grown[-1] = 1 - 2 * counts[levels[-1]]
            least = grown.min()
            if least <= cost:
                best = int(levels[np.flatnonzero(grown == least)[-1]])
        return best

    def add(self, piece: tuple, n: int) -> None:
        """Place a piece of ``n`` ids, 0 < n <= size."""
        if n == self.size:
            self._close([(piece, n)])
            return
        level = self.level_for(n)
        window = []
        if level:
            self.counts[level] -= 1
            window = self.windows[level].pop()
            self.n_open -= 1
        window.append((piece, n))
        if level + n == self.size:
            self._close(window)
        else:
            self._open(level + n, window)
            if self.n_open > self.max_open:
                self.pour()

    def pour(self, last: bool = False) -> None:
        """Cut the open windows' pieces into full windows; the rest stays open, or if ``last`` leaves
        as sequences of power-of-two lengths."""
        pieces = [p for level in sorted(self.windows, reverse=True) for w in self.windows[level] for p in w]
        self.windows, self.n_open = {}, 0
        self.counts[:] = 0
        total = sum(n for _, n in pieces)
        targets = [self.size] * (total // self.size)
        rest = total % self.size
        if last:
            targets += [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
        elif rest:
            targets.append(rest)
        at = iter(pieces)
        (piece, n), used = next(at, (None, 0)), 0
        for target in targets:
            window, fill = [], 0
            while fill < target:
                if used == n:
                    (piece, n), used = next(at), 0
                take = min(n - used, target - fill)
                row, start, *more = piece
                window.append(((row, start + used, *more), take))
                used += take
                fill += take
            if target == self.size or last:
                self._close(window)
            else:
                self._open(target, window)


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 1, id_col: str = "doc_id",
         text_col: str = "text", max_open: int = 4096, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents: PIECES columns, and the piece's ``ids`` if ``with_ids``."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = WordBpe.of(tokenizer), np.asarray([end_id], dtype="<u4").tobytes()
        packer = LevelPacker(size, max_open, TaskContext.get().partitionId() << 33)

        def drained() -> Iterator[pa.RecordBatch]:
            rows = []
            for sequence, window in packer.closed:
                offset = 0
                for (row, start, ids), n in window:
                    own = ids[4 * start:4 * (start + n)]
                    rows.append((row, start, n, zlib.crc32(own), len(ids) // 4, sequence, offset, own))
                    offset += n
            packer.closed = []
            if rows:
                *columns, own = zip(*rows)
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
                arrays = [pa.array(c, pa.int64()) for c in columns]
                if with_ids:
                    at = np.concatenate([[0], np.cumsum(columns[2])]).astype(np.int32)
                    arrays.append(pa.ListArray.from_arrays(pa.array(at), pa.array(np.frombuffer(b"".join(own), dtype="<i4"))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in slices(batches, max_bytes=SLICE):
            for row, ids in zip(batch.column("doc_id").to_pylist(), bpe.encode(batch.column("text"))):
                ids += end
                n = len(ids) // 4
                for start in range(0, n, size):
                    packer.add((row, start, ids), min(size, n - start))
            yield from drained()
        packer.pour(last=True)
        yield from drained()

    return src.mapInArrow(run, PIECES + (", ids array<int>" if with_ids else ""))
