"""Sharing of common term sets among queries.

Each query is a set of terms whose weights are to be summed. ``QueryDag`` mines the sets that several
queries share and lays all sums out as a graph of two-argument additions in which each shared set
occurs once:

1. terms that occur in exactly the same queries form one set, summed once;
2. each query becomes the sequence of its sets, those of most queries first, so that sets which occur
   together stand together; in rounds, all pairs of neighbours that at least two queries have become new
   shared sets, the most frequent pairs first, until no pair is shared;
3. what is left of a query is summed in a balanced tree; equal sums are one node.

Nodes are numbered by level, terms first, so that a level is evaluated with one array operation.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Sequence

import numpy as np


class QueryDag:
    """Sum graph of ``queries`` (sets of term numbers below ``n_terms``). ``roots[q]`` is the node of query q (-1: no term)."""

    def __init__(self, queries: Sequence[Sequence[int]], n_terms: int):
        self.n_terms, self.queries = n_terms, len(queries)
        self._made: dict[tuple[int, int], int] = {}
        self._pairs: list[tuple[int, int]] = []
        sequences = self._shared_terms(queries)
        while (found := self._merge_neighbours(sequences)) is not None:
            sequences = found
        roots = [self._sum(s) if s else -1 for s in sequences]
        self._lay_out(roots)

    def _node(self, a: int, b: int) -> int:
        key = (a, b) if a < b else (b, a)
        if key not in self._made:
            self._made[key] = self.n_terms + len(self._pairs)
            self._pairs.append(key)
        return self._made[key]

    def _sum(self, nodes: Sequence[int]) -> int:
        nodes = list(nodes)
        while len(nodes) > 1:
            nodes = [self._node(nodes[i], nodes[i + 1]) if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)]
        return nodes[0]

    def _shared_terms(self, queries: Sequence[Sequence[int]]) -> list[list[int]]:
        """Each query as its sets of terms with the same queries, those of most queries first."""
        homes: dict[int, list[int]] = defaultdict(list)
        for q, terms in enumerate(queries):
            for t in sorted(set(terms)):
                homes[t].append(q)
        classes: dict[tuple[int, ...], list[int]] = defaultdict(list)
        for t in sorted(homes):
            classes[tuple(homes[t])].append(t)
        out: list[list[int]] = [[] for _ in queries]
        for home, terms in sorted(classes.items(), key=lambda kv: (-len(kv[0]), kv[1][0])):
            node = self._sum(terms)
            for q in home:
                out[q].append(node)
        return out

    def _merge_neighbours(self, sequences: list[list[int]]) -> list[list[int]] | None:
        """Sequences with neighbours that several queries share made one node; None if there are none."""
        counts = Counter(pair for s in sequences for pair in set(zip(s, s[1:])))
        shared = {pair: (-n, pair) for pair, n in counts.items() if n > 1}
        if not shared:
            return None
        out = []
        for s in sequences:
            # the most frequent pairs of a query first; a node goes into one pair a round
            heads: set[int] = set()
            for _, i in sorted((shared[pair], i) for i, pair in enumerate(zip(s, s[1:])) if pair in shared):
                if not heads & {i - 1, i, i + 1}:
                    heads.add(i)
            merged, i = [], 0
            while i < len(s):
                merged.append(self._node(s[i], s[i + 1]) if i in heads else s[i])
                i += 2 if i in heads else 1
            out.append(merged)
        return out

    def _lay_out(self, roots: list[int]) -> None:
        level = np.zeros(self.n_terms + len(self._pairs), dtype=np.int64)
        for k, (a, b) in enumerate(self._pairs):
            level[self.n_terms + k] = 1 + max(level[a], level[b])
        order = np.argsort(level, kind="stable")  # terms have level 0 and keep their numbers
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        pairs = np.array(self._pairs, dtype=np.int64).reshape(-1, 2)
        for depth in range(1, int(level.max(initial=0)) + 1):
            nodes = order[level[order] == depth]
            own = pairs[nodes - self.n_terms]
            self.levels.append((int(place[nodes[0]]), place[own[:, 0]], place[own[:, 1]]))
        self.n_nodes = len(order)
        self.roots = np.array([place[r] if r >= 0 else -1 for r in roots], dtype=np.int64)

    @property
    def additions(self) -> int:
        """Sums made for a document, shared ones once."""
        return self.n_nodes - self.n_terms

    def evaluate(self, values: np.ndarray) -> None:
        """Fill rows n_terms.. of ``values`` (n_nodes x documents) from its first n_terms rows, in place."""
        for start, left, right in self.levels:
            np.add(values[left], values[right], out=values[start:start + len(left)])
