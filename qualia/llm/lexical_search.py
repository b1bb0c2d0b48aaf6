"""Ranked lexical search of many queries at once, with shared partial sums.

A term's contribution to a document's score does not depend on the query, so queries with common
terms have common partial sums. Per block of queries:

1. one pass over all documents tokenises whole texts and keeps, per document with terms, its length
   and the counts of the block's terms (written; texts are not read again);
2. corpus statistics (documents, terms, document frequencies) are aggregated from that table;
3. term sets that queries share are mined and laid out as a graph of sums (``query_dag``);
4. each task takes documents in chunks, writes the contributions of the terms they hold into an
   accumulator row per term, fills each shared set's accumulator once from its two parts, and reads
   every query's scores off its node. A task keeps the ``top`` best documents of each query;
5. the tasks' best are ranked in two steps, salted first, so no task meets all of a query's.

Queries are taken in blocks of at most ``block_items`` queries or ``block_terms`` terms (one query at
least), so broadcasts and the driver hold one block, whatever their number; each block covers all documents.

Scores: N documents with a term, L terms of all documents, n terms of a document, df documents with a
term, tf its occurrences in the document; weight w = floor(1000 ln((2N+2)/(2df+1))) in doubles,
m = 50 + (50 n N) div L; the score sums w ((1000000000 tf) div (1000 tf + 20 m)) over the query's terms,
once each, in 64-bit integers.

Defined results: null text, and text without terms, has no terms: it is not counted and not found; such
queries find nothing. Documents with a score of 0 are not returned. Equal scores rank by ascending
doc_id, null first; rows with equal doc_ids are documents of their own, in any order. Repeated queries
each have their result. Terms are told apart by 64-bit hash and length (a document's term is taken for
a query's other term with a probability of 2**-64 for each pair). An empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qualia.llm.batches import LOWER, hash_words, slices, text_bytes, word_spans
from qualia.llm.query_dag import QueryDag
from qualia.session import scratch_path

# Terms are runs of digits, letters and code points of 128 and more; only A-Z are lower-cased.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
BETWEEN = np.zeros(256, dtype=bool)
BETWEEN[:0x80] = True
BETWEEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_CHUNK_BYTES = 32 << 20
_SALTS = 16


def query_terms(text: str | None) -> list[str]:
    """Distinct terms of a query, sorted."""
    return sorted(set(TERM.findall((text or "").translate(_UPPER))))


@dataclass(frozen=True)
class Block:
    """Queries evaluated together: their ids and term numbers, and the block's terms by sorted hash."""

    ids: list
    terms: list[list[int]]
    hashes: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, queries: list[tuple[int | None, list[str]]]) -> Block:
        words = sorted({t for _, terms in queries for t in terms})
        data = [w.encode() for w in words]
        sizes = np.array([len(d) for d in data], dtype=np.int64)
        ends = np.cumsum(sizes)
        hashes = hash_words(np.frombuffer(b"".join(data), dtype=np.uint8), ends - sizes, ends)
        order = np.argsort(hashes, kind="stable")
        number = {words[w]: i for i, w in enumerate(order.tolist())}
        return cls([i for i, _ in queries], [[number[t] for t in terms] for _, terms in queries], hashes[order], sizes[order])


def blocks(items: DataFrame, id_col: str, text_col: str, block_items: int, block_terms: int) -> Iterator[Block]:
    """The queries with terms, in blocks; rows stream to the driver, which holds one block."""
    queries, size = [], 0
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).orderBy("id", F.xxhash64("text"))
    for row in rows.toLocalIterator():
        terms = query_terms(row.text)
        if not terms:
            continue
        if queries and (len(queries) == block_items or size + len(terms) > block_terms):
            yield Block.of(queries)
            queries, size = [], 0
        queries.append((row.id, terms))
        size += len(terms)
    if queries:
        yield Block.of(queries)


def term_counts(docs: DataFrame, block: Block) -> DataFrame:
    """doc_id, n (all terms of the text), terms and counts (of the block) for rows (doc_id, text) with a term."""
    hashes, lengths = block.hashes, block.lengths

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = text_bytes(batch.column("text"))
            data = LOWER[data]
            starts, ends, bounds = word_spans(data, offsets, BETWEEN)
            found = hash_words(data, starts, ends)
            at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
            hit = np.flatnonzero((hashes[at] == found) & (lengths[at] == ends - starts))
            rows = np.searchsorted(bounds, hit, side="right") - 1
            pairs, counts = np.unique(rows * len(hashes) + at[hit], return_counts=True)
            n = np.diff(bounds)
            keep = np.flatnonzero(n)
            edges = pa.array(np.searchsorted(pairs, np.arange(len(n) + 1) * len(hashes)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(edges, pa.array(v)) for v in ((pairs % len(hashes)).astype(np.int32), counts.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n.astype(np.int64)), *lists], names=["doc_id", "n", "terms", "counts"]).take(pa.array(keep))

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>")


class _Best:
    """The best documents so far of each query: score falling, then doc_id (null first)."""

    def __init__(self, queries: int, top: int):
        self.top, self.found = top, [None] * queries
        self.least = np.ones(queries, dtype=np.int64)  # a score that can still enter

    def offer(self, scores: np.ndarray, ids: np.ndarray, named: np.ndarray) -> None:
        """``scores`` is queries x documents; ``named`` tells null ids apart."""
        for q in np.flatnonzero(scores.max(axis=1, initial=0) >= self.least).tolist():
            at = np.flatnonzero(scores[q] >= self.least[q])
            own = [scores[q, at], ids[at], named[at]]
            if self.found[q] is not None:
                own = [np.concatenate([old, new]) for old, new in zip(self.found[q], own)]
            order = np.lexsort((own[1], own[2], -own[0]))[:self.top]
            self.found[q] = [column[order] for column in own]
            if len(order) == self.top:
                self.least[q] = own[0][order[-1]]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """query, doc_id, whether it is named, score."""
        some = [(q, f) for q, f in enumerate(self.found) if f is not None]
        if not some:
            return (np.zeros(0, np.int64),) * 4
        queries = np.repeat([q for q, _ in some], [len(f[0]) for _, f in some])
        return queries, *(np.concatenate([f[k] for _, f in some]) for k in (1, 2, 0))


def best_documents(counts: DataFrame, block: Block, dag: QueryDag, weights: np.ndarray, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """query (its place in the block), doc_id, score: the best documents of every task."""
    shared = counts.sparkSession.sparkContext.broadcast((dag, weights))  # bounded by the block

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dag, weights = shared.value
        best = _Best(dag.queries, top)
        chunk = max(16, min(4096, _CHUNK_BYTES // (8 * dag.n_nodes)))
        sums = np.zeros((dag.n_nodes, chunk), dtype=np.int64)
        for batch in batches:
            ids = batch.column("doc_id")
            named = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            mean = 50 + (50 * batch.column("n").to_numpy() * n_docs) // n_terms
            lists = batch.column("terms")
            edges = lists.offsets.to_numpy().astype(np.int64)
            terms, tf = lists.flatten().to_numpy(), batch.column("counts").flatten().to_numpy().astype(np.int64)
            rows = np.repeat(np.arange(batch.num_rows), np.diff(edges))
            edges = edges - edges[0]
            parts = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * mean[rows]))
            for at in range(0, batch.num_rows, chunk):
                stop = min(batch.num_rows, at + chunk)
                own = slice(edges[at], edges[stop])
                values = sums[:, :stop - at]
                values[:dag.n_terms] = 0
                values[terms[own], rows[own] - at] = parts[own]
                dag.evaluate(values)
                best.offer(values[dag.roots], ids[at:stop], named[at:stop])
        queries, found, is_named, scores = best.rows()
        yield pa.RecordBatch.from_arrays(
            [pa.array(queries, pa.int32()), pa.array(found, pa.int64(), mask=~is_named.astype(bool)), pa.array(scores, pa.int64())],
            names=["query", "doc_id", "score"])

    return counts.mapInArrow(run, "query int, doc_id long, score long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    salted = found.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(_SALTS)))
    salted = salted.withColumn("place", F.row_number().over(Window.partitionBy("query", "salt").orderBy(*order))).where(F.col("place") <= top)
    ranked = salted.drop("salt", "place").withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
    return ranked.where(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = 50, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
           item_text_col: str = "text", block_items: int = 2048, block_terms: int = 1 << 17) -> DataFrame:
    """Per query its best documents: item_id, rank (from 1), doc_id, score."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = scratch_path(spark, "search-results")
    schema = "item_id long, rank int, doc_id long, score long"
    spark.createDataFrame([], schema).write.parquet(out)
    for block in blocks(items, item_id_col, item_text_col, block_items, block_terms):
        path = scratch_path(spark, "search-counts")
        term_counts(src, block).write.parquet(path)
        counts = spark.read.schema("doc_id long, n long, terms array<int>, counts array<int>").parquet(path)
        total = counts.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
        if not total.docs:
            continue
        df = np.zeros(len(block.hashes), dtype=np.int64)
        for row in counts.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():
            df[row.t] = row.df  # the block's terms
        weights = np.array([math.floor(1000 * math.log((2 * total.docs + 2) / (2 * f + 1))) for f in df.tolist()], dtype=np.int64)
        dag = QueryDag(block.terms, len(block.hashes))
        found = best_documents(counts, block, dag, weights, total.docs, total.terms, top)
        names = spark.createDataFrame(list(enumerate(block.ids)), "query int, item_id long")
        ranked = _ranked(found, top).join(F.broadcast(names), "query")  # one block of queries
        ranked.select("item_id", F.col("rank").cast("int"), "doc_id", "score").write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out)
