"""Exact Jaccard similarity join on word shingles with token-combination prefixes.

Sets are the distinct shingles (``words`` words) of a text, as 64-bit hashes. All tokens have one
global order: by how often their hash bucket occurs (a fixed-size sketch over all documents), then
by hash, so rare tokens come first and those of shared passages last. Tokens whose bucket count
stands far out of the mean are *frequent*, the rest *rare*.

Two sets x, y with |x & y| >= t |x | y| share at least k tokens in their prefixes of length
|x| - ceil(t |x|) + k. Frequent tokens are dealt into m classes by hash; with k = m + 1 either a rare
token is shared, or two frequent tokens of one class. So the index holds rare prefix tokens singly
and pairs of frequent prefix tokens of one class, and pairs carry the smaller set's size step, which
sets m. With c plain prefix tokens p to a class, m = p / c and the prefix is p (1 + 1 / c) long, so there are about
p (c + 1)^2 / 2c pairs: fewest, 2p, for c = 1. So m = p, prefixes are twice as long, and a candidate has more than p
of them in common. A set without frequent tokens in its plain prefix (k = 1) needs no more than that prefix.

Equal sets are one node, and entries with equal nodes are one entry. Sets that share an index entry
are candidates, but not all pairs of them are made: in a few rounds each set of an entry is compared with one hub of it, verified links are
contracted to components, and only entries that still hold several components go on. At the end, those
with the same min-hash of their sets become one entry of all their sets where that makes no more pairs (a family of near
copies shares hundreds of entries, each with most of it), and
pairs of an entry are compared only across components, not again where both sets have a smaller entry among their
first ``FIRST_ENTRIES`` ones, and only if sizes and the parity bitmaps of both sets (a bound on their difference) allow the similarity. Verification counts the common
shingles of the whole sets. No link between different components is left out, so components are exact
(up to collisions of 64-bit hashes). For the links themselves (``link_counts`` and ``links``) the pairs of an
entry inside of one component that were not tested yet are verified too, as far as the same bound
allows them; their number grows with the square of a family's different texts, as that of its links.

Defined results: null or empty text, or text without words: empty set, linked with nothing. Fewer
words than ``words``: the sequence is the one shingle. Repeated rows are equal sets. Null doc_ids
take part; a component's id is its smallest non-null doc_id. Very long texts are sets like others, read whole. An empty table gives no rows; other
columns are not read by ``components`` and kept by ``keep_first``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qualia.llm.batches import combine, free_name, hashed_words, mix, slices
from qualia.llm.components import connected_components
from qualia.llm.sketch import bucket_counts
from qualia.session import scratch_path

PARITY = 32  # 64-bit words of a set's parity bitmap
SLICE = 1 << 20  # bytes of text that are hashed at once
FOLDED = 16  # words of it, folded by xor, that go with a set's rows of open entries
FIRST_ENTRIES = 16  # a set's smallest open entries that go with each of its rows
GROUP = 1000  # entries of k > GROUP members are dealt into about sqrt(k / GROUP) groups, so that k * GROUP pairs meet at once
GROUPS = 8  # groups of an entry at most, so that a row is dealt out that often at most
CLASS_SIZE = 1  # plain prefix tokens to a class of frequent tokens, about


def shingle_sets(column: pa.Array, words: int, distinct: bool = True) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text (or, cheaper, all of them in text order)."""
    hashes, bounds = hashed_words(column)
    n = np.diff(bounds)
    full = len(hashes) - words + 1
    windows = combine([hashes[j:full + j] for j in range(words)]) if full > 0 else np.zeros(0, np.uint64)
    out = []
    for row, (start, count) in enumerate(zip(bounds[:-1].tolist(), n.tolist())):
        if count >= words:
            own = windows[start:start + count - words + 1]
            if distinct:
                own = np.sort(own)
                fresh = own[1:] != own[:-1]
                if not fresh.all():
                    own = own[np.concatenate([[True], fresh])]
            out.append(own)
        elif count:
            out.append(combine([hashes[start + j:start + j + 1] for j in range(count)]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def node_of(shingles: np.ndarray) -> int:
    """64-bit id of a set (signed)."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


class Scheme:
    """Prefix lengths, size steps and index entries for a similarity of ``num / den``."""

    def __init__(self, num: int, den: int, counts: np.ndarray, rare_limit: float):
        self.num, self.den, self.counts, self.rare_limit = num, den, counts, rare_limit
        self.shift = np.uint64(64 - (len(counts).bit_length() - 1))
        self.steps = [1]
        while self.steps[-1] < 1 << 40:
            self.steps.append(self.steps[-1] * den // num + 1)

    def reachable(self, n: int) -> bool:
        """Whether a set of ``n`` can be similar to a different set: one token more must be allowed."""
        return n * self.den >= (n + 1) * self.num

    def prefix(self, n: int) -> int:
        """Plain prefix length (k = 1) of a set of ``n``."""
        return n + (-n * self.num) // self.den + 1

    def classes(self, step: int) -> int:
        """Frequent-token classes for pairs whose smaller set is in a size step."""
        least = -(-self.steps[step] * self.num // self.den)  # tokens that similar sets of that size share
        return max(1, min(-(-self.prefix(self.steps[step]) // CLASS_SIZE), least - 1))

    def entries(self, shingles: np.ndarray) -> np.ndarray:
        """Index entries of a set; none for sets that only an equal set can reach."""
        n = len(shingles)
        if not self.reachable(n):
            return np.zeros(0, np.uint64)
        plain = self.prefix(n)
        counts = self.counts[shingles >> self.shift]
        # shingles are sorted, so that their index breaks ties by hash
        order = (np.sort(counts.astype(np.uint64) << np.uint64(32) | np.arange(n, dtype=np.uint64)) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        rare = counts[order] <= self.rare_limit
        if rare[:plain].all():
            return shingles[order[:plain]]
        step = int(np.searchsorted(self.steps, n, side="right")) - 1
        longest = min(n, plain + self.classes(step))
        out = [shingles[order[:longest][rare[:longest]]]]
        for at in {step, max(0, step - 1)}:
            m = self.classes(at)
            near = order[:min(n, plain + m)][~rare[:min(n, plain + m)]]
            tokens = np.sort(shingles[near])
            kind = mix(tokens) % np.uint64(m)
            by_class = np.argsort(kind, kind="stable")
            tokens, kind = tokens[by_class], kind[by_class]
            for apart in range(1, len(tokens)):  # pairs of a class that are so far apart, for all classes at once
                same = kind[apart:] == kind[:-apart]
                if not same.any():
                    break
                first = tokens[:-apart][same]
                out.append(combine([first, tokens[apart:][same], np.full(len(first), at + 1, np.uint64)]))
        return np.unique(np.concatenate(out))


def parity_bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """Per set, ``PARITY`` words whose bits are the parities of the tokens that fall on them."""
    out = np.zeros((len(sets), PARITY), dtype=np.uint64)
    tokens = np.concatenate(sets)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    word = ((tokens >> np.uint64(6)) % np.uint64(PARITY)).astype(np.int64)
    np.bitwise_xor.at(out.reshape(-1), rows * PARITY + word, np.uint64(1) << (tokens & np.uint64(63)))
    return out.view(np.int64)


def _of_keys(batches: Iterable[pa.RecordBatch], wanted: np.ndarray, shift: np.uint64) -> Iterator[pa.RecordBatch]:
    """The rows whose key falls on a flag of ``wanted``."""
    for batch in batches:
        keys = batch.column("key").to_numpy().view(np.uint64)
        yield batch.filter(pa.array(wanted[mix(keys) >> shift]))


def _similar_sizes(num: int, den: int, a: Column, b: Column) -> Column:
    return F.least(a, b) * den >= F.greatest(a, b) * num


class JaccardJoin:
    """Links and components of ``docs`` at a similarity of ``num / den`` or more."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 75,
                 den: int = 100, sketch_bits: int = 22, filter_bits: int = 22, hub_rounds: int = 2, rare_excess: int = 200):
        self.spark, self.words, self.num, self.den = docs.sparkSession, words, num, den
        self.sketch_bits, self.filter_bits, self.hub_rounds = sketch_bits, filter_bits, hub_rounds
        self.rare_excess = rare_excess  # a bucket count this far (and 8 deviations) over the mean is frequent
        self.source = docs
        self.docs = docs.select(
            F.monotonically_increasing_id().alias("at"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
            F.xxhash64(text_col).alias("key"))
        self.texts = self.docs.select("text")
        self.joined = self.all_links = self.keys = None

    def _written(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, f"jaccard-{name}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def rows(self) -> DataFrame:
        """at (input position), doc_id, key (hash of the text), n (set size), node (null for the empty set) and the parity
        words p0.. of its set."""
        words = self.words

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, max_bytes=SLICE):
                sets = shingle_sets(batch.column("text"), words)
                parity = parity_bitmaps(sets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("at"), batch.column("doc_id"), batch.column("key"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                     *(pa.array(parity[:, w]) for w in range(PARITY))],
                    names=["at", "doc_id", "key", "n", "node", *(f"p{w}" for w in range(PARITY))])

        return self.docs.mapInArrow(run, "at long, doc_id long, key long, n long, node long, " + ", ".join(f"p{w} long" for w in range(PARITY)))

    def _counts(self) -> np.ndarray:
        words, shift = self.words, np.uint64(64 - self.sketch_bits)

        def buckets(batch: pa.RecordBatch) -> np.ndarray:
            return (np.concatenate(shingle_sets(batch.column("text"), words, distinct=False)) >> shift).astype(np.int64)

        return bucket_counts(self.texts, buckets, self.sketch_bits, lambda batches: slices(batches, max_bytes=SLICE))

    def _index(self, scheme, wanted=None) -> DataFrame:
        """entry, node for each distinct set of a partition; only entries in buckets of ``wanted``."""
        words, shift = self.words, np.uint64(64 - self.filter_bits)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for batch in slices(batches, max_bytes=SLICE):
                entries, nodes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                for shingles in shingle_sets(batch.column("text"), words):
                    if not scheme.value.reachable(len(shingles)) or (node := node_of(shingles)) in seen:
                        continue
                    seen.add(node)
                    own = scheme.value.entries(shingles)
                    if wanted is not None:
                        own = own[wanted.value[mix(own) >> shift]]
                    entries.append(own)
                    nodes.append(np.full(len(own), node, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(entries).view(np.int64)), pa.array(np.concatenate(nodes))], names=["entry", "node"])

        return self.texts.mapInArrow(run, "entry long, node long")

    def _filter(self, rows: DataFrame, column: str):
        """Broadcast bitmap of the hash buckets of a long column: 2 ** filter_bits flags."""
        shift = np.uint64(64 - self.filter_bits)

        def buckets(batch: pa.RecordBatch) -> np.ndarray:
            return (mix(batch.column(column).to_numpy().view(np.uint64).copy()) >> shift).astype(np.int64)

        return self.spark.sparkContext.broadcast(bucket_counts(rows.select(column), buckets, self.filter_bits) > 0)

    def _sets(self, keys: DataFrame) -> DataFrame:
        """node, shingles: the whole sets of the texts with these keys (and of few others, whose hash buckets are the
        same). Other texts are passed over before their words are hashed."""
        words, shift = self.words, np.uint64(64 - self.filter_bits)
        wanted = self._filter(keys, "key")

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for batch in slices(_of_keys(batches, wanted.value, shift), max_bytes=SLICE):
                nodes, sets = [], []
                for shingles in shingle_sets(batch.column("text"), words):
                    if len(shingles) and (node := node_of(shingles)) not in seen:
                        seen.add(node)
                        nodes.append(node)
                        sets.append(shingles.view(np.int64))
                if nodes:
                    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(nodes, pa.int64()), pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(sets)))],
                        names=["node", "shingles"])

        # bucketed by node: the joins read it in place and shuffle their pairs only
        name, buckets = f"shingle_sets_{uuid.uuid4().hex}", int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        found = self.docs.select("text", "key").mapInArrow(run, "node long, shingles array<long>").repartition(buckets, "node").dropDuplicates(["node"])
        found.write.format("parquet").bucketBy(buckets, "node").sortBy("node").option(
            "path", scratch_path(self.spark, "jaccard-sets")).saveAsTable(name)
        wanted.unpersist()
        return self.spark.table(name)

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose whole sets are similar; one text of each of their nodes is hashed again."""
        ends = pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")).distinct()
        sets = self._sets(self.keys.join(ends, "node", "left_semi"))
        a, b = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
        both = pairs.join(b, "b").join(a, "a")
        common = F.size(F.array_intersect("sa", "sb"))
        union = F.size("sa") + F.size("sb") - common
        return self._written(both.where(common * self.den >= union * self.num).select("a", "b"), "links")

    def _possible(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """Pairs (a, b) that sizes and parity bitmaps allow: |a ^ b| >= the bits they differ in."""
        for side in ("a", "b"):
            pairs = pairs.join(nodes.select(F.col("node").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in nodes.columns if c != "node")), side)
        return pairs.where(self._bound("a_", "b_")).select("a", "b")

    def _bound(self, a: str, b: str, parity: int = PARITY) -> Column:
        differ = sum((F.bit_count(F.col(f"{a}p{w}").bitwiseXOR(F.col(f"{b}p{w}"))) for w in range(parity)), F.lit(0))
        n_a, n_b = F.col(f"{a}n"), F.col(f"{b}n")
        # |a ^ b| <= (|a| + |b|) (1 - t) / (1 + t)
        return _similar_sizes(self.num, self.den, n_a, n_b) & (differ * (self.den + self.num) <= (n_a + n_b) * (self.den - self.num))

    def components(self) -> DataFrame:
        """Per document: doc_id, n_shingles, component_id, first (whether it is the component's first row: smallest
        doc_id, then input position) and ``at``. Links inside of a component change nothing here and are not made."""
        rows, _, _, _, _, labels = self._joined()
        return self._result(rows, labels)

    def link_counts(self) -> DataFrame:
        """``components`` with n_links: the number of different sets that a document's set is similar to."""
        ends = self._links()
        ends = ends.select(F.col("a").alias("node")).unionAll(ends.select("b"))
        degree = ends.groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
        rows = self._joined()[0].select("at", "node").join(degree, "node", "left").select("at", F.coalesce("n_links", F.lit(0)).alias("n_links"))
        return self.components().join(rows, "at")

    def links(self) -> DataFrame:
        """a_id, b_id: all pairs of different sets that are similar, each set by its first document (smallest
        doc_id, then input position); the set with the smaller id of its hash is a."""
        rows = self._joined()[0]
        first = F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "at"))
        names = rows.where("node IS NOT NULL").groupBy("node").agg(first.alias("first")).select("node", F.col("first.doc_id").alias("id"))
        return self._links().join(names.toDF("a", "a_id"), "a").join(names.toDF("b", "b_id"), "b").select("a_id", "b_id")

    def _links(self) -> DataFrame:
        """All links (a, b): those that made the components and those of pairs inside of a component."""
        if self.all_links is None:
            _, nodes, members, tested, links, labels = self._joined()
            # A component's pairs are made entry by entry, or once from all its nodes if those are fewer pairs.
            known = self._written(members.select("entry", "node").join(labels, "node"), "inside-members")
            pairs_of = F.col("k") * (F.col("k") - 1)
            by_entry = known.groupBy("label", "entry").agg(F.count(F.lit(1)).alias("k")).groupBy("label").agg(F.sum(pairs_of).alias("by_entry"))
            at_once = labels.groupBy("label").agg(F.count(F.lit(1)).alias("k")).select("label", pairs_of.alias("at_once"))
            group = F.when(F.col("by_entry") <= F.col("at_once"), F.col("entry")).otherwise(F.lit(0))
            full = known.join(by_entry.join(at_once, "label"), "label").select(
                "label", group.alias("group"), "node").distinct().join(nodes, "node")
            columns = [c for c in nodes.columns if c != "node"]
            left, right = (full.select("label", "group", *(F.col(c).alias(f"{side}_{c}") for c in ["node", *columns])) for side in ("a", "b"))
            inside = left.join(right, ["label", "group"]).where((F.col("a_node") < F.col("b_node")) & self._bound("a_", "b_"))
            pairs = inside.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()
            pairs = self._written(pairs.join(tested, ["a", "b"], "left_anti"), "inside")
            self.all_links = links if pairs.isEmpty() else links.unionAll(self._verified(pairs))
        return self.all_links

    def _joined(self) -> tuple[DataFrame, ...]:
        """rows, nodes, members, tested pairs, links found between components, and labels; made once."""
        if self.joined is None:
            self.joined = self._join()
        return self.joined

    def _join(self) -> tuple[DataFrame, ...]:
        rows = self._written(self.rows(), "rows")
        parity = [f"p{w}" for w in range(PARITY)]
        nodes = self._written(
            rows.where(F.col("n") * self.den >= (F.col("n") + 1) * self.num).groupBy("node").agg(
                *(F.first(c).alias(c) for c in ["key", "n", *parity])), "nodes")
        self.keys, nodes = nodes.select("node", "key"), nodes.drop("key")
        counts = self._counts()
        mean = float(counts.mean()) if len(counts) else 0.0
        scheme = self.spark.sparkContext.broadcast(Scheme(self.num, self.den, counts, mean + 8 * mean**0.5 + self.rare_excess))
        shared = self._written(
            self._index(scheme).groupBy("entry").agg(F.min("node").alias("hub"), F.max("node").alias("other")).where("hub <> other")
            .select("entry", "hub"), "shared")
        wanted = self._filter(shared, "entry")
        members = self._written(
            self._index(scheme, wanted).join(shared, "entry").select("entry", "node", "hub").distinct(), "members")
        scheme.unpersist()
        wanted.unpersist()
        # Of entries with the same nodes (as most of a family of near copies are) one is enough.
        alike = members.groupBy("entry", "hub").agg(
            F.bit_xor(F.xxhash64("node")).alias("x"), F.count(F.lit(1)).alias("k"), F.max("node").alias("last"))
        alike = alike.groupBy("hub", "last", "k", "x").agg(F.min("entry").alias("entry")).select("entry")
        members = self._written(members.join(alike, "entry", "left_semi"), "distinct-members")
        tested = members.where("node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
        tested = self._written(self._possible(tested, nodes), "tested")
        links = self._verified(tested)
        labels = connected_components(links)
        for turn in range(1, self.hub_rounds + 1):
            open_ = self._open(members, labels)
            if turn < self.hub_rounds:
                hubs = open_.groupBy("entry").agg(F.min_by(F.struct("node", "label"), F.xxhash64("node", F.lit(turn))).alias("h"))
                pairs = open_.join(hubs, "entry").where("label <> h.label").select(
                    F.least("node", "h.node").alias("a"), F.greatest("node", "h.node").alias("b")).distinct()
            else:
                # A pair that shares many entries is not made in one if both sets have a smaller one among their first;
                # the few pairs made more often are made distinct below.
                met = self._merged(open_)
                place = F.row_number().over(Window.partitionBy("node").orderBy("entry"))
                lists = met.withColumn("place", place).where(F.col("place") <= FIRST_ENTRIES).groupBy("node").agg(
                    F.collect_list("entry").alias("entries"))
                fold = (reduce(Column.bitwiseXOR, (F.col(f"p{v}") for v in range(w, PARITY, FOLDED))).alias(f"p{w}") for w in range(FOLDED))
                full = met.join(nodes.select("node", "n", *fold), "node").join(lists, "node")
                # The members of a long entry are dealt into groups, and each two groups i <= j meet under a key of their own:
                # the join is even, where splitting long entries by itself took thousands of tasks that the driver keeps. A row is dealt
                # out at most GROUPS times, however long its entry is.
                long_ = met.groupBy("entry").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > GROUP).select(
                    "entry", F.least(F.ceil(F.sqrt(F.col("k") / GROUP)), F.lit(GROUPS)).cast("int").alias("groups"))
                full = full.join(F.broadcast(long_), "entry", "left").withColumn("groups", F.coalesce("groups", F.lit(1))).withColumn("group", F.pmod(F.xxhash64("node"), F.col("groups")).cast("int"))
                columns = ["node", "label", "n", "entries", *(f"p{w}" for w in range(FOLDED))]
                left = full.select("entry", F.col("group").alias("i"), F.explode(F.sequence(F.col("group"), F.col("groups") - 1)).alias("j"),
                                   *(F.col(c).alias(f"a_{c}") for c in columns))
                right = full.select("entry", F.explode(F.sequence(F.lit(0), F.col("group"))).alias("i"), F.col("group").alias("j"),
                                    *(F.col(c).alias(f"b_{c}") for c in columns))
                once = F.coalesce(F.array_min(F.array_intersect("a_entries", "b_entries")) >= F.col("entry"), F.lit(True))
                across = left.join(right, ["entry", "i", "j"]).where(
                    (F.col("a_label") != F.col("b_label")) & ((F.col("i") < F.col("j")) | (F.col("a_node") < F.col("b_node")))
                    & self._bound("a_", "b_", FOLDED) & once)
                pairs = across.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()
            pairs = self._possible(pairs, nodes)
            pairs = self._written(pairs.join(tested, ["a", "b"], "left_anti"), "more")
            if pairs.isEmpty():
                continue
            tested = tested.unionAll(pairs)
            more = self._verified(pairs)
            links = links.unionAll(more)
            labels = connected_components(links)
        return rows, nodes, members, tested, links, labels

    def _open(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        """entry, node, label, k (rows of the entry) of the entries that hold several components."""
        known = members.select("entry", "node").join(labels, "node", "left").select(
            "entry", "node", F.coalesce("label", "node").alias("label"))
        known = self._written(known, "known")
        several = known.groupBy("entry").agg(
            F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("k")).where("lo <> hi").select("entry", "k")
        return self._written(known.join(several, "entry"), "open")

    def _merged(self, open_: DataFrame) -> DataFrame:
        """entry, node, label of the open entries, where those of a family (entries with the same smallest hash of a node, as
        entries with mostly the same nodes often have) are one entry of all their nodes, named by that hash, if it has no more
        pairs than they have. No pair of an entry is left out."""
        pairs_of = F.col("k") * (F.col("k") - 1)
        family = self._written(open_.groupBy("entry", "k").agg(F.min(F.xxhash64("node")).alias("family")), "families")
        by_entry = family.groupBy("family").agg(F.sum(pairs_of).alias("by_entry"), F.count(F.lit(1)).alias("entries")).where("entries > 1")
        nodes = open_.select("entry", "node").join(family.join(by_entry, "family").select("entry", "family"), "entry").select("family", "node")
        at_once = nodes.distinct().groupBy("family").agg(F.count(F.lit(1)).alias("k")).select("family", pairs_of.alias("at_once"))
        one = by_entry.join(at_once, "family").where("at_once <= by_entry").select("family")
        names = family.join(one, "family").select("entry", "family")
        merged = open_.join(names, "entry", "left").select(F.coalesce("family", "entry").alias("entry"), "node", "label").distinct()
        return self._written(merged, "merged")

    def keep_first(self) -> DataFrame:
        """The first row of each component, with all columns. ``docs`` must be re-readable in the same
        row order (files or a checkpoint), since rows are told apart by their input position."""
        at = free_name(self.source.columns, "at")
        rows, _, _, _, _, labels = self._joined()
        kept = self._result(rows, labels).where("first").select(F.col("at").alias(at))
        return self.source.withColumn(at, F.monotonically_increasing_id()).join(kept, at, "left_semi").drop(at)

    def _result(self, rows: DataFrame, labels: DataFrame) -> DataFrame:
        rows = rows.select("at", "doc_id", "n", "node")
        first = F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "at"))
        per_node = rows.where("node IS NOT NULL").groupBy("node").agg(first.alias("first"))
        per_node = per_node.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        first = per_node.groupBy("label").agg(F.min("first").alias("top"))
        named = per_node.join(first, "label").select(
            "node", F.col("top.doc_id").alias("component_id"), F.col("top.at").alias("top_at"))
        alone = F.col("node").isNull()
        return rows.join(named, "node", "left").select(
            "doc_id", F.col("n").alias("n_shingles"),
            F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
            (alone | (F.col("at") == F.col("top_at"))).alias("first"), "at")
