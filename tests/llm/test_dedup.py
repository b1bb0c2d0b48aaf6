"""Jaccard join (3), line runs (8), digest index (10)."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import EXTRA, WORD, edge_rows, prose, table

from qualia.llm import jaccard_join
from qualia.llm.components import connected_components
from qualia.llm.digest_index import DigestIndex
from qualia.llm.jaccard_join import JaccardJoin, Scheme
from qualia.llm.line_runs import LineRuns


def shingles(text):
    words = [w.encode().lower() for w in WORD.findall(text or "")]
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute_components(rows):
    """Component id per row index, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                label[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    out = {}
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            out[i] = min(ids, default=None)
    return [(rows[i][0], len(sets[i]), out[i]) for i in range(len(rows))]


def near_rows(seed, hot):
    """Families of near copies around the threshold, a passage most texts share, and short texts."""
    rng = random.Random(seed)
    passage = prose(rng, 40)
    rows, k = [], 0
    for _ in range(25):
        base = prose(rng, rng.randrange(6, 120)).split()
        for _ in range(rng.randrange(1, 7)):
            words = list(base)
            for _ in range(rng.randrange(0, 1 + len(words) // 20)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            text = " ".join(words)
            rows.append((k, f"{passage} {text}" if rng.random() < hot else text))
            k += 1
    rows += [(k + i, " ".join(["a", "b", "c", "d", "e", "f", "g", "h"][:i])) for i in range(9)]
    return rows


@pytest.mark.parametrize("hot", [0.0, 0.7])
def test_components_match_brute_force(spark, tmp_path, hot):
    rows = near_rows(7, hot)
    # few buckets and no slack: most prefix tokens are frequent, so token pairs are used
    join = JaccardJoin(table(spark, tmp_path, rows), sketch_bits=12, rare_excess=-10**6 if hot else 0, filter_bits=14)
    found = Counter((r.doc_id, r.n_shingles, r.component_id) for r in join.components().collect())
    assert found == Counter(brute_components(rows))


def brute_links(rows):
    """Pairs of different sets that are similar, each as its first document's id."""
    first = {}
    for i, text in rows:
        if shingles(text):
            first.setdefault(shingles(text), []).append(i)
    sets = {s: min((i for i in ids if i is not None), default=None) for s, ids in first.items()}
    keys = list(sets)
    return [(keys[i], keys[j]) for i in range(len(keys)) for j in range(i)
            if 100 * len(keys[i] & keys[j]) >= 75 * len(keys[i] | keys[j])], sets


@pytest.mark.parametrize("hot", [0.0, 0.7])
def test_links_match_brute_force(spark, tmp_path, hot):
    rows = near_rows(8, hot)
    body = prose(random.Random(12), 80)
    rows += [(1000 + i, f"{body} tail{i}") for i in range(5)] + [(1005, f"{body} tail0")]  # five similar texts, one twice
    join = JaccardJoin(table(spark, tmp_path, rows), sketch_bits=12, rare_excess=-10**6 if hot else 0, filter_bits=14)
    links, ids = brute_links(rows)
    degree = Counter(s for link in links for s in link)
    assert {r.doc_id: r.n_links for r in join.link_counts().collect()} == {i: degree[shingles(t)] for i, t in rows}
    assert degree[shingles(f"{body} tail3")] == 4
    assert Counter(frozenset((r.a_id, r.b_id)) for r in join.links().collect()) == Counter(frozenset((ids[a], ids[b])) for a, b in links)


def test_join_edge_cases(spark, tmp_path):
    rows = edge_rows()
    docs = table(spark, tmp_path, rows)
    join = JaccardJoin(docs, sketch_bits=12, filter_bits=14)
    found = Counter((r.doc_id, r.n_shingles, r.component_id) for r in join.components().collect())
    assert found == Counter(brute_components(rows))
    kept = join.keep_first()
    assert kept.columns == docs.columns
    groups = Counter((c, n == 0) for _, n, c in brute_components(rows))
    assert kept.count() == sum(1 if not empty else n for (c, empty), n in groups.items() if c is not None) + sum(
        n for (c, empty), n in groups.items() if c is None)


def test_join_of_an_empty_table(spark, tmp_path):
    docs = table(spark, tmp_path, [])
    assert JaccardJoin(docs, sketch_bits=12, filter_bits=14).components().count() == 0


@pytest.mark.parametrize("frequent", [0.0, 0.5, 1.0])
def test_similar_sets_share_an_entry(frequent):
    rng = np.random.default_rng(11)
    counts = np.where(rng.random(1 << 12) < frequent, 1000, rng.integers(1, 50, 1 << 12)).astype(np.uint32)
    scheme = Scheme(75, 100, counts, 500)
    met = 0
    for _ in range(1500):
        n = int(rng.choice([3, 4, 5, 7, 9, 12, 20, 40, 100, 300]))
        x = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        drop = int(rng.integers(0, n // 4 + 1))
        add = rng.integers(0, 2**64, int(rng.integers(0, n // 3 + 1)), dtype=np.uint64)
        y = np.unique(np.concatenate([rng.permutation(x)[drop:], add]))
        common = len(np.intersect1d(x, y))
        if common * 100 >= 75 * (len(x) + len(y) - common) and not np.array_equal(x, y):
            met += 1
            assert len(np.intersect1d(scheme.entries(x), scheme.entries(y)))
    assert met > 200


@pytest.mark.parametrize("local_links", [0, 10**6])
def test_components_of_chains_and_stars(spark, local_links):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1, k) for k in range(2, 60)] + [(2, 1), (1, 2), (5, 5)]
    links = spark.createDataFrame(chain + star, "a long, b long")
    found = {r.node: r.label for r in connected_components(links, local_links=local_links).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, **{k: 1 for k in range(1, 60)}}


def brute_lines(rows, least):
    def key(line):
        return line.encode().strip(b" \t\n\x0b\x0c\r").lower()

    count = Counter()
    for _, t in rows:
        count.update({key(x) for x in (t or "").split("\n")} - {b""})
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key(x) or count[key(x)] < least]
        text = "\n".join(kept)
        out[i, len(lines), len(lines) - len(kept), hashlib.sha256(text.encode()).hexdigest(), text] += 1
    return out


@pytest.mark.parametrize("batches,fanout", [(1, 2), (5, 2)])
def test_common_lines(spark, tmp_path, batches, fanout):
    rng = random.Random(2)
    common = ["Share this", "  share THIS ", "ÉTÉ", "été", "Subscribe\x0b", "", " "]
    rows = edge_rows() + [(100 + i, "\n".join(rng.choice(common + [prose(rng, 4)]) for _ in range(rng.randrange(8)))) for i in range(80)]
    docs = table(spark, tmp_path, rows)
    runs = LineRuns(spark, buckets=4, min_docs=10, fanout=fanout)
    for b in range(batches):
        runs.add(docs.where(f"pmod(coalesce(doc_id, 0), {batches}) = {b}"))
    assert all(len(level) < fanout for level in runs.levels)
    found = runs.drop_common(docs, filter_bits=14).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256, r.kept_text) for r in found) == brute_lines(rows, 10)


def test_lines_of_an_empty_table(spark, tmp_path):
    docs = table(spark, tmp_path, [])
    runs = LineRuns(spark, buckets=2)
    runs.add(docs)
    assert runs.line_runs().count() == 0 and runs.drop_common(docs, filter_bits=14).count() == 0


def test_digest_decisions(spark, tmp_path):
    rows = edge_rows()
    docs = table(spark, tmp_path, rows)
    index = DigestIndex(spark, buckets=3)
    found = index.decide(docs).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    best = {t: max(ids, key=lambda i: (i is not None, i)) for t, ids in groups.items()}
    expected = Counter((i, best[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == expected
    kept = [r for r in found if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted({r.text_sha256 for r in found})
    assert all(r.doc_id == r.keep_id for r in kept)
    assert index.read().count() == len(groups)


def test_a_later_batch_is_deduplicated_against_the_index(spark, tmp_path):
    index = DigestIndex(spark, buckets=3)
    first = table(spark, tmp_path, [(1, "a"), (2, "b"), (3, "a")], "first")
    second = table(spark, tmp_path, [(9, "a"), (4, "c"), (5, "c"), (6, None)], "second")
    assert {r.doc_id for r in index.keep(first).collect()} == {2, 3}
    kept = index.keep(second)
    assert {r.doc_id for r in kept.collect()} == {5, 6} and kept.columns == ["doc_id", "text", *EXTRA]
    again = DigestIndex(spark, path=index.path, buckets=3)  # opened from its files
    assert again.read().count() == 4
    third = {r.doc_id: r for r in again.decide(second).collect()}
    assert not any(r.kept for r in third.values()) and third[9].keep_id == 3 and third[4].keep_id == 5


def test_digests_of_an_empty_table(spark, tmp_path):
    docs = table(spark, tmp_path, [])
    index = DigestIndex(spark, path=str(tmp_path / "it's"), buckets=2)
    assert index.decide(docs).count() == 0 and index.keep(docs).count() == 0


def test_long_entries_meet_group_by_group(spark, tmp_path, monkeypatch):
    # All texts share a passage's token in their prefixes: one entry of 80 sets, half of them in pairs of similar ones.
    monkeypatch.setattr(jaccard_join, "GROUP", 7)
    rng = random.Random(11)
    passage, rows = prose(rng, 20), []
    for k in range(0, 80, 2):
        end = [f"x{rng.randrange(10**6)}" for _ in range(5)]
        rows.append((k, f"{passage} {' '.join(end)}"))
        rows.append((k + 1, f"{passage} {' '.join(end[:4] if k % 4 else end[::-1])} y{k}"))
    join = JaccardJoin(table(spark, tmp_path, rows), sketch_bits=16, rare_excess=10**6, filter_bits=14, hub_rounds=1)
    written, plans = join._written, {}

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return written(df, name)

    monkeypatch.setattr(join, "_written", watched)
    found = Counter((r.doc_id, r.n_shingles, r.component_id) for r in join.components().collect())
    assert found == Counter(brute_components(rows))
    assert len({c for _, _, c in found}) == 60
    known = spark.createDataFrame([], "node long, label long")
    sizes = join._open(join._joined()[2], known).groupBy("entry", "k").count().collect()
    assert max(r.k for r in sizes) > 5 * 7 and all(r.k == r["count"] for r in sizes)
    # its members met under keys of (entry, group, group), so that no key holds all of them
    assert any("Join Inner" in line and "(i#" in line and "(j#" in line for line in plans["open"].split("\n") + plans["more"].split("\n"))


def near_family(rng, size):
    """Texts of one passage with some words replaced: some are similar to many others, some to none."""
    words = prose(rng, 60).split()
    rows = []
    for k in range(size):
        own = list(words)
        for at in rng.sample(range(60), rng.randrange(1, 4)):
            own[at] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(own)))
    return rows


def test_entries_of_a_family_meet_once(spark, tmp_path, monkeypatch):
    # A family of near copies shares many entries that hold most of it each: its rows were joined once for each of them.
    rows = near_family(random.Random(5), 60)
    join = JaccardJoin(table(spark, tmp_path, rows), sketch_bits=16, rare_excess=0, filter_bits=14, hub_rounds=1)
    written, seen = join._written, {}

    def watched(df, name):
        seen[name] = written(df, name)
        return seen[name]

    monkeypatch.setattr(join, "_written", watched)
    found = Counter((r.doc_id, r.n_shingles, r.component_id) for r in join.components().collect())
    assert found == Counter(brute_components(rows)) and 1 < len({c for _, _, c in found}) < 60
    assert 4 * seen["merged"].count() < seen["open"].count()


def test_merged_entries_lose_no_pair(spark, tmp_path):
    rng = random.Random(6)
    join = JaccardJoin(table(spark, tmp_path, []))
    label = {n: rng.choice([1, 1, n]) for n in range(1, 40)}
    own = {-e: rng.sample(range(1, 15), 11) for e in range(1, 9)}  # of few nodes: one entry of several has fewer pairs
    own |= {-e: [1, n, 40 + e] for e, n in zip(range(20, 30), range(15, 25))}  # of many
    label |= {n: n for ns in own.values() for n in ns if n > 39}
    open_ = spark.createDataFrame([(e, n, label[n], len(ns)) for e, ns in own.items() for n in ns], "entry long, node long, label long, k long")
    merged = join._merged(open_).collect()
    assert len(merged) == len(set(merged)) < sum(map(len, own.values())) and all(r.label == label[r.node] for r in merged)
    entries = defaultdict(set)
    for r in merged:
        entries[r.entry].add(r.node)
    assert all(any(set(ns) <= held for held in entries.values()) for ns in own.values())
    assert sum(len(held) * (len(held) - 1) for held in entries.values()) <= sum(len(ns) * (len(ns) - 1) for ns in own.values())


def test_a_family_without_fewer_pairs_stays_apart(spark, tmp_path):
    join = JaccardJoin(table(spark, tmp_path, []))
    own = {-e: [1, 10 + 2 * e, 11 + 2 * e] for e in range(1, 9)}  # m of them: 6 m pairs by entry, (2 m + 1) 2 m at once
    open_ = spark.createDataFrame([(e, n, n, 3) for e, ns in own.items() for n in ns], "entry long, node long, label long, k long")
    assert sorted((r.entry, r.node) for r in join._merged(open_).collect()) == sorted((e, n) for e, ns in own.items() for n in ns)
