"""Ranked lexical search (11): brute force, the sharing graph, edge cases."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import edge_rows, table

from qualia.llm import lexical_search
from qualia.llm.query_dag import QueryDag

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(docs, items, top):
    """item number -> its best (score, doc_id), one document per row."""
    counted = [(i, Counter(words(t))) for i, t in docs if words(t)]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = {}
    for k, (_, text) in enumerate(items):
        found = []
        for i, c in counted:
            n, score = sum(c.values()), 0
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            for t in set(words(text)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, i is not None, i or 0))
        out[k] = [(rank, i if named else None, -s) for rank, (s, named, i) in enumerate(sorted(found)[:top], 1)]
    return out


def corpus(rng, n=150):
    # a few words are in nearly all texts, most in some
    def text():
        return " ".join(rng.choice(["The", "and,", "it's", f"w{int(rng.paretovariate(0.7))}", f"Ä{rng.randrange(9)}"]) for _ in range(rng.randrange(1, 60)))

    return [(i, text()) for i in range(n)]


@pytest.mark.parametrize("top,block_items", [(50, 2048), (7, 3)])
def test_search_is_the_brute_force_ranking(spark, tmp_path, top, block_items):
    rng = random.Random(3)
    docs = corpus(rng) + [(i + 1000, t) for i, t in edge_rows()[:10]] + [(None, "the w1 w2"), (None, "the w1 w2"), (5000, None)]
    items = [(i, t) for i, t in corpus(rng, 20)] + [(90, None), (91, "?!"), (92, "nowhere"), (93, "The THE the")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    found = lexical_search.search(table(spark, tmp_path, docs), frame, top=top, block_items=block_items).collect()
    got = defaultdict(list)
    for r in found:
        got[r.item_id].append((r.rank, r.doc_id, r.score))
    expected = {items[k][0]: rows for k, rows in brute_force(docs, items, top).items() if rows}
    assert {i: sorted(rows) for i, rows in got.items()} == expected


def test_repeated_and_null_items_each_have_their_result(spark, tmp_path):
    docs = [(1, "alpha beta"), (2, "alpha"), (3, "gamma delta delta")]
    items = spark.createDataFrame([(7, "beta"), (7, "beta"), (None, "gamma"), (8, "")], "item_id long, text string")
    found = Counter(tuple(r)[:3] for r in lexical_search.search(table(spark, tmp_path, docs), items).collect())
    assert found == {(7, 1, 1): 2, (None, 1, 3): 1}


def test_empty_tables(spark, tmp_path):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    some = table(spark, tmp_path, [(1, "a")], name="some")
    none = table(spark, tmp_path, [], name="none")
    assert lexical_search.search(none, items).count() == 0
    assert lexical_search.search(some, items.where("item_id > 1")).count() == 0
    assert lexical_search.search(table(spark, tmp_path, [(1, None), (2, " ")], name="blank"), items).columns == ["item_id", "rank", "doc_id", "score"]


def test_graph_sums_each_query_once_and_shares(spark):
    rng = random.Random(1)
    common = list(range(30))
    queries = [sorted(set(rng.sample(common, 18)) | set(rng.sample(range(30, 200), 5))) for _ in range(40)] + [[], [3], common, common]
    dag = QueryDag(queries, 200)
    rows = np.zeros((dag.n_nodes, 200), dtype=np.int64)
    rows[:200] = np.eye(200, dtype=np.int64)  # document d holds term d only: sums are term sets
    dag.evaluate(rows)
    for terms, root in zip(queries, dag.roots.tolist()):
        if not terms:
            assert root == -1
        else:
            assert np.flatnonzero(rows[root]).tolist() == terms and rows[root].max() == 1
    alone = sum(max(0, len(q) - 1) for q in queries)
    assert dag.additions < 0.8 * alone
    assert dag.roots[-1] == dag.roots[-2]


def test_graph_makes_a_shared_set_once(spark):
    shared = list(range(50))
    dag = QueryDag([[*shared, 50 + q] for q in range(20)], 70)
    assert dag.additions == 49 + 20
