"""Token store (1), codec query (5), packing (7)."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.orc as orc
import pytest
from helpers import edge_rows, table
from tokenizers import Tokenizer

from qualia.llm import pair_bpe, ss_pack, token_store

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD)


def with_end(library, text, end):
    return np.asarray(library.encode(text or "", add_special_tokens=False).ids + [end], dtype="<u4")


def test_store_is_ordered_and_complete(spark, tmp_path, library):
    rows = edge_rows()
    path = str(tmp_path / "store")
    token_store.write_token_store(table(spark, tmp_path, rows), path, WORD)
    found = sorted(token_store.token_digests(spark, path).collect(), key=lambda r: r.start)
    start = 0
    for r in found:
        assert r.start == start
        start += r.n_tokens
    ids = [-1 if r.doc_id is None else r.doc_id for r in found]
    assert ids == sorted(ids)
    expected = Counter((i, zlib.crc32(with_end(library, t, 2).tobytes())) for i, t in rows)
    assert Counter((r.doc_id, r.ids_crc32) for r in found) == expected


def test_store_files_have_stripes_and_prune(spark, tmp_path):
    rows = [(i, f"text number {i}") for i in range(3000)]
    path = str(tmp_path / "store")
    token_store.write_token_store(table(spark, tmp_path, rows), path, WORD, stripe_bytes=4096, row_index_stride=1000)
    files = [orc.ORCFile(str(p)) for p in (tmp_path / "store").glob("*.orc")]
    assert sum(f.nrows for f in files) == 3000 and all(f.nstripes >= 1 for f in files)
    one = token_store.read_token_store(spark, path, ids=[77])
    assert [r.doc_id for r in one.collect()] == [77]
    assert "PushedFilters: [In(doc_id" in one._jdf.queryExecution().toString() or "EqualTo(doc_id" in one._jdf.queryExecution().toString()


@pytest.mark.parametrize("size,max_open", [(2048, 4096), (16, 3), (16, 4096)])
def test_pieces_cover_every_id_without_gaps(spark, tmp_path, library, size, max_open):
    rows = edge_rows()
    found = ss_pack.pack(table(spark, tmp_path, rows), WORD, size=size, max_open=max_open).collect()
    windows = defaultdict(list)
    own = defaultdict(list)
    for p in found:
        assert zlib.crc32(np.asarray(p.ids, dtype="<u4").tobytes()) == p.ids_crc32 and len(p.ids) == p.length > 0
        windows[p.sequence_id].append((p.offset, p.length))
        own[p.doc_id].append(p)
    for pieces in windows.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= size and (end == size or end & (end - 1) == 0)  # no padding is left
    expected = Counter()
    for i, t in rows:
        expected[i] += len(with_end(library, t, 1))
    assert {i: sum(p.length for p in ps) for i, ps in own.items()} == dict(expected)
    for i in (1, 10, 12, 14):
        text = next(t for j, t in rows if j == i)
        joined = [x for p in sorted(own[i], key=lambda p: p.start) for x in p.ids]
        assert joined == with_end(library, text, 1).tolist()


def test_level_rule_minimises_the_sum_of_squares():
    rng = np.random.default_rng(1)
    packer = ss_pack.LevelPacker(32, 10_000, 0)
    for _ in range(400):
        n = int(rng.integers(1, 32))
        cost = {}
        for level in [0, *np.flatnonzero(packer.counts[1:32 - n + 1]).tolist()]:
            after = packer.counts.copy()
            level += bool(level) or 0
            if level:
                after[level] -= 1
            if level + n < 32:
                after[level + n] += 1
            cost[level] = int((after**2).sum())
        assert cost[packer.level_for(n)] == min(cost.values())
        packer.add((0, 0, b""), n)


def test_codec_query(spark, tmp_path):
    rows = edge_rows()
    library = Tokenizer.from_file(BYTE)
    found = pair_bpe.encode_decode(table(spark, tmp_path, rows), BYTE).collect()
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.decoded, tuple(r.ids)) for r in found)
    expected = Counter()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        raw = np.asarray(ids, dtype="<u4").tobytes()
        expected[i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), t or "", tuple(ids)] += 1
    assert got == expected


def test_empty_tables(spark, tmp_path):
    docs = table(spark, tmp_path, [])
    token_store.write_token_store(docs, str(tmp_path / "store"), WORD)
    assert token_store.token_digests(spark, str(tmp_path / "store")).count() == 0
    assert ss_pack.pack(docs, WORD).count() == 0
    assert pair_bpe.encode_decode(docs, BYTE).count() == 0
