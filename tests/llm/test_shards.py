"""Sharding by a Feistel permutation (13)."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import EXTRA, edge_rows, table

from qualia.llm.feistel_shards import Feistel, assign, write_shards

MASK = (1 << 64) - 1


def plain_mix(h):
    h ^= h >> 33
    h = h * 0xFF51AFD7ED558CCD & MASK
    h ^= h >> 33
    h = h * 0xC4CEB9FE1A85EC53 & MASK
    return h ^ h >> 33


def plain_permute(feistel, x):
    """One number at a time, in whole Python numbers."""
    low_bits = int(feistel.low)
    low_mask, high_mask = int(feistel.low_mask), int(feistel.high_mask)
    while True:
        high, low = x >> low_bits, x & low_mask
        for i, key in enumerate(feistel.keys):
            if i % 2:
                low ^= plain_mix(high ^ int(key)) & low_mask
            else:
                high ^= plain_mix(low ^ int(key)) & high_mask
        x = high << low_bits | low
        if x < feistel.n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 5, 40, 64, 65, 1000])
def test_every_number_has_one_image_and_comes_back(n):
    feistel = Feistel(n, seed=7)
    image = feistel.permute(np.arange(n))
    assert sorted(image.tolist()) == list(range(n))
    assert feistel.invert(image).tolist() == list(range(n))
    assert image.tolist() == [plain_permute(feistel, x) for x in range(n)]


def test_shuffle_depends_on_the_seed_and_spreads_neighbours():
    a, b = Feistel(100_000, seed=1).permute(np.arange(100_000)), Feistel(100_000, seed=2).permute(np.arange(100_000))
    assert (a == b).mean() < 0.001
    assert abs(np.corrcoef(np.arange(100_000), a)[0, 1]) < 0.02
    assert abs(np.corrcoef(a[:-1], a[1:])[0, 1]) < 0.02


def test_numbers_out_of_range_are_refused():
    with pytest.raises(ValueError):
        Feistel(10).permute([10])


def test_assignment_is_gapless_even_and_computable(spark, tmp_path):
    rows = edge_rows() + [(i + 100, f"text {i}") for i in range(500)]
    shards = 40
    found = assign(table(spark, tmp_path, rows), shards, seed=3).collect()
    sizes = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == sizes
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    feistel = Feistel(len(rows), seed=3)
    ordered = sorted(found, key=lambda r: r.row)
    assert [r.row for r in ordered] == list(range(len(rows)))
    ids = [-1 if r.doc_id is None else r.doc_id for r in ordered]
    assert ids == sorted(ids)  # rows are numbered by id, null first
    for r in ordered[::37]:
        assert feistel.place(r.row, shards) == (r.shard, r.slot)
        assert feistel.row_at(r.shard, r.slot, shards) == r.row


def test_places_do_not_depend_on_partitions(spark, tmp_path):
    rows = [(i, f"text {i}") for i in range(300)] + [(5, "other"), (5, "third")]
    one = assign(table(spark, tmp_path, rows, name="one", parts=1), 7).collect()
    many = assign(table(spark, tmp_path, rows[::-1], name="many", parts=9), 7).collect()
    assert Counter(map(tuple, one)) == Counter(map(tuple, many))


def test_written_shards_hold_whole_rows_in_slot_order(spark, tmp_path):
    docs = table(spark, tmp_path, [*edge_rows(), *((i + 100, f"text {i}") for i in range(200))])
    path = str(tmp_path / "shards")
    write_shards(docs, path, shards=5, seed=3)
    back = spark.read.parquet(path)
    assert Counter(map(tuple, back.select("doc.*").collect())) == Counter(map(tuple, docs.collect()))
    assert set(EXTRA) <= set(back.select("doc.*").columns)
    places = Counter((r.shard, r.slot, r.doc.doc_id) for r in back.collect())
    assert places == Counter((r.shard, r.slot, r.doc_id) for r in assign(docs, 5, seed=3).collect())
    for file, in back.selectExpr("input_file_name() AS f").distinct().collect():
        slots = [r.slot for r in spark.read.parquet(file).select("slot").collect()]
        assert slots == sorted(slots)


def test_empty_and_single_tables(spark, tmp_path):
    none = table(spark, tmp_path, [], name="none")
    assert assign(none, 4).count() == 0
    write_shards(none, str(tmp_path / "none-shards"), 4)
    one = assign(table(spark, tmp_path, [(None, None)], name="one"), 4).collect()
    assert [(r.doc_id, r["size"], r.text_crc32, r.slot) for r in one] == [(None, 16, 0, 0)]
