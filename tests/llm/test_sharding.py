"""Shards: whole groups, near equal bytes, slots without gaps."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pytest
from tests.llm.cases import documents, empty, rows

from yearbook.llm import sharding
from yearbook.llm.sharding import best_fit_decreasing, fewest_bytes, shard


def plain_best_fit(sizes, capacity):
    bins, rooms = [0] * len(sizes), []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fit = [(room, b) for b, room in enumerate(rooms) if room >= sizes[i]]
        b = min(fit)[1] if fit else len(rooms)
        if not fit:
            rooms.append(capacity)
        rooms[b] -= sizes[i]
        bins[i] = b
    return bins, len(rooms)


@pytest.mark.parametrize("seed", range(20))
def test_tree_gives_the_plain_result(seed):
    r = random.Random(seed)
    sizes = [r.randint(1, 60) for _ in range(r.randint(0, 300))]
    assert best_fit_decreasing(sizes, 100) == plain_best_fit(sizes, 100)
    bins = fewest_bytes(sizes, 7)
    assert not sizes or max(bins) < 7


def test_item_over_capacity():
    with pytest.raises(ValueError):
        best_fit_decreasing([5, 11], 10)


def check(got, want, shards=None):
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in want
    )
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shards is None or max(slots) < shards


def test_shards_of_equal_texts(spark):
    got = shard(documents(spark).repartition(3), shards=4).collect()
    check(got, [r[:2] for r in rows()], 4)
    assert shard(empty(spark), shards=4).collect() == []


def test_groups_stay_whole_and_sizes_near(spark):
    texts = [f"text {i} " * (1 + i % 9) for i in range(4000)] + ["copy"] * 50 + ["bulk " * 30] * 3000
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    got = shard(frame, shards=6).collect()
    check(got, list(enumerate(texts)), 6)
    size, where = defaultdict(int), defaultdict(set)
    for r in got:
        size[r.shard] += r.size
        where[texts[r.doc_id]].add(r.shard)
    assert max(size.values()) <= 1.01 * sum(size.values()) / 6
    assert all(len(s) == 1 for t, s in where.items() if not t.startswith("bulk"))  # bulk is over a shard
    few = shard(frame, shards=None, capacity=50_000).collect()
    check(few, list(enumerate(texts)))
    assert len({r.shard for r in few}) <= sum(size.values()) / 50_000 * 1.05 + 1
    with pytest.raises(ValueError):  # a row of 45 bytes
        shard(frame, shards=None, capacity=20).collect()


def test_small_shards_are_packed_group_by_group(spark):
    texts = [f"{i:05} " * r for i, r in enumerate(random.Random(3).choices([13, 15, 16, 17, 18], k=20_000))]  # 79 to 109 bytes
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    for capacity in (150, 1200):
        got = shard(frame, shards=None, capacity=capacity).collect()
        check(got, list(enumerate(texts)))
        size = defaultdict(int)
        for r in got:
            size[r.shard] += r.size
        assert max(size.values()) <= capacity and sorted(size) == list(range(len(size)))
        assert len(size) == best_fit_decreasing([len(t) + 1 for t in texts], capacity)[1]


@pytest.mark.parametrize("most", [{"shards": 40}, {"shards": None, "capacity": 3000}])
def test_ranges_of_shards(spark, monkeypatch, most):
    monkeypatch.setattr(sharding, "DRIVER_ITEMS", 100)
    monkeypatch.setattr(sharding, "RANGE_ITEMS", 500)
    texts = [f"text {i} " * (1 + i % 9) for i in range(3000)] + ["copy me"] * 600
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    got = shard(frame, **most).collect()
    check(got, list(enumerate(texts)), most["shards"])
    size, where = defaultdict(int), defaultdict(set)
    for r in got:
        size[r.shard] += r.size
        where[texts[r.doc_id]].add(r.shard)
    total = sum(size.values())
    if most["shards"]:
        assert len(size) == 40 and max(size.values()) < 1.3 * total / 40
    else:
        assert max(size.values()) <= 3000 and len(size) <= total / 3000 * 1.05 + 8
    assert all(len(s) == 1 for t, s in where.items() if t != "copy me")
