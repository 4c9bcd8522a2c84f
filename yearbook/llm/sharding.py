"""Sharding: best-fit-decreasing packing of whole groups into shards of one capacity.

Groups of equal keys stay together. Groups over one ``FINE``-th of a shard are items of
their own; smaller ones ride in bundles of about that size, whole groups that share a hash,
so a shard has some hundred items at least to choose from, and where shards are so small that
there is nothing to bundle, every group is an item. A bundle that came out larger than a shard is
taken apart again. So any set of groups that fit shards is packed. A group over a shard's
capacity fits no shard and is cut into the fewest pieces that do.

Up to ``DRIVER_ITEMS`` items are packed in one place. More are first dealt by hash to
ranges of about ``RANGE_ITEMS`` items, and each range is packed into shards of its own in a task;
what that can cost is one shard not full for each range.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yearbook.llm.tables import attach, written

#: Items of a shard, about: small groups are bundled up to this share of it.
FINE = 512
#: Items that are packed on the driver, and in one task where there are more.
DRIVER_ITEMS, RANGE_ITEMS = 200_000, 50_000


class Capacities:
    """Bins by remaining capacity in a treap, a balanced tree in expectation.

    Priorities come from a fixed mixing of the bin's number, so runs repeat.
    """

    def __init__(self) -> None:
        self.root: list | None = None  # [room, bin, priority, left, right]

    def add(self, room: int, bin_: int) -> None:
        a, b = self._split(self.root, (room, bin_))
        node = [room, bin_, (bin_ * 0x9E3779B97F4A7C15 + room * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF, None, None]
        self.root = self._merge(self._merge(a, node), b)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the tightest ``(room, bin)`` with room for ``size``."""
        a, b = self._split(self.root, (size, -1))
        if b is None:
            self.root = a
            return None
        parent, node = None, b
        while node[3] is not None:
            parent, node = node, node[3]
        if parent is None:
            b = node[4]
        else:
            parent[3] = node[4]
        self.root = self._merge(a, b)
        return node[0], node[1]

    def _split(self, node: list | None, key: tuple[int, int]) -> tuple[list | None, list | None]:
        """The nodes before ``key`` and the others."""
        if node is None:
            return None, None
        if (node[0], node[1]) < key:
            a, b = self._split(node[4], key)
            node[4] = a
            return node, b
        a, b = self._split(node[3], key)
        node[3] = b
        return a, node

    def _merge(self, a: list | None, b: list | None) -> list | None:
        if a is None or b is None:
            return b if a is None else a
        if a[2] < b[2]:
            a[4] = self._merge(a[4], b)
            return a
        b[3] = self._merge(a, b[3])
        return b


def best_fit_decreasing(sizes: Sequence[int], capacity: int, most: int | None = None) -> tuple[list[int], int]:
    """The bin of each item, and how many bins: items by falling size, each into the bin
    with the least room that takes it, or a new one. An item over the capacity is an
    error. It stops where it would open more than ``most`` bins."""
    bins, rooms, count = [0] * len(sizes), Capacities(), 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        if sizes[i] > capacity:
            raise ValueError("an item is larger than a shard")
        found = rooms.take(sizes[i])
        if found is None and count == most:
            return bins, count + 1
        if found is None:
            found, count = (capacity, count), count + 1
        bins[i] = found[1]
        rooms.add(found[0] - sizes[i], found[1])
    return bins, count


def fewest_bytes(sizes: Sequence[int], shards: int) -> list[int]:
    """The bins at the least capacity, found by halving, for which best-fit-decreasing
    needs no more than ``shards`` of them."""
    low = max([-(-sum(sizes) // shards), *sizes, 1])
    best, high = None, low
    while best is None:
        bins, count = best_fit_decreasing(sizes, high, shards)
        best, low, high = (bins, low, high) if count <= shards else (None, high + 1, high + max(1, high // 1000))
        if best is None and high > 2 * (sum(sizes) + 1):
            raise AssertionError("one bin holds all")
    while low < high:
        middle = (low + high) // 2
        bins, count = best_fit_decreasing(sizes, middle, shards)
        if count <= shards:
            best, high = bins, middle
        else:
            low = middle + 1
    return best


def shard(docs: DataFrame, shards: int | None = 16, capacity: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, size, text_crc32, shard, slot)`` for every row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 1; rows of equal text are one group. Give
    ``shards`` for that many shards of near equal bytes, or ``capacity`` for the fewest
    shards of that many bytes. ``slot`` numbers a shard's rows from 0 without gaps.

    Null and empty texts have size 1 and are one group; repeated rows each have a slot; an
    empty table gives no rows; other columns are not read. With ``capacity``, a row over it
    fits no shard and is an error. Texts are read once and never
    shuffled: the groups are counted by a digest, with partial sums, so a group of any
    number of rows is no burden to one task.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give shards or capacity")
    text = F.coalesce(F.col(text_col), F.lit(""))
    measured = docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"),
        F.unhex(F.md5(text)).alias("digest"), F.monotonically_increasing_id().alias("row"),
    )
    rows, _ = written(measured, "shard-rows")
    total = rows.agg(F.sum("size").alias("total")).first()["total"] or 0
    room = capacity or max(1, -(-total // shards))
    items_of = _items(rows, total, room)
    sizes, _ = written(items_of.groupBy("item").agg(F.sum("size").alias("size")), "shard-sizes")
    if sizes.count() <= DRIVER_ITEMS:
        found = sizes.orderBy("item").toPandas()
        each = [int(x) for x in found["size"]]
        bins = fewest_bytes(each, shards) if shards else best_fit_decreasing(each, capacity)[0]
        places = rows.sparkSession.createDataFrame(list(zip(found["item"].tolist(), bins, strict=True)), "item string, shard int")
        placed = items_of.join(F.broadcast(places), "item")
    else:
        placed = attach(items_of, _by_ranges(sizes, total, shards, capacity), ["item"], ["row"])
    return _numbered(placed.select("id", "size", "text_crc32", "row", "shard"), "shard").select(F.col("id").alias(id_col), "size", "text_crc32", "shard", "slot")


def _items(rows: DataFrame, total: int, room: int) -> DataFrame:
    """Stored ``(id, size, text_crc32, row, item)``: which item each row belongs to."""
    fine = room // FINE
    bundles = max(1, total // max(1, fine))
    groups, _ = written(rows.groupBy("digest", "size").agg(F.count("*").alias("n")).withColumn("whole", F.col("n") * F.col("size")), "shard-groups")
    own = F.concat(F.lit("g"), F.hex("digest"), F.lit("-"), F.col("size").cast("string"))
    bundle = F.pmod(F.xxhash64("digest"), F.lit(bundles))
    small = groups.where(F.col("whole") <= fine).withColumn("bundle", bundle)
    # hardly ever: groups of a bundle that is larger than a shard are items of their own
    heavy = small.groupBy("bundle").agg(F.sum("whole").alias("bundled")).where(F.col("bundled") > room).select("bundle", F.lit(True).alias("heavy"))
    rides = small.join(heavy, "bundle", "left").withColumn("item", F.when(F.col("heavy"), own).otherwise(F.concat(F.lit("b"), F.col("bundle").cast("string"))))
    alone = groups.where(F.col("whole") > fine).withColumn("item", own)
    named = rides.select("digest", "size", "item", F.lit(False).alias("over")).unionByName(alone.select("digest", "size", "item", (F.col("whole") > room).alias("over")))
    known = attach(rows, named, ["digest", "size"], ["row"])
    columns = ["id", "size", "text_crc32", "row", "item"]
    # a group that no shard can hold: its rows are numbered, so many rows make a piece
    cut = _numbered(known.where("over"), "digest").withColumn("piece", F.floor(F.col("slot") / F.greatest(F.lit(1), F.floor(F.lit(room) / F.col("size")))))
    cut = cut.withColumn("item", F.concat_ws("-", "item", F.col("piece").cast("string")))
    return written(known.where("not over").select(*columns).unionByName(cut.select(*columns)), "shard-items")[0]


def _by_ranges(sizes: DataFrame, total: int, shards: int | None, capacity: int | None) -> DataFrame:
    """Stored ``(item, shard)``: items dealt to ranges by hash, each range packed by a task into
    shards of its own. Given ``shards``, a range gets its part of them."""
    ranges = -(-sizes.count() // RANGE_ITEMS)
    if shards:
        ranges = min(ranges, shards)

    def packed(items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values("item")
        each = [int(x) for x in items["size"]]
        r = int(items["range"].iloc[0])
        own = (r + 1) * shards // ranges - r * shards // ranges if shards else None
        bins = fewest_bytes(each, own) if shards else best_fit_decreasing(each, capacity)[0]
        return pd.DataFrame({"item": items["item"], "range": items["range"], "bin": bins})

    dealt = sizes.withColumn("range", F.pmod(F.xxhash64("item"), F.lit(ranges)).cast("int"))
    found, _ = written(dealt.groupBy("range").applyInPandas(packed, "item string, range int, bin int"), "shard-bins")
    if shards:
        first = F.floor(F.col("range") * F.lit(shards) / F.lit(ranges))
        return found.select("item", (first + F.col("bin")).cast("int").alias("shard"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    used = found.groupBy("range").agg((F.max("bin") + 1).alias("used")).select("range", F.coalesce(F.sum("used").over(before), F.lit(0)).alias("first"))
    return found.join(F.broadcast(used), "range").select("item", (F.col("first") + F.col("bin")).cast("int").alias("shard"))


def _numbered(rows: DataFrame, by: str) -> DataFrame:
    """``rows`` with ``slot``: their number in order of ``row`` among those of equal
    ``by``. Rows are numbered in runs (stretches of 2 ** 16 of a partition), and the runs
    are added up before, so no task holds all rows of a value."""
    run = F.shiftright("row", 16)
    counts = rows.groupBy(by, run.alias("run")).agg(F.count("*").alias("in_run"))
    before = Window.partitionBy(by).orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(by, "run", F.coalesce(F.sum("in_run").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy(by, "run").orderBy("row")
    own = rows.withColumn("run", run).withColumn("nth", F.row_number().over(inside) - 1)
    return own.join(bases, [by, "run"]).withColumn("slot", F.col("base") + F.col("nth"))
