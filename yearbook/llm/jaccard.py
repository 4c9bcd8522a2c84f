"""N-gram Jaccard join: exact links between shingle sets through signature trees.

1. Every document becomes a set of shingle hashes, and the set a 64-bit id; equal sets
   are one from here on, so copies cost nothing more.
2. In one global order of shingles (frequent ones last), two linked sets share a shingle
   among their first ``n - ceil(0.8 n) + 1``. Sets that share such a shingle are put into
   the block of the smallest set id that has it; no pairs are made. Only shingles that two
   sets share leave a task.
3. Blocks are sifted by small bitmaps, a bit or two for each shingle: sets whose bits and
   sizes allow a link with another of the block stay, in a block of those they may reach.
   Sets that only share a passage go here, before any whole set is moved.
4. A block's sets form a signature tree: its nodes hold OR-combined bitmaps and size
   ranges, and two nodes are compared further only if their common bits and sizes allow
   the overlap, and if they are not all linked already. What remains is counted exactly.
   Large blocks are cut by size into chunks that share the block's first set. Sets that are
   not linked with it there are guests: chunks of guests meet the chunks of the block whose
   sizes allow a link, each pair of chunks in a group of its own.
5. The links, a star for each linked group of a block, are contracted to components.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yearbook.llm.columns import mixed, passes, shingle_sets, text_bytes, texts_of
from yearbook.llm.tables import attach, bit_filter, drop, passes_filter, release, written

SHINGLE = 5
PERCENT = 80
#: Sets of one chunk of a block, and their shingles, about.
CHUNK_SETS, CHUNK_SHINGLES = 2000, 2_000_000
#: Sizes of one band of a block differ by less than this factor.
BAND = 1.02
#: A shingle in more than this share of a sample of sets (one in ``SAMPLE``) is frequent. That is
#: less than ``SIFT_SETS`` up to a hundred million sets, so a passage alone makes no such block.
#: Which are known as frequent decides the work, never the result.
FREQUENT, SAMPLE, MOST_FREQUENT = 0.00003, 8, 50_000
#: Larger blocks are not sifted but go to the trees as they are.
SIFT_SETS = 4000
#: Shingles of sampled sets, and prefix shingles, that a task holds before it passes them on.
HELD_SAMPLE, HELD_PREFIX = 1 << 20, 1 << 18
#: Frequent shingles are dealt to so many tasks each.
SALTS = 64
#: Prefix shingles in one bucket, about.
BUCKET_ROWS = 1_000_000

_U = np.uint64


def set_id(shingles: np.ndarray) -> int:
    """A signed 64-bit id; 0 shingles have id 0 and stand alone."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63) if len(shingles) else 0


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether 100 * intersection >= PERCENT * union."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < PERCENT * len(large):
        return False
    place = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[place] == small).sum())
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def prefix(shingles: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The shingles of a set of which any linked set has one among its own."""
    n = len(shingles)
    size = n - -(-PERCENT * n // 100) + 1
    if len(frequent):
        place = np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)
        common = frequent[place] == shingles
        if common.any():
            last = np.flatnonzero(common)
            last = last[np.argsort(rank[place[last]], kind="stable")]
            return np.concatenate([shingles[~common], shingles[last]])[:size]
    return shingles[:size]


def bitmap(shingles: np.ndarray) -> bytes:
    """A power of two of bits, as many as shingles or more."""
    width = 1 << max(6, int(len(shingles) - 1).bit_length())
    bits = np.zeros(width // 64, _U)
    place = mixed(shingles) & _U(width - 1)
    np.bitwise_or.at(bits, (place >> _U(6)).astype(np.int64), _U(1) << (place & _U(63)))
    return bits.tobytes()


def reachable(sizes: np.ndarray, maps: list[np.ndarray]) -> np.ndarray:
    """Labels of sets, in ascending order of size: those that chains of possible links
    connect have the same. A set whose bits another lacks lacks as many of its shingles."""
    label = np.arange(len(sizes))
    widths = np.array([len(m) for m in maps])
    stacked = {w: np.stack([m for m in maps if len(m) == w]) for w in np.unique(widths)}
    within = np.zeros(len(sizes), np.int64)
    for w in stacked:
        within[widths == w] = np.arange((widths == w).sum())
    reach = np.searchsorted(100 * sizes, 10000 * sizes // PERCENT, "right")
    for i in range(len(sizes)):
        near = np.arange(i + 1, reach[i])
        near = near[label[near] != label[i]]
        for w in np.unique(widths[near]):
            some = near[widths[near] == w]
            other, own = stacked[w][within[some]], maps[i]
            while other.shape[1] > len(own):  # half as wide: a bit stands for two
                half = other.shape[1] // 2
                other = other[:, :half] | other[:, half:]
            both = np.bitwise_count(other & own).sum(axis=1)
            most = np.minimum(sizes[i] - (np.bitwise_count(own).sum() - both), sizes[some] - (np.bitwise_count(other).sum(axis=1) - both))
            for j in some[(100 + PERCENT) * most >= PERCENT * (sizes[i] + sizes[some])]:
                if label[j] != label[i]:
                    label[label == label[j]] = label[i]
    return label


class SignatureTree:
    """Some sets, in an order that brings similar ones together, and nodes over them.

    A leaf holds ``LEAF`` sets, a node ``FAN`` nodes of the level below. Each has the OR of
    its sets' bitmaps and the range of their sizes.
    """

    FAN, LEAF = 8, 64
    #: Bits for each shingle of a set, and bytes of all bitmaps of one tree: wide bitmaps tell
    #: sets that are nearly similar enough from those that are.
    SPREAD, MAP_BYTES = 32, 48 << 20

    def __init__(self, sets: list[np.ndarray], first: int):
        """``first`` is the set that the others are compared with before all else."""
        self.order = sorted(range(len(sets)), key=lambda i: (i != first, sets[i][:1].tolist(), len(sets[i])))
        self.sets = [sets[i] for i in self.order]
        self.sizes = np.array([len(s) for s in self.sets])
        most = max(256, 8 * self.MAP_BYTES // len(sets))
        self.width = 1 << int(min(np.ceil(np.log2(max(256, self.SPREAD * np.median(self.sizes)))), np.floor(np.log2(most))))
        self.bits = np.zeros((len(sets), self.width // 64), np.uint64)
        for row, s in zip(self.bits, self.sets, strict=True):
            place = mixed(s) & _U(self.width - 1)
            np.bitwise_or.at(row, (place >> _U(6)).astype(np.int64), _U(1) << (place & _U(63)))
        # shingles of a set that share a bit with another of its own
        self.excess = self.sizes - np.bitwise_count(self.bits).sum(axis=1)
        self.levels = [self._above((self.bits, self.sizes, self.sizes, self.excess), self.LEAF)]
        while len(self.levels[-1][1]) > 1:
            self.levels.append(self._above(self.levels[-1], self.FAN))
        self.label = np.arange(len(sets))

    @staticmethod
    def _above(level: tuple, fan: int) -> tuple:
        bits, low, high, excess = level
        at = np.arange(0, len(low), fan)
        return np.bitwise_or.reduceat(bits, at, axis=0), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(excess, at)

    def _span(self, level: int, i: int) -> slice:
        size = self.LEAF * self.FAN**level
        return slice(i * size, (i + 1) * size)

    @staticmethod
    def _possible(level: tuple, one: tuple, others: np.ndarray) -> np.ndarray:
        """Which of ``others``, of one level, may hold a set linked with one of ``one``."""
        bits, low, high, excess = level
        own, least, most, off = one
        sizes = (100 * high[others] >= PERCENT * least) & (100 * most >= PERCENT * low[others])
        near = others[sizes]
        at_most = np.bitwise_count(bits[near] & own).sum(axis=1) + np.minimum(excess[near], off)
        needed = PERCENT * (low[near] + least)  # (100 + PERCENT) * overlap >= PERCENT * (sum of sizes)
        sizes[sizes] = (100 + PERCENT) * at_most >= needed
        return sizes

    def _join(self, i: int, j: int) -> None:
        self.label[self.label == self.label[j]] = self.label[i]

    def _linked(self, i: int, others: np.ndarray) -> np.ndarray:
        """Which of ``others`` set i is linked with, exactly."""
        if len(others) <= 4:
            return np.array([linked(self.sets[i], self.sets[j]) for j in others], bool)
        own, sizes = self.sets[i], self.sizes[others]
        flat = np.concatenate([self.sets[j] for j in others])
        hit = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
        both = np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes) - sizes)
        return 100 * both >= PERCENT * (sizes + len(own) - both)

    def _compare(self, a: slice, b: slice, wanted: np.ndarray) -> None:
        """Join what is linked between two leaves."""
        level = (self.bits, self.sizes, self.sizes, self.excess)
        for i in range(*a.indices(len(self.sets))):
            others = np.arange(*b.indices(len(self.sets)))
            others = others[(others > i) | (a != b)]
            others = others[(self.label[others] != self.label[i]) & (wanted[others] | wanted[i])]
            others = others[self._possible(level, (self.bits[i], self.sizes[i], self.sizes[i], self.excess[i]), others)]
            while len(others):  # one link joins all that the other is joined with
                some, others = others[:16], others[16:]
                for j in some[self._linked(i, some)]:
                    if self.label[j] != self.label[i]:
                        self._join(i, j)
                others = others[self.label[others] != self.label[i]]

    def connect(self, wanted: np.ndarray | None = None) -> np.ndarray:
        """Labels: sets that links connect have the same. ``wanted``: only links of which
        one end at least is among these are looked for."""
        rest = np.arange(1, len(self.sets))
        for j in rest[self._linked(0, rest)] if len(rest) else ():
            self._join(0, j)
        wanted = np.ones(len(self.sets), bool) if wanted is None else wanted[self.order]
        stack = [(len(self.levels) - 1, 0, 0)]
        while stack:
            level, i, j = stack.pop()
            a, b = self._span(level, i), self._span(level, j)
            one = self.label[a][0]
            if not (wanted[a].any() or wanted[b].any()) or (self.label[a] == one).all() and (self.label[b] == one).all():
                continue
            if level == 0:
                self._compare(a, b, wanted)
                continue
            below = self.levels[level - 1]
            size = len(below[1])
            left = np.arange(i * self.FAN, min((i + 1) * self.FAN, size))
            right = np.arange(j * self.FAN, min((j + 1) * self.FAN, size))
            for x in left:
                others = right[right >= x] if i == j else right
                for y in others[self._possible(below, tuple(part[x] for part in below), others)]:
                    stack.append((level - 1, int(x), int(y)))
        return self.label

    def __len__(self) -> int:
        return len(self.sets)


def shingle_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, n, set_id, bits, shingle, seen)``: a row for each document, and for each
    shingle that a task has seen ``seen`` times in its sample of distinct sets, twice at
    least. ``bits`` stands with the first document of a set in a pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample, held, known, seen_now, kind = [], 0, set(), set(), None

        def sampled() -> pa.RecordBatch:
            shingles, seen = np.unique(np.concatenate(sample), return_counts=True)
            often = seen > 1
            nulls = [pa.nulls(int(often.sum()), t) for t in (kind, pa.int64(), pa.int64(), pa.binary())]
            return pa.RecordBatch.from_arrays([*nulls, pa.array(shingles[often].view(np.int64)), pa.array(seen[often])], names=_ROW)

        for batch in passes(batches, 1):
            sizes, ids, bits = [], [], []
            for s in shingle_sets(texts_of(batch, 1), SHINGLE):
                own = set_id(s)
                sizes.append(len(s))
                bits.append(bitmap(s) if len(s) and own not in seen_now else None)
                seen_now.add(own)
                ids.append(own)
                if len(s) and own % SAMPLE == 0 and own not in known:
                    known.add(own)
                    sample.append(s)
                    held += len(s)
            kind, none = batch.column(0).type, pa.nulls(len(ids), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), pa.array(bits, pa.binary()), none, none], names=_ROW)
            if held > HELD_SAMPLE:
                yield sampled()
                sample, held = [], 0
        if sample:
            yield sampled()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n bigint, set_id bigint, bits binary, shingle bigint, seen bigint")


_ROW = ["id", "n", "set_id", "bits", "shingle", "seen"]


def _frequent(rows: DataFrame, sets: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``MOST_FREQUENT`` shingles that many sets hold, sorted, and their ranks by frequency."""
    least = max(16, FREQUENT * sets / SAMPLE)
    counts = rows.where("shingle is not null").groupBy("shingle").agg(F.sum("seen").alias("seen"))
    found = counts.where(F.col("seen") >= least).orderBy(F.desc("seen"), "shingle").limit(MOST_FREQUENT).toPandas()
    shingles = found["shingle"].to_numpy(np.int64).view(_U)
    order = np.argsort(shingles)
    return shingles[order], (len(shingles) - np.arange(len(shingles)))[order]


def _prefix_blobs(docs: DataFrame, text_col: str, frequent: np.ndarray, rank: np.ndarray, buckets: int) -> DataFrame:
    """``(bucket, data)``: prefix shingles with size and set id, dealt by shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        held: list[tuple[np.ndarray, int, int]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            shingles = np.concatenate([s for s, _, _ in held])
            out = np.empty(len(shingles), _PREFIX)
            lengths = [len(s) for s, _, _ in held]
            out["shingle"], out["n"] = shingles, np.repeat([n for _, n, _ in held], lengths)
            out["set"] = np.repeat(np.array([i for _, _, i in held], np.int64), lengths)
            place = shingles
            if len(frequent):
                hot = np.isin(shingles, frequent)
                place = np.where(hot, mixed(shingles + (out["set"].view(_U) % _U(SALTS))), shingles)
            bucket = ((place >> _U(32)) % _U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            out, bucket = out[order], bucket[order]
            at = np.flatnonzero(np.diff(bucket, prepend=-1))
            data = [x.tobytes() for x in np.split(out, at[1:])]
            return pa.RecordBatch.from_arrays([pa.array(bucket[at]), pa.array(data, pa.binary())], names=["bucket", "data"])

        for batch in passes(batches, 0):
            for s in shingle_sets(texts_of(batch, 0), SHINGLE):
                own = set_id(s)
                if len(s) and own not in known:
                    known.add(own)
                    held.append((prefix(s, frequent, rank), len(s), own))
                    size += len(held[-1][0])
            if size > HELD_PREFIX:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket bigint, data binary")


_PREFIX = np.dtype([("shingle", "<u8"), ("set", "<i8"), ("n", "<u4")])


def _memberships(blobs: DataFrame, buckets: int, frequent: np.ndarray) -> DataFrame:
    """``(hub, member, shingle)``: sets that share a prefix shingle with another of a size
    that allows a link, in the block of the smallest id. ``shingle`` is set for frequent
    ones, whose hub is only one task's."""

    def runs(rows: np.ndarray) -> pa.RecordBatch | None:
        rows = np.unique(rows)  # by shingle, set; copies of a set are one
        rows = rows[np.lexsort((rows["n"], rows["shingle"]))]
        hot = np.isin(rows["shingle"], frequent) if len(frequent) else np.zeros(len(rows), bool)
        new = np.ones(len(rows), bool)
        near = (rows["shingle"][1:] == rows["shingle"][:-1]) & (hot[1:] | (100 * rows["n"][:-1].astype(np.int64) >= PERCENT * rows["n"][1:].astype(np.int64)))
        new[1:] = ~near
        run = np.cumsum(new) - 1
        count = np.bincount(run, minlength=1) if len(run) else np.zeros(1, np.int64)
        hubs = np.minimum.reduceat(rows["set"], np.flatnonzero(new)) if len(rows) else np.zeros(0, np.int64)
        kept = (count[run] > 1) | hot
        out = np.empty(int(kept.sum()), [("hub", "<i8"), ("member", "<i8"), ("shingle", "<u8")])
        out["hub"], out["member"] = hubs[run[kept]], rows["set"][kept]
        out["shingle"] = np.where(hot[kept], rows["shingle"][kept], 0)
        out = np.unique(out)
        if not len(out):
            return None
        shingle = pa.array(out["shingle"].view(np.int64), mask=out["shingle"] == 0)
        return pa.RecordBatch.from_arrays([pa.array(out["hub"]), pa.array(out["member"]), shingle], names=["hub", "member", "shingle"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _by_key(batches, 1):
            found = runs(np.concatenate([np.frombuffer(x, _PREFIX) for p in parts for x in p.column(1).to_pylist()]))
            if found is not None:
                yield found

    dealt = blobs.repartition(min(buckets, 4000), "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "hub bigint, member bigint, shingle bigint")


def _sifted(members: DataFrame, rows: DataFrame) -> DataFrame:
    """``(hub, member, n)``: blocks of the sets that may be linked with another of theirs.
    Blocks over ``SIFT_SETS`` are known by their counts and never gathered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _by_key(batches, 1):
            ids = np.concatenate([p.column(1).to_numpy() for p in parts])
            sizes = np.concatenate([p.column(2).to_numpy() for p in parts])
            ids, at = np.unique(ids, return_index=True)
            sizes = sizes[at]
            if len(ids) < 2:
                continue
            maps = [x for p in parts for x in p.column(3).to_pylist()]
            order = np.argsort(sizes, kind="stable")
            label = np.empty(len(ids), np.int64)
            label[order] = reachable(sizes[order], [np.frombuffer(maps[at[i]], _U) for i in order])
            _, label, count = np.unique(label, return_inverse=True, return_counts=True)
            hubs = np.full(len(count), np.iinfo(np.int64).max)
            np.minimum.at(hubs, label, ids)
            kept = count[label] > 1
            yield pa.RecordBatch.from_arrays([pa.array(hubs[label[kept]]), pa.array(ids[kept]), pa.array(sizes[kept])], names=["hub", "member", "n"])

    counts = members.groupBy("hub").agg(F.count("*").alias("sets"))
    large = counts.where(F.col("sets") > SIFT_SETS).select("hub")
    maps = rows.where("bits is not null").select(F.col("set_id").alias("member"), "n", "bits").dropDuplicates(["member"])
    few = members.join(large, "hub", "left_anti").join(maps, "member")
    dealt = few.select("hub", "member", "n", "bits").repartition("hub").sortWithinPartitions("hub")
    sifted = dealt.mapInArrow(run, "hub bigint, member bigint, n bigint")
    whole = members.join(large, "hub", "left_semi").join(maps.select("member", "n"), "member")
    return sifted.unionByName(whole.select("hub", "member", "n")).distinct()


def _by_key(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[pa.RecordBatch]]:
    """Slices of sorted batches whose first ``keys`` columns are equal."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change).tolist()] if batch.num_rows else []
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield held
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield held


def _packed(docs: DataFrame, text_col: str, wanted: np.ndarray) -> DataFrame:
    """``(member, bytes, text)`` of the sets that the filter lets through, once a task: a
    compressed text of each. That is a third of its shingles, which are made of it again
    where sets are compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        codec = pa.Codec("zstd", 1)
        for batch in passes(batches, 0):
            texts = texts_of(batch, 0)
            data, starts = text_bytes(texts)
            ids, sizes, packed = [], [], []
            for k, s in enumerate(shingle_sets(texts, SHINGLE)):
                own = set_id(s)
                if len(s) and own not in known and passes_filter(wanted, np.array([own]).view(_U))[0]:
                    known.add(own)
                    ids.append(own)
                    sizes.append(int(starts[k + 1] - starts[k]))
                    packed.append(codec.compress(data[starts[k] : starts[k + 1]].tobytes(), asbytes=True))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())], names=["member", "bytes", "text"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "member bigint, bytes bigint, text binary")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with the shingles of their texts: (hub, chunk, other, member, shingles, guest)."""
    codec = pa.Codec("zstd")
    for batch in passes(batches, _GROUP_ROW.index("bytes")):
        *keys, sizes, packed, guest = batch.columns
        texts = [codec.decompress(x, n, asbytes=True) for x, n in zip(packed.to_pylist(), sizes.to_pylist(), strict=True)]
        sets = shingle_sets(pa.array(texts, pa.large_binary()).view(pa.large_string()), SHINGLE)
        shingles = pa.array([s.tobytes() for s in sets], pa.large_binary())
        yield pa.RecordBatch.from_arrays([*keys, shingles, guest], names=[*_GROUP, "member", "shingles", "guest"])


def _connect(batches: Iterator[pa.RecordBatch], rest: bool) -> Iterator[pa.RecordBatch]:
    """Stars of links in each (hub, chunk, other chunk), and the members not linked with the hub.

    ``rest``: links are looked for of which one end at least is a guest.
    """
    for parts in _by_key(_unpacked(batches), 3):
        ids = np.concatenate([p.column(3).to_numpy() for p in parts])
        sets = [np.frombuffer(x, _U) for p in parts for x in p.column(4).to_pylist()]
        guest = np.concatenate([p.column(5).to_numpy(zero_copy_only=False) for p in parts])
        at = np.lexsort((~guest, ids))  # a set that is both is a guest
        at = at[np.diff(ids[at], prepend=ids[at[0]] - 1) != 0]
        ids, sets, guest, hub = ids[at], [sets[i] for i in at], guest[at], parts[0].column(0)[0].as_py()
        if len(ids) < 2:
            continue
        tree = SignatureTree(sets, int(np.flatnonzero(ids == hub)[0]) if not rest else 0)
        label = tree.connect(guest if rest else None)
        ordered = ids[tree.order]
        least = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(least, label, ordered)
        star = least[label] != ordered
        a, b, left = least[label][star], ordered[star], np.zeros(int(star.sum()), bool)
        if not rest:  # the hub is the first of the order
            alone = ordered[label != label[0]]
            a, b = np.concatenate([a, np.full(len(alone), hub)]), np.concatenate([b, alone])
            left = np.concatenate([left, np.ones(len(alone), bool)])
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(left)], names=["a", "b", "left"])


def _chunked(members: DataFrame) -> DataFrame:
    """``(hub, member, n, chunk)`` of ``members (hub, member, n)``.

    Chunks go by size. A block's sets fall into bands of nearly equal size, which are
    counted; consecutive small bands share a chunk, and a large band is dealt to several. A
    block has at most some hundred bands, whatever the number of its sets.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(BAND))).cast("int")
    banded = members.withColumn("band", band)
    bands = banded.groupBy("hub", "band").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    weight = F.greatest(F.col("sets") / CHUNK_SETS, F.col("shingles") / CHUNK_SHINGLES)
    before = Window.partitionBy("hub").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = bands.withColumn("parts", F.ceil(weight).cast("int")).withColumn("at", F.floor(F.coalesce(F.sum(weight).over(before), F.lit(0.0))))
    bands = bands.select("hub", "band", "parts", F.when(F.col("parts") > 1, -1 - F.col("band")).otherwise(F.col("at")).cast("bigint").alias("at"))
    dealt = attach(banded, bands, ["hub", "band"], ["member"])
    part = F.pmod(F.xxhash64("member"), F.col("parts"))
    return dealt.select("hub", "member", "n", (F.col("at") * (1 << 24) + part).alias("chunk"))


_GROUP = ["hub", "chunk", "other"]
_GROUP_ROW = [*_GROUP, "member", "bytes", "text", "guest"]


def _compared(placed: DataFrame, packed: DataFrame, rest: bool) -> DataFrame:
    rows = placed.join(packed.dropDuplicates(["member"]), "member").select(*_GROUP_ROW)
    dealt = rows.repartition(*_GROUP).sortWithinPartitions(*_GROUP)
    return dealt.mapInArrow(functools.partial(_connect, rest=rest), "a bigint, b bigint, left boolean")


def _among(packed: DataFrame, members: DataFrame) -> DataFrame:
    """Rows of ``packed`` that a bounded filter takes for ``members``, found without a shuffle."""
    wanted = bit_filter(members, "member")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passes_filter(wanted, batch.column(0).to_numpy().view(_U))))

    return packed.mapInArrow(run, packed.schema)


def links(docs: DataFrame, text_col: str = "text", rows: DataFrame | None = None) -> DataFrame:
    """Stored ``(a, b)``: links between set ids that connect exactly what all links do.

    Tables and shuffle files go as soon as nothing reads them: if all texts have near
    copies, the largest step alone takes most of the disk there is.
    """
    spark = docs.sparkSession

    def done(*paths: str) -> None:
        for path in paths:
            drop(spark, path)
        release(spark)

    if rows is None:
        rows, _ = written(shingle_rows(docs, text_col, text_col), "jaccard-rows")
    totals = rows.where("set_id is not null").agg(F.count("*").alias("sets"), F.sum(F.col("n") * (100 - PERCENT) / 100 + 1).alias("prefix")).first()
    frequent, rank = _frequent(rows, totals["sets"])
    buckets = max(256, int((totals["prefix"] or 0) // BUCKET_ROWS))
    found, found_path = written(_memberships(_prefix_blobs(docs, text_col, frequent, rank, buckets), buckets, frequent), "jaccard-found")
    done()
    hot = found.where("shingle is not null")
    # at most MOST_FREQUENT rows; a shingle that one set alone has makes no block
    tops = hot.groupBy("shingle").agg(F.min("hub").alias("top"), F.max("member").alias("last")).where("top != last").select("shingle", "top")
    members = found.where("shingle is null").select("hub", "member").unionByName(hot.join(F.broadcast(tops), "shingle").select(F.col("top").alias("hub"), "member"))
    members, members_path = written(members.distinct(), "jaccard-members")
    done(found_path)
    blocks, blocks_path = written(_sifted(members, rows), "jaccard-blocks")
    done(members_path)
    chunked, chunked_path = written(_chunked(blocks), "jaccard-chunks")
    ranges, ranges_path = written(chunked.groupBy("hub", "chunk").agg(F.count("*").alias("sets"), F.min("n").alias("low"), F.max("n").alias("high")), "jaccard-ranges")
    packed, packed_path = written(_packed(docs, text_col, bit_filter(blocks.select("member"), "member")), "jaccard-packed", "none")
    done()
    # every chunk with its block's first set, which may be in another chunk
    first_too = ranges.select("hub", "chunk", F.col("hub").alias("member"))
    placed = chunked.select("hub", "chunk", "member").unionByName(first_too).distinct().withColumn("other", F.col("chunk")).withColumn("guest", F.lit(False))
    first, first_path = written(_compared(placed, packed, False), "jaccard-first")
    done()
    # sets of a cut block that are not linked with its first set meet the other chunks
    cut = ranges.groupBy("hub").agg(F.count("*").alias("chunks")).where("chunks > 1").select("hub")
    left = first.where("left").select(F.col("a").alias("hub"), F.col("b").alias("member")).distinct().join(cut, "hub", "left_semi")
    guests, guests_path = written(_chunked(left.join(blocks, ["hub", "member"])), "jaccard-guests")
    guest_ranges = guests.groupBy("hub", "chunk").agg(F.min("n").alias("guest_low"), F.max("n").alias("guest_high"))
    fit = (100 * F.col("guest_high") >= PERCENT * F.col("low")) & (100 * F.col("high") >= PERCENT * F.col("guest_low"))
    pairs, pairs_path = written(guest_ranges.join(ranges.select("hub", F.col("chunk").alias("other"), "low", "high"), "hub").where(fit).select(*_GROUP), "jaccard-pairs")
    star = first.where("not left").select("a", "b")
    if not pairs.isEmpty():
        met = guests.select("hub", "chunk", "member").join(pairs, ["hub", "chunk"]).select(*_GROUP, "member", F.lit(True).alias("guest"))
        hosts = chunked.select("hub", F.col("chunk").alias("other"), "member").join(pairs, ["hub", "other"]).select(*_GROUP, "member", F.lit(False).alias("guest"))
        placed = met.unionByName(hosts)
        star = star.unionByName(_compared(placed, _among(packed, placed.select("member")), True).select("a", "b"))
    out, _ = written(star.distinct(), "jaccard-links")
    done(blocks_path, packed_path, chunked_path, ranges_path, first_path, guests_path, pairs_path)
    return out


def components(edges: DataFrame) -> DataFrame:
    """Stored ``(node, label)`` for every node of ``edges (a, b)``: the smallest node that
    edges reach. Each round passes the smallest label along edges and then follows labels
    of labels; every round's table is written, so nothing is computed twice."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels, path = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    while True:
        # a star's middle may have most edges, and a label most nodes: both are dealt to several tasks
        near = attach(edges, labels.select(F.col("node").alias("a"), F.col("label").alias("la")), ["a"], ["b"])
        near = near.join(labels.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b")
        low = F.least("la", "lb")
        # both ends, and the labels they had, learn the smaller label
        told = near.where("la != lb").select(F.explode(F.array("a", "b", "la", "lb")).alias("node"), low.alias("new"))
        told = told.groupBy("node").agg(F.min("new").alias("new"))
        moved = labels.join(told, "node", "left").select("node", F.least("label", F.coalesce("new", "label")).alias("label"), F.col("label").alias("was"))
        # every label is a node itself
        jumped = attach(moved, moved.select(F.col("node").alias("label"), F.col("label").alias("higher")), ["label"], ["node"])
        after, after_path = written(jumped.select("node", F.least("label", "higher").alias("label"), "was"), "labels")
        changed = after.where("label != was").limit(1).count()
        drop(edges.sparkSession, path)
        labels, path = after.select("node", "label"), after_path
        if not changed:
            return labels


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_shingles, component_id)`` for every row of ``docs``.

    Two documents link when 100 * intersection >= 80 * union of their sets of distinct
    5-word shingles (A-Z lower-cased; fewer words: all of them as one). ``component_id``
    is the smallest id that links reach, itself included.

    All links are found; no group is capped. Null, empty and blank texts have no shingle
    and link with nothing; equal rows link with each other; rows without an id stand for
    themselves in links, and their component is null only if no row in it has an id; an
    empty table gives no rows; other columns are not read.
    """
    rows, _ = written(shingle_rows(docs, id_col, text_col), "jaccard-rows")
    labels = components(links(docs, text_col, rows))
    own = rows.where("set_id is not null").select("id", "n", "set_id").withColumn("row", F.monotonically_increasing_id())
    sets = own.where("n > 0").groupBy("set_id").agg(F.min("id").alias("lowest"))
    told = _labelled(sets, labels)
    lowest = told.groupBy("label").agg(F.min("lowest").alias("component_id"))
    told = attach(told, lowest, ["label"], ["set_id"]).select("set_id", "component_id")
    found = attach(own.where("n > 0"), told, ["set_id"], ["row"]).select("id", "n", "component_id")
    alone = own.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return found.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def _labelled(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """Stored: ``sets``, one row for each, with their component's ``label``; a set without
    links is its own."""
    found = sets.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left")
    return written(found.withColumn("label", F.coalesce("label", "set_id")), "jaccard-labels")[0]


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, with all columns, less the rows that are linked with a kept one: of each
    component the row of the smallest id stays (rows without an id come last; ties go to
    the smallest hash of the text; of equal rows one stays). Rows without a word stay.

    Decisions are taken on ids and hashes. Of the texts, only rows that a bounded filter
    takes for decided ones are shuffled, to meet the decisions.
    """
    id_, text_ = F.col(id_col), F.col(text_col)
    keyed = docs.select(F.struct(id_.alias("id"), F.xxhash64(text_).alias("h")).alias("key"), text_.alias("text"))
    rows, rows_path = written(shingle_rows(keyed, "key", "text"), "jaccard-rows")
    labels = components(links(keyed, "text", rows))
    counted = rows.where("set_id is not null and n > 0").groupBy("set_id", F.col("id.id").alias("id"), F.col("id.h").alias("h")).agg(F.count("*").alias("rows"))
    counted, counted_path = written(counted, "jaccard-counted")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "h")
    told = _labelled(counted.groupBy("set_id").agg(F.min(rank).alias("best"), F.sum("rows").alias("size")), labels)
    best = told.groupBy("label").agg(F.min("best").alias("best"), F.sum("size").alias("size")).where("size > 1")
    best = attach(told.select("set_id", "label"), best, ["label"], ["set_id"]).select("set_id", "best")
    judged = attach(counted, best, ["set_id"], ["id", "h"]).select("id", "h", rank.eqNullSafe(F.col("best")).alias("first"), "rows")
    going, _ = written(judged.where("not first or rows > 1").drop("rows"), "jaccard-going")
    for path in (rows_path, counted_path):
        drop(docs.sparkSession, path)
    release(docs.sparkSession)
    wanted = bit_filter(going.select(F.xxhash64("id", "h").alias("key")), "key")
    # The caller's row is one struct, so no name of its columns can clash with ours.
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")
    marked = docs.select(whole, F.xxhash64(id_, F.xxhash64(text_)).alias("key"))
    schema = marked.schema

    def run(batches: Iterator[pa.RecordBatch], inside: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(1).to_numpy(zero_copy_only=False).view(_U)
            yield batch.filter(pa.array(passes_filter(wanted, keys) == inside))

    apart = marked.mapInArrow(functools.partial(run, inside=False), schema).select("doc.*")
    met = marked.mapInArrow(functools.partial(run, inside=True), schema)
    met = met.select("doc", F.col("doc")[id_col].alias("doc_id"), F.xxhash64(F.col("doc")[text_col]).alias("doc_h"))
    met = met.join(going, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("doc_h") == F.col("h")), "left").where("first is null or first")
    row = F.when(F.col("first"), F.lit(-1)).otherwise(F.monotonically_increasing_id())
    once = met.withColumn("row", row).dropDuplicates(["id", "h", "row"])
    return apart.unionByName(once.select("doc.*"))
