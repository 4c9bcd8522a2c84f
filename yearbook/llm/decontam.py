"""Benchmark decontamination: size-partitioned MinHash containment search.

Short test items are looked for inside documents of any length. Items are partitioned by
their number of shingles; the sketch of an item in a partition is its ``k`` smallest
shingle hashes, with ``k`` one more than the shingles that an item of the partition may
lack. So a document that contains enough of an item has one of its sketch values at
least: the search loses nothing. A document meets only partitions whose items are small
enough for it, and only items of which it has a sketch value, and the share of their
shingles in it is then counted exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from yearbook.llm.columns import passes, texts_of, window_hashes, word_hashes, words_of
from yearbook.llm.tables import written

SHINGLE = 5
PERCENT = 80
#: Shingles of items that go through the documents at once (8 bytes each, broadcast).
BLOCK_SHINGLES = 1_000_000


class Index:
    """The sketches of some items, and their shingles for the exact check."""

    def __init__(self, items: list[tuple[object, int, np.ndarray]]):
        """Items as ``(id, words in a shingle, sorted distinct shingle hashes)``."""
        self.ids = [i for i, _, _ in items]
        self.sets = [s for _, _, s in items]
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        # partitions [2 ** c, 2 ** (c + 1)): the sketch length fits their largest item
        largest = (1 << (np.floor(np.log2(np.maximum(self.sizes, 1))).astype(np.int64) + 1)) - 1
        self.least = -(-PERCENT * ((largest + 1) // 2) // 100)  # of the partition's smallest item
        lack = largest - -(-PERCENT * largest // 100)
        sketches = [s[: k + 1] for s, k in zip(self.sets, lack.tolist(), strict=True)]
        self.by_words = {}
        for n in {n for _, n, _ in items}:
            own = [i for i, (_, m, _) in enumerate(items) if m == n]
            values = np.concatenate([sketches[i] for i in own])
            item = np.repeat(own, [len(sketches[i]) for i in own])
            order = np.argsort(values, kind="stable")
            self.by_words[n] = values[order], item[order]

    def found(self, texts: pa.Array) -> Iterator[tuple[int, int, int]]:
        """``(text, item, shared shingles)`` wherever enough of an item is in a text."""
        words = words_of(texts, lower=True)
        hashes = word_hashes(words)
        row = np.repeat(np.arange(len(texts)), np.diff(words.bounds))
        for n, (values, item) in self.by_words.items():
            runs = window_hashes(hashes, n)
            place = np.searchsorted(values, runs)
            hits = np.flatnonzero(values[np.minimum(place, len(values) - 1)] == runs)
            hits = hits[row[hits] == row[hits + n - 1]]
            pairs = set()
            for at in hits.tolist():
                p = int(place[at])
                while p < len(values) and values[p] == runs[at]:
                    pairs.add((int(row[at]), int(item[p])))
                    p += 1
            held, shingles = -1, runs[:0]
            for text, i in sorted(pairs):
                if text != held:
                    held, shingles = text, np.unique(runs[words.bounds[text] : max(words.bounds[text], words.bounds[text + 1] - n + 1)])
                if len(shingles) < self.least[i]:
                    continue
                at = np.minimum(np.searchsorted(shingles, self.sets[i]), len(shingles) - 1)
                both = int((shingles[at] == self.sets[i]).sum())
                if 100 * both >= PERCENT * self.sizes[i]:
                    yield text, i, both


def indexes(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> Iterator[Index]:
    """The items in blocks of about ``BLOCK_SHINGLES``; equal rows are one item, items
    without a word none. One block at a time is on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, 1):
            words = words_of(texts_of(batch, 1), lower=True)
            hashes = word_hashes(words)
            sizes, data = [], []
            for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True):
                n = min(SHINGLE, int(b - a))
                sizes.append(n)
                data.append(np.unique(window_hashes(hashes[a:b], n)).tobytes() if n else b"")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(data, pa.binary())], names=["id", "words", "shingles"])

    rows = benchmark.select(F.col(item_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    items, _ = written(rows.mapInArrow(run, f"id {kind}, words bigint, shingles binary").where("words > 0").distinct(), "benchmark-items")
    total = items.agg(F.sum(F.octet_length("shingles") / 8).alias("n")).first()["n"] or 0
    blocks = int(total // BLOCK_SHINGLES) + 1
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("id", "shingles"), F.lit(blocks)) == b).orderBy("id", "shingles").collect()
        if block:
            yield Index([(r.id, r.words, np.frombuffer(r.shingles, np.uint64)) for r in block])


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """``(id, item, n_shared, n_item, containment)`` for every document and test item of
    whose distinct 5-word shingles (A-Z lower-cased) the document has 80 of 100 or more.
    An item of fewer words is looked for as the run of all its words.

    Documents pass once for each block of items, in narrow jobs without a shuffle. Null,
    empty and blank texts hold nothing and are in nothing; repeated documents each have
    their rows, repeated items one; empty tables give no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind, item_kind = rows.schema["id"].dataType.simpleString(), benchmark.schema[item_col].dataType
    arrow = pa.schema([("item", to_arrow_type(item_kind)), ("n_shared", pa.int64()), ("n_item", pa.int64())])
    out = None
    for index in indexes(benchmark, item_col, text_col):

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in passes(batches, 1):
                got = list(index.found(texts_of(batch, 1)))
                ids = batch.column(0).take(pa.array([t for t, _, _ in got], pa.int64()))
                columns = [[index.ids[i] for _, i, _ in got], [n for _, _, n in got], [int(index.sizes[i]) for _, i, _ in got]]
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True))], names=["id", *arrow.names])

        found = rows.mapInArrow(run, f"id {kind}, item {item_kind.simpleString()}, n_shared bigint, n_item bigint")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = rows.where("false").select("id", F.lit(None).cast(item_kind).alias("item"), F.lit(0).cast("bigint").alias("n_shared"), F.lit(1).cast("bigint").alias("n_item"))
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def keep_unleaked(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, that hold no test item. A filter beside the
    text: no join, and repeated rows are judged each for itself. Null, empty and blank
    texts hold nothing and stay; ties in the threshold go; items without a word are in nothing; of
    an empty table nothing is left, and against an empty benchmark all stays."""
    place = docs.columns.index(text_col)
    for index in indexes(benchmark, item_col, item_text_col):

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in passes(batches, place):
                kept = np.ones(batch.num_rows, bool)
                kept[[t for t, _, _ in index.found(texts_of(batch, place))]] = False
                yield batch.filter(pa.array(kept))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
